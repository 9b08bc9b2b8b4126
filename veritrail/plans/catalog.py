"""All queries over the standard tables, each with the same result in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..operators import cleaning, company, evaluation, ingest, jobs, quality, responsibility, timeline
from ..sources import files
from ..sources.tables import Catalog, scratch_root
from .projection import AS_OF, view, with_views

_Q: dict = {}
_SQL: dict = {}


def _query(sql: str | None = None, *views: str):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            # the statement's own WITH continues the views' one
            head = with_views(*views) if views else ""
            text = sql.strip()
            if views:
                text = head + (", " + text[5:] if text.startswith("WITH ") else " " + text)
            _SQL[f.__name__] = text
        return f

    return add


def queries():
    return dict(_Q)


def oracle_sql():
    return dict(_SQL)


def _facts(spark, sf_dir):
    return timeline.facts(view(spark, sf_dir, "jobs"), AS_OF)


# ---- employment timeline ----------------------------------------------------

_SPANS = f"""
sp AS (SELECT submission_id, experience_id, seniority_level, year(start_date) * 12 + month(start_date) AS a,
              year(e) * 12 + month(e) + 1 AS b
       FROM (SELECT *, greatest(coalesce(end_date, DATE '{AS_OF}'), start_date) AS e FROM jobs WHERE start_date IS NOT NULL))"""
_MONTHS = ", mon AS (SELECT submission_id, unnest(range(a, b)) AS m, a FROM sp)"
_BAND = ", ladder(l, least, junior) AS (VALUES " + ", ".join(f"('{n}', {m}, {str(j).lower()})" for n, _, m, j in fixed.LADDER) + ")"
_FACTS = f"""WITH {_SPANS}{_MONTHS}{_BAND},
u AS (SELECT submission_id, count(DISTINCT m) AS union_months FROM mon GROUP BY ALL),
o AS (SELECT x.submission_id, max(least(x.b, y.b) - greatest(x.a, y.a)) AS ov FROM sp x JOIN sp y
      ON x.submission_id = y.submission_id AND x.experience_id < y.experience_id GROUP BY ALL),
g AS (SELECT submission_id, max(d) - 1 AS g FROM (SELECT submission_id, m - lag(m) OVER (PARTITION BY submission_id ORDER BY m) AS d
      FROM (SELECT DISTINCT submission_id, m FROM mon)) GROUP BY ALL),
s AS (SELECT submission_id, max(least - held) AS s FROM (
      SELECT x.submission_id, x.experience_id, any_value(l.least) AS least, count(DISTINCT mon.m) AS held
      FROM sp x JOIN ladder l ON l.l = x.seniority_level AND NOT l.junior
      LEFT JOIN mon ON mon.submission_id = x.submission_id AND mon.a < x.a AND mon.m < x.a GROUP BY 1, 2) GROUP BY ALL),
f AS (SELECT j.submission_id, CAST(coalesce(n, 0) AS BIGINT) AS n_spans, CAST(coalesce(union_months, 0) AS BIGINT) AS union_months,
      CAST(CASE WHEN ov > 1 THEN ov ELSE 0 END AS BIGINT) AS overlap, CAST(greatest(coalesce(g, 0), 0) AS BIGINT) AS gap,
      CAST(greatest(coalesce(s, 0), 0) AS BIGINT) AS shortfall, n_current, unevaluable
      FROM (SELECT submission_id, count(*) FILTER (is_current) AS n_current, count(*) FILTER (start_date IS NULL) AS unevaluable
            FROM jobs GROUP BY ALL) j
      LEFT JOIN (SELECT submission_id, count(*) AS n FROM sp GROUP BY ALL) c USING (submission_id)
      LEFT JOIN u USING (submission_id) LEFT JOIN o USING (submission_id) LEFT JOIN g USING (submission_id) LEFT JOIN s USING (submission_id))"""
_FINDINGS = f"""{_FACTS}, fd AS (
SELECT submission_id, CASE WHEN overlap > 12 THEN 'employment_overlap_severe' WHEN overlap > 3 THEN 'employment_overlap'
       ELSE 'employment_overlap_minor' END AS name, overlap AS months, CASE WHEN overlap > 3 THEN 'proven' ELSE 'suggestive' END AS evidence
FROM f WHERE overlap > 1
UNION ALL SELECT submission_id, CASE WHEN gap > 12 THEN 'very_long_gap' ELSE 'long_gap' END, gap, 'proven' FROM f WHERE gap > 6
UNION ALL SELECT submission_id, 'seniority_implausible', shortfall, 'suggestive' FROM f WHERE shortfall > 72
UNION ALL SELECT submission_id, 'multiple_current_roles', NULL, 'proven' FROM f WHERE n_current > 1 AND n_spans > 0
UNION ALL SELECT submission_id, 'unevaluable_dates', unevaluable, 'data_issue' FROM f WHERE unevaluable > 0 AND n_spans > 0)"""
_CONFIDENCE = f"""{_FINDINGS}, cf AS (SELECT f.submission_id, CASE WHEN n_spans = 0 THEN 'not_evaluated'
  WHEN bool_or(evidence = 'proven') THEN 'not_confirmed' WHEN bool_or(evidence = 'suggestive') THEN 'possible' ELSE 'confirmed' END AS confidence
  FROM f LEFT JOIN fd USING (submission_id) GROUP BY f.submission_id, n_spans)"""


@_query(f"WITH {_SPANS} SELECT submission_id, experience_id, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b FROM sp", "jobs")
def timeline_spans(spark, sf_dir):
    return timeline.spans(view(spark, sf_dir, "jobs"), AS_OF).drop("seniority_level")


def _fact(name):
    def f(spark, sf_dir):
        return _facts(spark, sf_dir).select("submission_id", name)

    f.__name__ = f"timeline_{name}"
    _query(f"{_FACTS} SELECT submission_id, {name} FROM f", "jobs")(f)


for _name in ("union_months", "overlap", "gap", "shortfall"):
    _fact(_name)


@_query(f"{_FINDINGS} SELECT submission_id, name, CAST(months AS BIGINT) AS months, evidence FROM fd", "jobs")
def timeline_findings(spark, sf_dir):
    rows = timeline.signal(view(spark, sf_dir, "jobs"), AS_OF)
    return rows.select("submission_id", F.explode("findings").alias("f")).select("submission_id", "f.name", "f.months", "f.evidence")


@_query(f"{_CONFIDENCE} SELECT * FROM cf", "jobs")
def timeline_confidence(spark, sf_dir):
    return timeline.signal(view(spark, sf_dir, "jobs"), AS_OF).drop("findings")


@_query(
    f"""{_CONFIDENCE} SELECT 'confidence' AS kind, confidence AS name, count(*) AS n FROM cf GROUP BY ALL
UNION ALL SELECT 'finding', name, count(*) FROM fd GROUP BY ALL""",
    "jobs",
)
def timeline_summary(spark, sf_dir):
    return timeline.summary(timeline.signal(view(spark, sf_dir, "jobs"), AS_OF))


# ---- responsibility -----------------------------------------------------------


def _largest_sql(patterns, kind):
    lists = ", ".join(f"regexp_extract_all(coalesce(description, ''), '(?i){p}', 1)" for p in patterns)
    return f"coalesce(list_max(list_transform(flatten([{lists}]), lambda x: TRY_CAST(x AS {kind}))), 0)"


_CLAIMS = f"""WITH cl AS (SELECT *, CAST({_largest_sql(fixed.TEAM_PATTERNS, "DOUBLE")} AS BIGINT) AS people,
  CAST({_largest_sql(fixed.BUDGET_PATTERNS, "DOUBLE")} AS DOUBLE) AS budget FROM jobs), rf AS (
  SELECT submission_id, experience_id, 'junior_managing_team' AS name, seniority_level AS level, CAST(people AS DOUBLE) AS claimed, 'proven' AS evidence
  FROM cl WHERE seniority_level = 'Junior' AND people >= 1
  UNION ALL SELECT submission_id, experience_id, 'junior_owning_budget', seniority_level, budget, 'suggestive' FROM cl
  WHERE seniority_level = 'Junior' AND budget >= 1
  UNION ALL SELECT submission_id, experience_id, 'team_far_above_level', seniority_level, people, 'suggestive' FROM cl
  WHERE seniority_level IN ('Mid', 'Senior') AND people >= 30)"""


@_query(f"{_CLAIMS} SELECT experience_id, people FROM cl", "jobs")
def resp_people(spark, sf_dir):
    return responsibility.claims(view(spark, sf_dir, "jobs")).select("experience_id", "people")


@_query(f"{_CLAIMS} SELECT experience_id, budget FROM cl", "jobs")
def resp_budget(spark, sf_dir):
    return responsibility.claims(view(spark, sf_dir, "jobs")).select("experience_id", "budget")


@_query(f"{_CLAIMS} SELECT * FROM rf", "jobs")
def resp_findings(spark, sf_dir):
    rows = responsibility.signal(view(spark, sf_dir, "jobs"))
    return rows.select("submission_id", F.explode("findings").alias("f")).select("submission_id", "f.*")


@_query(
    f"""{_CLAIMS} SELECT submission_id, CASE WHEN any_value(k) = 0 THEN 'not_evaluated' WHEN bool_or(evidence = 'proven') THEN 'not_confirmed'
WHEN bool_or(evidence = 'suggestive') THEN 'possible' ELSE 'confirmed' END AS confidence
FROM (SELECT submission_id, count(seniority_level) AS k FROM cl GROUP BY ALL) LEFT JOIN rf USING (submission_id) GROUP BY ALL""",
    "jobs",
)
def resp_confidence(spark, sf_dir):
    return responsibility.signal(view(spark, sf_dir, "jobs")).drop("findings")


# ---- employers ------------------------------------------------------------------

_SUFFIX = "|".join(fixed.COMPANY_SUFFIXES)
_COMPANY = (
    "trim(regexp_replace(' ' || trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[.'']', '', 'g'), "
    r"'[^\p{{L}}\p{{M}}\p{{N}}\s]|_', ' ', 'g'), '\s+', ' ', 'g')), '(?: (?:" + _SUFFIX + "))+$', ''))"
)
_REGISTER = f"""WITH q AS (SELECT DISTINCT {_COMPANY.format("company_name")} AS q FROM raw_jobs),
reg AS (SELECT q, CASE WHEN length(q) % 3 = 0 THEN [] WHEN length(q) % 3 = 1 THEN [{{'n': 'A', 't': concat(q, ' Group')}}, {{'n': 'B', 't': concat(upper(q), ' LTD')}}]
        ELSE [{{'n': 'C', 't': concat('Other ', q)}}] END AS results FROM q WHERE q NOT LIKE '%7%'),
m AS (SELECT submission_id, experience_id, company_name AS cv, {_COMPANY.format("company_name")} AS q FROM raw_jobs),
st AS (SELECT m.*, reg.results IS NOT NULL AS searched, CASE WHEN len(results) = 2 THEN 'B' WHEN len(results) = 1 THEN 'C' END AS number,
       CASE WHEN len(results) = 2 THEN 'confirmed' WHEN len(results) = 1 THEN 'partial_match' ELSE 'unconfirmed' END AS status
       FROM m LEFT JOIN reg USING (q))"""


def _spelled(spark, sf_dir):
    """The employers' spellings, counted in one pass over the roles and kept: a plan that reads them twice would count twice."""
    return Catalog(spark, scratch_root(spark), {}).kept(company.spellings(view(spark, sf_dir, "raw_jobs")), "spellings")


def _register(spelled):
    """A made-up register: some names found, some found twice, some not, some never searched."""
    names = spelled.select(T.company_name(F.col("company_name")).alias("query_normalized")).distinct()
    q = F.col("query_normalized")
    row = lambda n, t: F.struct(F.lit(n).alias("company_number"), t.alias("title"))
    found = (
        F.when(F.length(q) % 3 == 0, F.array().cast("array<struct<company_number:string,title:string>>"))
        .when(F.length(q) % 3 == 1, F.array(row("A", F.concat(q, F.lit(" Group"))), row("B", F.concat(F.upper(q), F.lit(" LTD")))))
        .otherwise(F.array(row("C", F.concat(F.lit("Other "), q))))
    )
    return names.where(~q.contains("7")).withColumn("results", found)


@_query(f"SELECT DISTINCT company_name, {_COMPANY.format('company_name')} AS normalized FROM raw_jobs", "raw_jobs")
def company_normalize(spark, sf_dir):
    return view(spark, sf_dir, "raw_jobs").select("company_name", T.company_name(F.col("company_name")).alias("normalized")).distinct()


@_query(f"{_REGISTER} SELECT experience_id, number AS matched_company_number, searched FROM st", "raw_jobs")
def company_match(spark, sf_dir):
    rows = company.matches(view(spark, sf_dir, "raw_jobs"), _register(_spelled(spark, sf_dir)))
    return rows.select("experience_id", "matched_company_number", "searched")


@_query(f"{_REGISTER} SELECT status, count(*) AS n FROM st GROUP BY ALL", "raw_jobs")
def company_status(spark, sf_dir):
    spelled = _spelled(spark, sf_dir)
    return company.status_counts(spelled, _register(spelled))


@_query(f"{_REGISTER} SELECT experience_id, status FROM st WHERE searched AND experience_id NOT LIKE '%_job2'", "raw_jobs")
def company_incremental(spark, sf_dir):
    roles = view(spark, sf_dir, "raw_jobs")
    done = roles.where("experience_id LIKE '%_job2'").select("experience_id")
    return company.verify(roles, done, _register(_spelled(spark, sf_dir)))[0].select("experience_id", "status")


# ---- silver ----------------------------------------------------------------------

_EMAIL_OK = f"coalesce(regexp_matches(trim(email), '{fixed.EMAIL.replace(chr(39), chr(39) * 2)}'), false)"


@_query(
    f"""SELECT submission_id, upper(trim(regexp_replace(candidate_name, '\\s+', ' ', 'g'))) AS candidate_name, coalesce(trim(email), '') AS email,
{_EMAIL_OK} AS is_email_valid, coalesce(trim(linkedin), '') AS linkedin, coalesce(trim(github), '') AS github FROM people""",
    "people",
)
def silver_candidates(spark, sf_dir):
    return cleaning.candidates(view(spark, sf_dir, "people")).drop("phone", "is_phone_valid")


@_query(f"SELECT {_EMAIL_OK} AS is_email_valid, count(*) AS n FROM people GROUP BY ALL", "people")
def email_validity(spark, sf_dir):
    return cleaning.candidates(view(spark, sf_dir, "people")).groupBy("is_email_valid").agg(F.count("*").alias("n"))


@_query(
    r"""SELECT submission_id, CASE CAST(replace(submission_id, 'cv_', '') AS BIGINT) % 6 WHEN 0 THEN replace(phone, ' ', '') WHEN 2 THEN '+44' || phone[2:]
WHEN 3 THEN regexp_replace(phone, '[ ()]', '', 'g') WHEN 4 THEN '+33' || replace(phone, ' ', '')[5:] END AS phone FROM people""",
    "people",
)
def phone_e164(spark, sf_dir):
    return cleaning.candidates(view(spark, sf_dir, "people")).select("submission_id", "phone")


@_query("SELECT submission_id, e164 AS phone FROM numbers", "numbers")
def phone_plans(spark, sf_dir):
    return cleaning.standard_phones(view(spark, sf_dir, "numbers").drop("e164"), "phone", "phone")


_SKILLS = r"""WITH ss AS (SELECT skill_id, submission_id, skill_name AS raw_skill, d.canonical_skill AS normalized_skill,
trim(regexp_replace(skill_name, '\s+', ' ', 'g')) AS clean
FROM raw_skills LEFT JOIN (SELECT DISTINCT lower(alias) AS k, canonical_skill FROM dim_skills) d
ON d.k = lower(trim(regexp_replace(skill_name, '\s+', ' ', 'g'))))"""


def _skills(spark, sf_dir):
    return cleaning.skills(view(spark, sf_dir, "raw_skills"), view(spark, sf_dir, "dim_skills"))


@_query(f"{_SKILLS} SELECT skill_id, submission_id, raw_skill, normalized_skill FROM ss", "raw_skills", "dim_skills")
def skill_normalize(spark, sf_dir):
    return _skills(spark, sf_dir)


@_query(
    f"{_SKILLS} SELECT clean AS skill, count(*) AS n FROM ss WHERE normalized_skill IS NULL GROUP BY ALL ORDER BY n DESC, skill LIMIT 10",
    "raw_skills",
    "dim_skills",
)
def skill_unmatched_topk(spark, sf_dir):
    return cleaning.unmatched(_skills(spark, sf_dir), 10)


@_query(
    f"""{_SKILLS} SELECT count(*) AS n_rows, count(normalized_skill) AS matched, count(*) - count(normalized_skill) AS unmatched,
count(DISTINCT normalized_skill) AS n_canonical FROM ss""",
    "raw_skills",
    "dim_skills",
)
def skill_summary(spark, sf_dir):
    matched = F.count("normalized_skill")
    return _skills(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), matched.alias("matched"), (F.count("*") - matched).alias("unmatched"),
        F.count_distinct("normalized_skill").alias("n_canonical"),
    )


_TITLE = r"trim(regexp_replace(regexp_replace(coalesce(job_title, ''), '[^\p{L}\p{M}\p{N}\s]|_', ' ', 'g'), '\s+', ' ', 'g'))"
_DATE = "CAST(coalesce(try_strptime({0}, '%B %Y'), try_strptime({0}, '%b %Y')) AS DATE)"
_CLEAN = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
_OPEN = "lower(trim(end_date_raw)) IN ('present', 'current', 'now', 'ongoing', 'to date')"
_WORK = rf"""WITH w0 AS (SELECT *, {_CLEAN.format("location")} AS loc FROM raw_jobs), w1 AS (SELECT *, list_filter(list_transform(string_split(
  regexp_replace(regexp_replace(loc, '(?i)^\s*remote\s*[/\-–|]?\s*', ''), '^[ ,]+|[ ,]+$', '', 'g'), ','), lambda p: trim(p)), lambda p: p <> '') AS parts FROM w0),
w2 AS (SELECT w1.*, c.country, t.seniority_level FROM w1
  LEFT JOIN (SELECT lower(location_token) AS k, country FROM places) c ON c.k = lower(parts[-1])
  LEFT JOIN (SELECT DISTINCT lower(trim(job_title)) AS k, seniority_level FROM titles) t ON t.k = lower(trim(job_title))),
we AS (SELECT experience_id, submission_id, {_TITLE} AS job_title_standardized, job_title, seniority_level, location, country AS location_country,
  nullif(trim(regexp_replace(CASE WHEN len(parts) = 0 THEN '' WHEN len(parts) = 1 THEN CASE WHEN lower(parts[-1]) = lower(country) THEN '' ELSE parts[-1] END
         ELSE parts[-2] END, '(?i)\s+(office|hq|headquarters)$', '')), '') AS location_city,
  regexp_matches(location, '(?i)\bremote\b') AS is_remote, {_DATE.format(_CLEAN.format("start_date_raw"))} AS start_date,
  {_DATE.format(_CLEAN.format("end_date_raw"))} AS end_date, is_current OR {_OPEN} AS is_current FROM w2)"""
_W = ("raw_jobs", "titles", "places")


def _work(spark, sf_dir):
    return cleaning.work_experience(*[view(spark, sf_dir, v) for v in _W])


@_query(f"SELECT DISTINCT job_title, {_TITLE} AS standardized FROM raw_jobs", "raw_jobs")
def title_standardize(spark, sf_dir):
    return view(spark, sf_dir, "raw_jobs").select("job_title", T.standard_title(F.col("job_title")).alias("standardized")).distinct()


@_query(f"{_WORK} SELECT experience_id, start_date, end_date, is_current FROM we", *_W)
def parse_month(spark, sf_dir):
    return _work(spark, sf_dir).select("experience_id", "start_date", "end_date", "is_current")


@_query(f"{_WORK} SELECT experience_id, location_city, location_country, is_remote FROM we", *_W)
def split_location(spark, sf_dir):
    return _work(spark, sf_dir).select("experience_id", "location_city", "location_country", "is_remote")


@_query(f"{_WORK} SELECT experience_id, seniority_level FROM we", *_W)
def seniority_lookup(spark, sf_dir):
    return _work(spark, sf_dir).select("experience_id", "seniority_level")


_PROBLEMS = f"""{_WORK}, pr AS (SELECT experience_id, 'unparsed_start_date' AS problem FROM we WHERE start_date IS NULL
UNION ALL SELECT experience_id, 'unparsed_end_date' FROM we WHERE end_date IS NULL AND NOT is_current
UNION ALL SELECT experience_id, 'start_after_end' FROM we WHERE start_date > end_date
UNION ALL SELECT experience_id, 'date_in_future' FROM (SELECT experience_id, unnest([start_date, end_date]) AS d FROM we) WHERE d > DATE '{AS_OF}'
UNION ALL SELECT experience_id, 'implausible_year' FROM (SELECT experience_id, unnest([start_date, end_date]) AS d FROM we) WHERE year(d) < 1950)"""


@_query(f"{_PROBLEMS} SELECT * FROM pr", *_W)
def work_date_problems(spark, sf_dir):
    return cleaning.date_problems(_work(spark, sf_dir), AS_OF)


@_query(
    f"""{_PROBLEMS} SELECT 'problem' AS kind, problem AS name, count(*) AS n FROM pr GROUP BY ALL
UNION ALL SELECT 'title', trim(job_title), count(*) FROM we WHERE seniority_level IS NULL GROUP BY ALL
UNION ALL SELECT 'location', trim(location), count(*) FROM we WHERE location_country IS NULL AND trim(location) <> '' GROUP BY ALL""",
    *_W,
)
def work_gaps(spark, sf_dir):
    return cleaning.summarize_gaps(_work(spark, sf_dir), AS_OF).where("kind <> 'rows'")


@_query(
    f"""{_PROBLEMS}, c AS (SELECT 'title' AS kind, nullif(trim(job_title), '') AS name, count(*) AS n FROM we WHERE seniority_level IS NULL GROUP BY ALL
UNION ALL SELECT 'location', trim(location), count(*) FROM we WHERE location_country IS NULL AND trim(location) <> '' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, name NULLS LAST) AS place FROM c)
SELECT kind, name, n FROM r WHERE place <= 5 UNION ALL SELECT 'problem', problem, count(*) FROM pr GROUP BY ALL
UNION ALL SELECT 'rows', CASE kind WHEN 'title' THEN 'without_seniority' ELSE 'without_country' END, CAST(sum(n) AS BIGINT) FROM c GROUP BY ALL""",
    *_W,
)
def gap_summary(spark, sf_dir):
    return cleaning.summarize_gaps(_work(spark, sf_dir), AS_OF, 5)


@_query(
    f"""{_WORK} SELECT count(*) AS n_rows, count(DISTINCT submission_id) AS n_candidates, count(*) FILTER (is_current) AS n_current,
count(*) FILTER (is_remote) AS n_remote FROM we""",
    *_W,
)
def work_summary(spark, sf_dir):
    return _work(spark, sf_dir).agg(
        F.count("*").alias("n_rows"), F.count_distinct("submission_id").alias("n_candidates"),
        F.count_if("is_current").alias("n_current"), F.count_if("is_remote").alias("n_remote"),
    )


# ---- bronze ------------------------------------------------------------------------

_WORDS = ", ".join("'" + w.replace("'", "''") + "'" for w in fixed.PROFILE_WORDS)
_CATEGORY = ", ".join(f"('{s}', '{c}')" for s, c in fixed.SKILL_CATEGORIES.items())


@_query(
    f"""SELECT submission_id, CASE WHEN len(list_filter([{_WORDS}], lambda w: contains(lower(raw_text), w))) >= 3 THEN 'technical'
ELSE 'non_technical' END AS profile_type FROM texts""",
    "texts",
)
def classify_profile(spark, sf_dir):
    rows = view(spark, sf_dir, "texts").select("submission_id", F.lower("raw_text").alias("low"))
    return rows.select("submission_id", T.profile_type(F.col("low")).alias("profile_type"))


@_query(
    f"""WITH cat(s, c) AS (VALUES {_CATEGORY}), sk AS (SELECT submission_id, unnest(['Python', event_type, ' Power BI ', 'rest', 'R']) AS skill
FROM replies) SELECT skill, coalesce(c, 'other') AS category, count(*) AS n FROM sk LEFT JOIN cat ON s = lower(trim(skill)) GROUP BY ALL""",
    "replies",
)
def categorize_skill(spark, sf_dir):
    skills = F.array(F.lit("Python"), F.col("event_type"), F.lit(" Power BI "), F.lit("rest"), F.lit("R"))
    rows = view(spark, sf_dir, "replies").select(F.explode(skills).alias("skill"))
    return rows.groupBy("skill", T.skill_category(F.col("skill")).alias("category")).agg(F.count("*").alias("n"))


@_query("SELECT submission_id, sha256(raw_text) AS content_hash FROM texts", "texts")
def content_hash(spark, sf_dir):
    return view(spark, sf_dir, "texts").select("submission_id", F.sha2("raw_text", 256).alias("content_hash"))


def _now_and_prior(spark, sf_dir):
    now = view(spark, sf_dir, "texts").withColumn("content_hash", F.sha2("raw_text", 256))
    old = F.when(F.col("doc_id") % 7 == 0, F.concat("content_hash", F.lit("x"))).when(F.col("doc_id") % 11 == 0, None).otherwise(F.col("content_hash"))
    return now, now.where("doc_id % 3 <> 0").select("submission_id", old.alias("content_hash"))


@_query(
    """SELECT submission_id, CASE WHEN doc_id % 3 = 0 THEN 'new' WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN 'changed' ELSE 'unchanged' END AS action
FROM texts""",
    "texts",
)
def change_action(spark, sf_dir):
    return ingest.actions(*_now_and_prior(spark, sf_dir)).drop("content_hash")


@_query(
    "SELECT submission_id, doc_id % 7 = 0 OR doc_id % 11 = 0 AS fresh FROM texts WHERE doc_id % 3 <> 0 UNION ALL SELECT submission_id, true FROM texts WHERE doc_id % 3 = 0",
    "texts",
)
def delete_changed(spark, sf_dir):
    now, prior = _now_and_prior(spark, sf_dir)
    tables = Catalog(spark, scratch_root(spark), {"bronze.texts": "submission_id string, fresh boolean"}, buckets=16)
    tables.replace("bronze.texts", prior.withColumn("fresh", F.lit(False)))
    todo = tables.kept(ingest.actions(now, prior).where("action <> 'unchanged'"), "todo")
    tables.delete(["bronze.texts"], todo.where("action = 'changed'"))
    tables.append("bronze.texts", todo.withColumn("fresh", F.lit(True)))
    return tables.read("bronze.texts")


@_query("SELECT path, submission_id FROM texts", "texts")
def path_to_id(spark, sf_dir):
    return view(spark, sf_dir, "texts").select("path", T.id_of_path(F.col("path")).alias("submission_id"))


_BLANK = """SELECT 'email' AS "column", count(*) FILTER (email IS NULL OR trim(email) = '') AS n FROM people
UNION ALL SELECT 'phone', count(*) FILTER (phone IS NULL OR trim(phone) = '') FROM people
UNION ALL SELECT 'github', count(*) FILTER (github IS NULL) FROM people"""


@_query(_BLANK, "people")
def blank_counts(spark, sf_dir):
    return quality.blank_counts(view(spark, sf_dir, "people"), ["email", "phone", "github"])


@_query("SELECT email, count(*) AS n FROM people GROUP BY ALL HAVING count(*) > 1", "people")
def duplicate_counts(spark, sf_dir):
    return quality.duplicate_values(view(spark, sf_dir, "people"), "email")


@_query("SELECT skill_id FROM raw_skills WHERE submission_id NOT IN (SELECT submission_id FROM jobs)", "raw_skills", "jobs")
def orphan_rows(spark, sf_dir):
    return quality.orphans(view(spark, sf_dir, "raw_skills"), view(spark, sf_dir, "jobs"), "submission_id").select("skill_id")


@_query(
    """SELECT submission_id FROM texts t WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.submission_id = t.submission_id)
AND NOT EXISTS (SELECT 1 FROM raw_skills s WHERE s.submission_id = t.submission_id)""",
    "texts",
    "jobs",
    "raw_skills",
)
def silent_cvs(spark, sf_dir):
    return quality.without_entities(*[view(spark, sf_dir, v) for v in ("texts", "jobs", "raw_skills")]).select("submission_id")


@_query(
    f"""WITH bl AS ({_BLANK}) SELECT bool_and(n = 0) AS passed,
array_to_string(list_sort(list(concat("column", ' (', n, ' rows)')) FILTER (n > 0)), '; ') AS description FROM bl""",
    "people",
)
def check_results(spark, sf_dir):
    return quality.results(blank_counts(spark, sf_dir).withColumnRenamed("column", "check"))


_VALID = "event_id % 11 <> 0 AND event_id % 17 <> 0"


def _cvs(spark, sf_dir):
    return ingest.parsed(view(spark, sf_dir, "replies"))


@_query(f"SELECT submission_id, {_VALID} AS is_valid FROM replies", "replies")
def extraction_valid(spark, sf_dir):
    return _cvs(spark, sf_dir).select("submission_id", "is_valid")


@_query(
    f"""SELECT submission_id || '_job1' AS experience_id, 'Acme ' || (event_id % 9) AS company_name, 'Present' AS end_date_raw FROM replies WHERE {_VALID}
UNION ALL SELECT submission_id || '_job2', 'Zed', 'May 2020' FROM replies WHERE {_VALID} AND event_id % 2 = 0""",
    "replies",
)
def explode_entities(spark, sf_dir):
    return ingest.roles(_cvs(spark, sf_dir)).select("experience_id", "company_name", "end_date_raw")


@_query(
    f"""SELECT submission_id || '_' || lower(event_type) AS skill_id, event_type AS skill_name FROM replies WHERE {_VALID}
UNION ALL SELECT submission_id || '_power_bi', 'Power BI' FROM replies WHERE {_VALID}""",
    "replies",
)
def skills_dedupe(spark, sf_dir):
    return ingest.skill_rows(_cvs(spark, sf_dir)).select("skill_id", "skill_name")


@_query("SELECT lower(p_name) AS lookup_key, count(DISTINCT p_brand) AS n_values FROM part GROUP BY ALL HAVING count(DISTINCT p_brand) > 1")
def dim_conflicts(spark, sf_dir):
    return cleaning.conflicts(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_name", "p_brand")


@_query("SELECT canonical_skill, trim(unnest(string_split(replace(alias, ' ', '| '), '|'))) AS alias FROM dim_skills", "dim_skills")
def alias_explode(spark, sf_dir):
    from ..sources.files import aliases

    dims = view(spark, sf_dir, "dim_skills").withColumn("aliases", F.replace("alias", F.lit(" "), F.lit("| ")))
    return aliases(dims)


@_query(
    "SELECT level, band, months, junior, count(experience_id) AS n_roles FROM (VALUES "
    + ", ".join(f"('{a}', '{b}', {c}, {str(d).lower()})" for a, b, c, d in fixed.LADDER)
    + ") t(level, band, months, junior) LEFT JOIN jobs ON seniority_level = level GROUP BY ALL",
    "jobs",
)
def ladder(spark, sf_dir):
    """The ladder with how many roles stand on each level."""
    levels = spark.createDataFrame(list(fixed.LADDER), "level string, band string, months int, junior boolean")
    held = view(spark, sf_dir, "jobs").groupBy(F.col("seniority_level").alias("level")).agg(F.count("*").alias("n_roles"))
    return levels.join(held, "level", "left").fillna(0, ["n_roles"])


@_query("SELECT experience_id, unnest(list_filter(string_split(replace(description, ' ', '|'), '|'), lambda x: x <> '')) AS word FROM jobs WHERE description IS NOT NULL", "jobs")
def groundtruth_types(spark, sf_dir):
    words = F.filter(F.split(F.replace("description", F.lit(" "), F.lit("|")), r"\|"), lambda x: x != "")
    return view(spark, sf_dir, "jobs").select("experience_id", F.explode(words).alias("word"))


# ---- checks of the landed tables, strict validation, summaries -------------------------


def _blank_sql(table: str, column: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {column} IS NULL OR trim({column}) = ''"


def _twice_sql(table: str, column: str) -> str:
    return f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column} HAVING count(*) > 1)"


def _check_sql(name: str, counts: dict[str, str]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{k}' AS c, ({v}) AS n" for k, v in counts.items())
    level = quality.SEVERITY[name]
    return f"""SELECT '{name}' AS "check", '{level}' AS severity, {str(level == "ERROR").lower()} AS blocking, bool_and(n = 0) AS passed,
coalesce(array_to_string(list_sort(list(concat(c, ' (', n, ' rows)')) FILTER (n > 0)), '; '), '') AS description FROM ({rows})"""


_LANDED = {"raw_candidates": ("people", "submission_id"), "raw_work_experience": ("raw_jobs", "experience_id"), "raw_skills": ("raw_skills", "skill_id")}
_IDS = {f"{t}: blank {k}": _blank_sql(v, k) for t, (v, k) in _LANDED.items()}
_IDS |= {f"{t}: duplicate {k}": _twice_sql(v, k) for t, (v, k) in _LANDED.items()}
_IDS |= {
    f"{t}: no matching CV": f"SELECT count(*) FROM {v} x WHERE NOT EXISTS (SELECT 1 FROM texts y WHERE y.submission_id = x.submission_id)"
    for t, (v, _) in _LANDED.items()
}
_NEEDED = {"raw_candidates": ["candidate_name"], "raw_work_experience": ["company_name", "job_title", "start_date_raw"], "raw_skills": ["skill_name"]}
_SILENT = """SELECT count(*) FROM texts t WHERE NOT EXISTS (SELECT 1 FROM raw_jobs j WHERE j.submission_id = t.submission_id)
AND NOT EXISTS (SELECT 1 FROM raw_skills s WHERE s.submission_id = t.submission_id)"""


@_query(
    " UNION ALL ".join(
        [
            _check_sql(
                quality.RAW_TEXTS,
                {f"{c} blank": _blank_sql("landed", c) for c in ("submission_id", "raw_text", "content_hash")}
                | {"duplicate submission_id": _twice_sql("landed", "submission_id")},
            ).replace("FROM landed", "FROM (SELECT *, sha256(raw_text) AS content_hash FROM texts)"),
            _check_sql(quality.ENTITY_IDS, _IDS),
            _check_sql(quality.CONTENT, {f"{t}: {c} blank": _blank_sql(_LANDED[t][0], c) for t, cs in _NEEDED.items() for c in cs}),
            f"""SELECT '{quality.SILENT}', 'WARN', false, silent = 0, CASE WHEN silent > 0 THEN concat(silent, ' of ', total,
' CVs produced no work experience and no skills') ELSE concat('all ', total, ' CVs produced entities') END
FROM (SELECT ({_SILENT}) AS silent, (SELECT count(*) FROM texts) AS total)""",
        ]
    ),
    "texts",
    "people",
    "raw_jobs",
    "raw_skills",
)
def bronze_checks(spark, sf_dir):
    texts, *rest = (view(spark, sf_dir, v) for v in ("texts", "people", "raw_jobs", "raw_skills"))
    return quality.bronze_checks(texts.withColumn("content_hash", F.sha2("raw_text", 256)), *rest)


@_query("SELECT submission_id, kind IN (1, 4, 6, 8, 12) AS is_valid FROM odd_replies", "odd_replies")
def validation_rules(spark, sf_dir):
    return ingest.parsed(view(spark, sf_dir, "odd_replies")).select("submission_id", "is_valid")


@_query(
    f"""SELECT submission_id, concat('Person ', CAST(user_id AS VARCHAR)) AS candidate_name, '' AS email, '' AS phone, '' AS linkedin, '' AS github
FROM replies JOIN events USING (event_id) WHERE {_VALID.replace("event_id", "events.event_id")}""",
    "replies",
)
def entity_candidates(spark, sf_dir):
    return ingest.candidate_rows(_cvs(spark, sf_dir))


@_query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (NOT ok) AS invalid_emails,
count(*) FILTER (k NOT IN (0, 2, 3, 4)) AS invalid_phones FROM (SELECT {_EMAIL_OK} AS ok, CAST(replace(submission_id, 'cv_', '') AS BIGINT) % 6 AS k FROM people)""",
    "people",
)
def candidate_summary(spark, sf_dir):
    return cleaning.candidate_summary(cleaning.candidates(view(spark, sf_dir, "people")))


@_query("SELECT count(DISTINCT lower(alias)) AS n_aliases, count(DISTINCT canonical_skill) AS n_canonical FROM dim_skills", "dim_skills")
def taxonomy_coverage(spark, sf_dir):
    return cleaning.coverage(view(spark, sf_dir, "dim_skills"))


@_query(
    f"""SELECT submission_id FROM texts t WHERE len(list_filter([{_WORDS}], lambda w: contains(lower(raw_text), w))) >= 3
AND NOT EXISTS (SELECT 1 FROM raw_jobs j WHERE j.submission_id = t.submission_id)""",
    "texts",
    "raw_jobs",
)
def open_texts(spark, sf_dir):
    rows = view(spark, sf_dir, "texts").withColumn("low", F.lower("raw_text")).withColumn("profile_type", T.profile_type(F.col("low")))
    return jobs.open_texts(rows, view(spark, sf_dir, "raw_jobs")).select("submission_id")


@_query(
    f"""{_CLAIMS}, c2 AS (SELECT submission_id, CASE WHEN any_value(k) = 0 THEN 'not_evaluated' WHEN bool_or(evidence = 'proven') THEN 'not_confirmed'
WHEN bool_or(evidence = 'suggestive') THEN 'possible' ELSE 'confirmed' END AS confidence
FROM (SELECT submission_id, count(seniority_level) AS k FROM cl GROUP BY ALL) LEFT JOIN rf USING (submission_id) GROUP BY ALL)
SELECT 'confidence' AS kind, confidence AS name, count(*) AS n FROM c2 GROUP BY ALL UNION ALL SELECT 'finding', name, count(*) FROM rf GROUP BY ALL""",
    "jobs",
)
def resp_summary(spark, sf_dir):
    return timeline.summary(responsibility.signal(view(spark, sf_dir, "jobs")))


# ---- planted flaws, a whole register ---------------------------------------------------

#: The views also plant gaps, which the signals show though no recorded flaw is called so.
_SHOWN_BY = evaluation.SHOWN_BY | {"career_gap": ("long_gap", "very_long_gap")}
_SHOWS = ", ".join(f"('{flaw}', '{name}')" for flaw, names in _SHOWN_BY.items() for name in names)
_EVALUATED = f"""{_FINDINGS}, {_CLAIMS[5:]}, shows(flaw, name) AS (VALUES {_SHOWS}),
tr AS (SELECT id, unnest(list_filter(string_split(flaws, '|'), lambda x: x <> '')) AS flaw FROM recorded),
fn AS (SELECT submission_id AS id, name FROM fd UNION SELECT submission_id, name FROM rf),
sc AS (SELECT DISTINCT id, flaw FROM fn JOIN shows USING (name) WHERE id IN (SELECT id FROM recorded))"""


def _truth(spark, sf_dir):
    """The planted flaws, through the ground truth's own file."""
    path = f"{scratch_root(spark)}/ground_truth"
    rows = view(spark, sf_dir, "recorded").select("id", F.split("flaws", r"\|").alias("inconsistency_types"))
    files.record(rows.withColumn("filename", F.concat("id", F.lit(".pdf"))), path)
    return files.ground_truth(spark, path)


def _found(spark, sf_dir):
    roles = view(spark, sf_dir, "jobs")
    return evaluation.found([timeline.signal(roles, AS_OF), responsibility.signal(roles)])


@_query("SELECT id, unnest(list_filter(string_split(flaws, '|'), lambda x: x <> '')) AS flaw FROM recorded", "recorded")
def planted_flaws(spark, sf_dir):
    return _truth(spark, sf_dir).select("id", F.explode("inconsistency_types").alias("flaw"))


@_query(
    f"""{_EVALUATED}, b AS (SELECT coalesce(tr.flaw, sc.flaw) AS flaw, tr.id IS NOT NULL AS t, sc.id IS NOT NULL AS c
  FROM tr FULL JOIN sc ON tr.id = sc.id AND tr.flaw = sc.flaw)
SELECT flaw, count(*) FILTER (t) AS planted, count(*) FILTER (c) AS claimed, count(*) FILTER (t AND c) AS hits, count(*) FILTER (t AND NOT c) AS missed,
  count(*) FILTER (c AND NOT t) AS false_alarms, (SELECT count(*) FROM recorded) - count(*) AS clean,
  count(*) FILTER (t AND c) / nullif(count(*) FILTER (c), 0) AS precision, count(*) FILTER (t AND c) / nullif(count(*) FILTER (t), 0) AS recall
FROM b GROUP BY flaw""",
    "jobs",
    "recorded",
)
def flaw_scores(spark, sf_dir):
    return evaluation.scores(_truth(spark, sf_dir), _found(spark, sf_dir), _SHOWN_BY)


@_query(
    f"""{_EVALUATED} SELECT coalesce(tr.flaw, 'none') AS flaw, coalesce(fn.name, 'none') AS name, count(*) AS n
FROM recorded r LEFT JOIN tr ON tr.id = r.id LEFT JOIN fn ON fn.id = r.id GROUP BY ALL""",
    "jobs",
    "recorded",
)
def flaw_confusion(spark, sf_dir):
    return evaluation.confusion(_truth(spark, sf_dir), _found(spark, sf_dir))


_MATCHED = f"""WITH nm AS (SELECT DISTINCT q, list_distinct(string_split(q, ' ')) AS a FROM (SELECT {_COMPANY.format("company_name")} AS q FROM raw_jobs) WHERE q <> ''),
rg AS (SELECT company_number, title, t, list_distinct(string_split(t, ' ')) AS b FROM (SELECT *, {_COMPANY.format("title")} AS t FROM register) WHERE t <> ''),
mt AS (SELECT q AS query_normalized, company_number, title, CASE WHEN list_has_all(a, b) AND list_has_all(b, a) THEN 'exact' ELSE 'partial' END AS match_kind
  FROM nm JOIN rg ON list_has_all(a, b) OR list_has_all(b, a))"""


@_query(f"{_MATCHED} SELECT * FROM mt", "raw_jobs", "register")
def register_matches(spark, sf_dir):
    """Every match of an employer's name in the whole register."""
    names = view(spark, sf_dir, "raw_jobs").select(T.company_name(F.col("company_name")).alias("query_normalized"))
    return company.register_matches(names, view(spark, sf_dir, "register"))


@_query(
    f"""{_MATCHED}, bs AS (SELECT query_normalized, min({{'k': match_kind, 'n': company_number}}) AS m FROM mt GROUP BY ALL)
SELECT experience_id, m.n AS matched_company_number, CASE m.k WHEN 'exact' THEN 'confirmed' WHEN 'partial' THEN 'partial_match' ELSE 'unconfirmed' END AS status
FROM (SELECT experience_id, {_COMPANY.format("company_name")} AS q FROM raw_jobs) LEFT JOIN bs ON query_normalized = q""",
    "raw_jobs",
    "register",
)
def register_status(spark, sf_dir):
    """Employers verified with the whole register as the search."""
    roles = view(spark, sf_dir, "raw_jobs")
    cache = spark.createDataFrame([], "query_normalized string, results array<struct<company_number:string,title:string>>")
    search = company.searching(view(spark, sf_dir, "register"))
    verdicts, _ = company.verify(roles, roles.limit(0), cache, search)
    return verdicts.select("experience_id", "matched_company_number", "status")
