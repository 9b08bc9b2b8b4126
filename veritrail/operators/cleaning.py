"""Silver tables: candidates, skills and work experience, row for row with their sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T

PHONE_PLANS = "calling_code string, trunk string, national string"


class ReferenceConflict(ValueError):
    """A reference key with more than one value."""


def lookup(dim: DataFrame, key: str, value: str, form=T.lookup_key) -> DataFrame:
    """(lookup_key, value) of a reference table; blank keys and null values are skipped."""
    rows = dim.select(form(F.col(key)).alias("lookup_key"), F.col(value).alias(value))
    return rows.where(F.col(value).isNotNull() & (F.col("lookup_key") != "")).distinct()


def checked_lookup(dim: DataFrame, key: str, value: str, form=T.lookup_key) -> DataFrame:
    """The lookup of a reference table; a key with more than one value raises when it is used."""
    per = lookup(dim, key, value, form).groupBy("lookup_key").agg(F.min(value).alias(value), F.count("*").alias("n"))
    told = F.raise_error(F.concat(F.lit(f"{key} means more than one {value}: "), "lookup_key")).cast("string")
    return per.select("lookup_key", F.when(F.col("n") > 1, told).otherwise(F.col(value)).alias(value))


def require_unambiguous(dim: DataFrame, key: str, value: str, form=T.lookup_key) -> None:
    """Raises with up to five keys that mean more than one value: the check of a load."""
    bad = conflicts(dim, key, value, form).limit(5).collect()
    if bad:
        raise ReferenceConflict(f"{key}: {', '.join(r['lookup_key'] for r in bad)}")


def conflicts(dim: DataFrame, key: str, value: str, form=T.lookup_key) -> DataFrame:
    """Keys that mean more than one value, with how many."""
    per = lookup(dim, key, value, form).groupBy("lookup_key").agg(F.count("*").alias("n_values"))
    return per.where("n_values > 1")


def standard_phones(rows: DataFrame, column: str, into: str, plans: DataFrame | None = None, home: str = fixed.PHONE_HOME) -> DataFrame:
    """``rows`` with ``into``: the number of ``column`` in E.164, null if no plan accepts it.

    ``plans`` (calling_code, trunk, national: a regular expression) are looked up by the longest code
    that begins the number; codes have up to three digits, so the table is small enough to broadcast,
    whatever it came from. A number without code belongs to ``home``. The trunk prefix may be left out
    or in. Of two plans of one code the lesser form counts.
    """
    plans = rows.sparkSession.createDataFrame(list(fixed.PHONE_PLANS), PHONE_PLANS) if plans is None else plans
    known = plans.where(F.col("calling_code").rlike("^[0-9]{1,3}$")).groupBy("calling_code").agg(F.min(F.struct("national", "trunk")).alias("plan"))
    out = rows.withColumn("_digits", T.dialled(F.col(column), home))
    for k in (3, 2, 1):
        one = known.select(F.col("calling_code").alias(f"_code{k}"), F.col("plan").alias(f"_plan{k}"))
        out = out.join(F.broadcast(one), F.substring("_digits", 1, k) == F.col(f"_code{k}"), "left")
    code, plan = F.coalesce("_code3", "_code2", "_code1"), F.coalesce("_plan3", "_plan2", "_plan1")
    rest = F.substr(F.col("_digits"), F.length(code) + 1)
    trunk = F.coalesce(plan["trunk"], F.lit(""))
    fits = lambda x: F.regexp_like(x, F.concat(F.lit("^(?:"), plan["national"], F.lit(")$")))
    ways = [rest, F.when((trunk != "") & F.startswith(rest, trunk), F.substr(rest, F.length(trunk) + 1))]
    ways.append(F.when((code == home) & F.startswith(rest, F.lit(home)), F.substr(rest, F.lit(len(home) + 1))))
    number = F.coalesce(*[F.when(fits(x), F.concat(F.lit("+"), code, x)) for x in ways])
    return out.withColumn(into, number).drop("_digits", *[f"_{x}{k}" for k in (1, 2, 3) for x in ("code", "plan")])


def candidates(raw: DataFrame, plans: DataFrame | None = None, normalize: Callable[[Column], Column] | None = None) -> DataFrame:
    """Candidates row for row; phones by ``plans`` (see :func:`standard_phones`) or by an injected column function."""
    blank = lambda c: T.trimmed(F.coalesce(c, F.lit("")))
    if normalize:
        raw = raw.withColumn("_e164", normalize(F.col("phone")))
    else:
        raw = standard_phones(raw, "phone", "_e164", plans)
    phone = F.col("_e164")
    return raw.select(
        "submission_id",
        T.standard_name(F.col("candidate_name")).alias("candidate_name"),
        blank("email").alias("email"),
        T.valid_email(blank("email")).alias("is_email_valid"),
        phone.alias("phone"),
        phone.isNotNull().alias("is_phone_valid"),
        blank("linkedin").alias("linkedin"),
        blank("github").alias("github"),
    )


def skills(raw: DataFrame, dim: DataFrame) -> DataFrame:
    """Skills with their canonical name, or null; the raw name stays untouched."""
    known = checked_lookup(dim, "alias", "canonical_skill", T.skill_key)
    rows = raw.withColumn("lookup_key", T.skill_key(F.col("skill_name")))
    return rows.join(known, "lookup_key", "left").select(
        "skill_id", "submission_id", F.coalesce("skill_name", F.lit("")).alias("raw_skill"), F.col("canonical_skill").alias("normalized_skill")
    )


def unmatched(rows: DataFrame, k: int) -> DataFrame:
    """The k most frequent skills without a canonical name, ties by name."""
    name = T.clean_skill(F.col("raw_skill")).alias("skill")
    return rows.where("normalized_skill is null").groupBy(name).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "skill").limit(k)


def work_experience(raw: DataFrame, titles: DataFrame, locations: DataFrame) -> DataFrame:
    levels = checked_lookup(titles, "job_title", "seniority_level").withColumnRenamed("lookup_key", "title_key")
    countries = checked_lookup(locations, "location_token", "country").withColumnRenamed("lookup_key", "place_key")
    rows = raw.withColumn("parts", T.location_parts(F.col("location")))
    rows = rows.withColumns(
        {
            "title_key": T.lookup_key(F.col("job_title")),
            "place_key": T.lookup_key(F.try_element_at("parts", F.lit(-1))),
        }
    )
    rows = rows.join(levels, "title_key", "left").join(countries, "place_key", "left")
    return rows.select(
        "experience_id",
        "submission_id",
        T.squeezed(F.coalesce("company_name", F.lit(""))).alias("company_name"),
        T.trimmed(F.coalesce("job_title", F.lit(""))).alias("job_title"),
        T.standard_title(F.col("job_title")).alias("job_title_standardized"),
        "seniority_level",
        T.month_of(F.col("start_date_raw")).alias("start_date"),
        T.month_of(F.col("end_date_raw")).alias("end_date"),
        (F.coalesce("is_current", F.lit(False)) | T.is_open_end(F.col("end_date_raw"))).alias("is_current"),
        T.trimmed(F.coalesce("location", F.lit(""))).alias("location"),
        T.city_of(F.col("parts"), F.col("country")).alias("location_city"),
        F.col("country").alias("location_country"),
        T.is_remote(F.coalesce("location", F.lit(""))).alias("is_remote"),
        "description",
        (F.col("company_website") if "company_website" in raw.columns else F.lit(None).cast("string")).alias("company_website"),
    )


def candidate_summary(rows: DataFrame) -> DataFrame:
    """Rows, invalid addresses, invalid numbers."""
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("is_email_valid")).alias("invalid_emails"), F.count_if(~F.col("is_phone_valid")).alias("invalid_phones"))


def coverage(dim: DataFrame) -> DataFrame:
    """Aliases and canonical skills of a taxonomy."""
    return dim.agg(F.count_distinct(T.skill_key(F.col("alias"))).alias("n_aliases"), F.count_distinct("canonical_skill").alias("n_canonical"))


def problems(as_of) -> Column:
    """The labels of what is wrong with a role's dates; a label can come twice."""
    today = F.lit(as_of).cast("date")
    start, end = F.col("start_date"), F.col("end_date")
    each = [
        F.when(start.isNull(), "unparsed_start_date"),
        F.when(end.isNull() & ~F.col("is_current"), "unparsed_end_date"),
        F.when(start > end, "start_after_end"),
    ]
    for d in (start, end):
        each += [F.when(d > today, "date_in_future"), F.when(F.year(d) < 1950, "implausible_year")]
    return F.array_compact(F.array(*each))


def date_problems(rows: DataFrame, as_of) -> DataFrame:
    """(experience_id, problem): one row for every problem of a role's dates."""
    return rows.select("experience_id", F.explode(problems(as_of)).alias("problem"))


def summarize_gaps(rows: DataFrame, as_of, k: int | None = None) -> DataFrame:
    """(kind, name, n) of what cleaning could not resolve, in one pass over ``rows``.

    kind ``problem``: labels of dates; ``title``: titles without a level; ``location``: locations
    without a country, blank ones left out; ``rows``: how many rows lack a level or a country. Of
    titles and locations the ``k`` most frequent stay (None: all), ties by name, a blank title last.
    """
    blank = F.nullif("job_title", F.lit(""))
    no_level = F.col("seniority_level").isNull()
    no_country = F.col("location_country").isNull() & (F.coalesce("location", F.lit("")) != "")
    item = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    single = F.array_compact(
        F.array(
            F.when(no_level, item("title", blank)), F.when(no_level, item("rows", F.lit("without_seniority"))),
            F.when(no_country, item("location", F.col("location"))), F.when(no_country, item("rows", F.lit("without_country"))),
        )
    )
    every = F.concat(F.transform(problems(as_of), lambda p: item("problem", p)), single)
    counts = rows.select(F.explode(every).alias("x")).groupBy("x.kind", "x.name").agg(F.count("*").alias("n"))
    if k is None:
        return counts
    # labels and sums stand alone in their windows, so one bound on the place serves all
    alone = F.when(F.col("kind").isin("problem", "rows"), F.col("name"))
    place = F.row_number().over(Window.partitionBy("kind", alone).orderBy(F.desc("n"), F.asc_nulls_last("name")))
    return counts.withColumn("place", place).where(F.col("place") <= k).drop("place")
