"""Résumé-shaped views of the standard tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2026-01-01"
_NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def _month(mi: str) -> str:
    whole = f"CAST(floor(({mi}) / 12) AS INT)"
    return f"make_date({whole}, CAST(({mi}) % 12 AS INT) + 1, 1)"


def _spoken(mi: str, short: bool) -> str:
    cases = " ".join(f"WHEN {k} THEN '{n[:3] if short else n}'" for k, n in enumerate(_NAMES))
    return f"concat(CASE CAST(({mi}) % 12 AS INT) {cases} END, ' ', CAST(CAST(floor(({mi}) / 12) AS INT) AS VARCHAR(9)))"


_ROLES = """
SELECT t.*, CASE WHEN nx IS NULL THEN NULL ELSE greatest(s, nx + CASE o_orderkey % 12 WHEN 0 THEN -16 WHEN 1 THEN -9
         WHEN 2 THEN 1 WHEN 3 THEN 5 WHEN 4 THEN 15 ELSE -1 END) END AS e
FROM (SELECT r.*, lead(s) OVER (PARTITION BY o_custkey ORDER BY k) AS nx FROM (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, CAST(year(o_orderdate) * 12 + month(o_orderdate) - 1 AS INT) AS s,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) r) t
"""
_LEVEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Junior' WHEN '2-HIGH' THEN 'Senior' WHEN '3-MEDIUM' THEN 'Staff'
            WHEN '5-LOW' THEN 'Principal' END"""

VIEWS = {
    "jobs": f"""
SELECT concat('cv_', CAST(o_custkey AS VARCHAR(20))) AS submission_id,
       concat('cv_', CAST(o_custkey AS VARCHAR(20)), '_job', CAST(k AS VARCHAR(9))) AS experience_id,
       {_LEVEL} AS seniority_level, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE {_month("s")} END AS start_date,
       CASE WHEN e IS NULL THEN NULL ELSE {_month("e")} END AS end_date, (nx IS NULL OR o_orderkey % 53 = 0) AS is_current,
       CASE WHEN o_orderkey % 6 = 0 THEN concat('Led a team of ', CAST(o_orderkey % 60 AS VARCHAR(9)), ' across sites.')
            WHEN o_orderkey % 6 = 1 THEN concat('Had ', CAST(o_orderkey % 45 AS VARCHAR(9)), ' direct reports and a department of 12')
            WHEN o_orderkey % 6 = 2 THEN concat('Reports used by ', CAST(o_orderkey % 60 AS VARCHAR(9)), ' analysts')
            WHEN o_orderkey % 6 = 3 THEN concat('Owned a $', CAST(o_orderkey % 9 AS VARCHAR(9)), '.5 million budget')
            WHEN o_orderkey % 6 = 4 THEN concat('managed ', CAST(o_orderkey % 50 AS VARCHAR(9)), '+ engineers with a budget of £4.2.1M')
       END AS description
FROM ({_ROLES}) q""",
    "raw_jobs": f"""
SELECT concat('cv_', CAST(o_custkey AS VARCHAR(20))) AS submission_id,
       concat('cv_', CAST(o_custkey AS VARCHAR(20)), '_job', CAST(k AS VARCHAR(9))) AS experience_id,
       concat('Supplier  ', CAST(o_orderkey % 40 AS VARCHAR(9)), CASE o_orderkey % 5 WHEN 0 THEN ' Ltd' WHEN 1 THEN ' Limited.'
              WHEN 2 THEN ' Holdings plc' WHEN 3 THEN ' Co' ELSE '' END) AS company_name,
       concat(CASE WHEN k = 1 THEN ' ' ELSE '' END, coalesce({_LEVEL}, 'Chief'), CASE o_orderkey % 4 WHEN 0 THEN ' Data-Engineer (BI)' WHEN 1 THEN '  analyst'
              WHEN 2 THEN '/SRE_2' ELSE '' END) AS job_title,
       CASE WHEN o_orderkey % 13 = 0 THEN 'Q1 1999' WHEN o_orderkey % 7 = 0 THEN lower({_spoken("s", False)})
            WHEN o_orderkey % 2 = 0 THEN {_spoken("s", False)} ELSE replace({_spoken("s", True)}, ' ', '  ') END AS start_date_raw,
       CASE WHEN e IS NULL THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Present' WHEN o_orderkey % 3 = 1 THEN ' current ' ELSE 'soon' END
            WHEN o_orderkey % 31 = 0 THEN 'May 2999' ELSE {_spoken("e", True)} END AS end_date_raw,
       o_orderkey % 53 = 0 AS is_current,
       CASE o_orderkey % 7 WHEN 0 THEN concat('Remote / City', CAST(k AS VARCHAR(9)), ', ', n_name) WHEN 1 THEN n_name
            WHEN 2 THEN concat('Dock Office, ', n_name) WHEN 3 THEN 'Remote' WHEN 4 THEN '' WHEN 5 THEN 'Somewhere, Nowhere'
            ELSE concat('Wharf,  Town', CAST(k AS VARCHAR(9)), ' , ', n_name) END AS location,
       CAST(NULL AS VARCHAR(9)) AS description
FROM ({_ROLES}) q JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""",
    "titles": """
SELECT DISTINCT concat(l, x) AS job_title, l AS seniority_level
FROM (SELECT 'Junior' AS l UNION ALL SELECT 'Senior' UNION ALL SELECT 'Staff') a
CROSS JOIN (SELECT ' data-engineer (bi)' AS x UNION ALL SELECT ' Analyst' UNION ALL SELECT '') b""",
    "places": "SELECT n_name AS location_token, concat('Country ', CAST(n_nationkey AS VARCHAR(9))) AS country FROM nation WHERE n_nationkey < 20",
    "people": """
SELECT concat('cv_', CAST(c_custkey AS VARCHAR(20))) AS submission_id, concat('  ', replace(c_name, '#', '   '), ' ') AS candidate_name,
       CASE c_custkey % 5 WHEN 0 THEN concat(' user', CAST(c_custkey AS VARCHAR(20)), '@mail.example.com') WHEN 1 THEN 'no at.example.com'
            WHEN 2 THEN concat('a', CAST(c_custkey AS VARCHAR(20)), '@nodot') WHEN 3 THEN concat('x.y+', CAST(c_custkey AS VARCHAR(20)), '@b-c.co') END AS email,
       CASE c_custkey % 6 WHEN 0 THEN concat('+44 7', CAST(100000000 + c_custkey AS VARCHAR(20))) WHEN 1 THEN '12345'
            WHEN 2 THEN concat('07', CAST(100000000 + c_custkey AS VARCHAR(20))) WHEN 3 THEN concat('+1 (212) 5', CAST(100000 + c_custkey AS VARCHAR(20)))
            WHEN 4 THEN concat('0033 6 1', CAST(1000000 + c_custkey AS VARCHAR(20))) END AS phone,
       concat(' linkedin.com/in/', CAST(c_custkey AS VARCHAR(20))) AS linkedin, CAST(NULL AS VARCHAR(9)) AS github
FROM customer""",
    "raw_skills": """
SELECT concat('s', CAST(p_partkey AS VARCHAR(20))) AS skill_id, concat('cv_', CAST(p_partkey % 3000 AS VARCHAR(9))) AS submission_id,
       CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN replace(p_name, ' ', '   ') WHEN 2 THEN concat(' ', p_name) ELSE p_name END AS skill_name
FROM part""",
    "dim_skills": """
SELECT DISTINCT p_name AS alias, upper(p_name) AS canonical_skill FROM part WHERE length(p_name) % 2 = 0""",
    "texts": """
SELECT concat('cv_', CAST(3 * doc_id AS VARCHAR(20))) AS submission_id, text AS raw_text, source AS folder,
       concat('gs://cvs/raw/', source, '/cv_', CAST(3 * doc_id AS VARCHAR(20)), '.pdf') AS path, doc_id FROM documents""",
    "replies": """
SELECT concat('cv_', CAST(event_id AS VARCHAR(20))) AS submission_id,
       concat(CASE WHEN event_id % 3 = 0 THEN concat('```json', chr(10)) ELSE '' END, '{"candidate_name": "',
              CASE WHEN event_id % 11 = 0 THEN 'Unknown' ELSE concat('Person ', CAST(user_id AS VARCHAR(20))) END,
              '", "skills": ["', event_type, '", " ', upper(event_type), '", "Power BI", ""], "work_experience": [{"job_title": "',
              CASE WHEN event_id % 17 = 0 THEN 'TBD' ELSE 'Analyst' END, '", "company_name": "Acme ', CAST(event_id % 9 AS VARCHAR(9)), '"}',
              CASE WHEN event_id % 2 = 0 THEN ', {"job_title": "Clerk", "company_name": "Zed", "end_date": "May 2020"}' ELSE '' END, ']}',
              CASE WHEN event_id % 3 = 0 THEN concat(chr(10), '```') ELSE '' END) AS reply, event_id, event_type FROM events""",
    "odd_replies": """
SELECT concat('cv_', CAST(event_id AS VARCHAR(20))) AS submission_id, event_id % 16 AS kind,
       CASE event_id % 16 WHEN 0 THEN '{"candidate_name": "Ann", "email": null}' WHEN 1 THEN '{"candidate_name": "Ann", "email": "a@b.c"}'
            WHEN 2 THEN '{"candidate_name": "Ann", "work_experience": null}' WHEN 3 THEN '{"candidate_name": "Ann", "skills": [1]}'
            WHEN 4 THEN '{"candidate_name": "Ann", "skills": ["x", "X "]}' WHEN 5 THEN '{"candidate_name": 5}'
            WHEN 6 THEN concat('{"candidate_name": "', repeat('n', 200), '"}') WHEN 7 THEN concat('{"candidate_name": "', repeat('n', 201), '"}')
            WHEN 8 THEN '{"candidate_name": "Ann", "work_experience": [{"job_title": "Clerk", "company_name": "Zed", "is_current": "yes"}]}'
            WHEN 9 THEN '{"candidate_name": "Ann", "work_experience": [{"job_title": "Clerk", "company_name": "Zed", "is_current": 2}]}'
            WHEN 10 THEN '{"candidate_name": "Ann", "work_experience": [{"job_title": "Clerk"}]}' WHEN 11 THEN 'no record'
            WHEN 12 THEN concat('{"candidate_name": "Ann", "work_experience": [{"job_title": "Clerk", "company_name": "Zed", "company_website": "',
                                repeat('w', 500), '"}]}')
            WHEN 13 THEN concat('{"candidate_name": "Ann", "phone": "', repeat('0', 51), '"}') WHEN 14 THEN '[]'
            ELSE '{"candidate_name": " candidate "}' END AS reply FROM events""",
}
#: For numbers by plan: calling code, first digits and length of the national number.
DIALLED = (
    ("1", "212555", 10), ("27", "82", 9), ("30", "69", 10), ("31", "6", 9), ("32", "47", 9), ("33", "6", 9), ("34", "61", 9), ("36", "20", 9),
    ("39", "347", 10), ("40", "72", 9), ("41", "79", 9), ("43", "664", 10), ("44", "79", 10), ("45", "20", 8), ("46", "70", 9), ("48", "60", 9),
    ("49", "151", 11), ("61", "4", 9), ("64", "21", 9), ("81", "90", 10), ("86", "138", 11), ("90", "532", 10), ("91", "98", 10), ("351", "91", 9),
    ("353", "87", 9), ("358", "40", 9), ("420", "60", 9),
)
_DIALLED = ", ".join(f"('{c}', '{d}', {n}, {k})" for k, (c, d, n) in enumerate(DIALLED))
VIEWS |= {
    "numbers": f"""
SELECT concat('cv_', CAST(c_custkey AS VARCHAR(20))) AS submission_id,
       CASE WHEN c_custkey % 5 = 0 THEN concat('+', code, ' ', substring(rest, 1, 3)) WHEN c_custkey % 5 = 1 THEN concat('00', code, '-', rest)
            WHEN c_custkey % 5 = 2 THEN concat('+', code, ' (', substring(rest, 1, 2), ') ', substring(rest, 3, 20)) ELSE concat('+', code, rest) END AS phone,
       CASE WHEN c_custkey % 5 <> 0 THEN concat('+', code, rest) END AS e164
FROM (SELECT c_custkey, code, concat(lead, lpad(CAST(c_custkey % 10000 AS VARCHAR(9)), CAST(n - length(lead) AS INT), '0')) AS rest
      FROM customer JOIN (SELECT * FROM (VALUES {_DIALLED}) AS v(code, lead, n, k)) plans ON c_custkey % {len(DIALLED)} = k) x""",
    "recorded": f"""
SELECT concat('cv_', CAST(o_custkey AS VARCHAR(20))) AS id, concat_ws('|',
         CASE WHEN max(CASE WHEN o_orderkey % 12 IN (2, 3, 4) AND nx IS NOT NULL THEN 1 ELSE 0 END) = 1 THEN 'date_overlap' END,
         CASE WHEN max(CASE WHEN o_orderkey % 12 IN (0, 1) AND nx IS NOT NULL THEN 1 ELSE 0 END) = 1 THEN 'career_gap' END,
         CASE WHEN max(CASE WHEN o_orderkey % 6 = 0 AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) = 1 THEN 'career_incoherent' END) AS flaws
FROM ({_ROLES}) q GROUP BY o_custkey""",
    "register": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS company_number,
       concat(CASE s_suppkey % 5 WHEN 0 THEN 'Group Supplier ' WHEN 1 THEN 'HOLDINGS, Supplier ' WHEN 2 THEN '' WHEN 3 THEN 'Trading ' ELSE 'SUPPLIER  ' END,
              CAST(s_suppkey % 50 AS VARCHAR(9)), CASE s_suppkey % 3 WHEN 0 THEN ' Ltd.' WHEN 1 THEN ' (UK) Limited' ELSE '' END) AS title
FROM supplier""",
}
TABLES = ("orders", "customer", "nation", "part", "documents", "events", "supplier")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f" {t}" in VIEWS[name]}
    text = VIEWS[name].replace("{", "{{").replace("}", "}}")
    for t in used:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {t}", f"{word} {{{t}}}")
    return spark.sql(text.replace("VARCHAR(9)", "STRING").replace("VARCHAR(20)", "STRING"), **used)


def with_views(*names: str) -> str:
    """The WITH clause of views for a DuckDB query."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
