import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from veritrail.functions import text as T
from veritrail.operators import cleaning, company, quality, responsibility, timeline
from veritrail.sources.tables import Catalog

JOBS = "submission_id string, experience_id string, seniority_level string, start_date date, end_date date, is_current boolean"
AS_OF = "2026-01-01"


def day(y, m):
    return dt.date(y, m, 1)


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("value", "people"),
    [("Mentored a team of 24", 24), ("12 direct reports", 12), ("used by 30+ analysts", 0), ("led 30+ engineers", 30), ("group of 5 servers", 5), (None, 0)],
)
def test_people(spark, value, people):
    assert one(spark, value, T.people_managed) == people


@pytest.mark.parametrize(("value", "m"), [("budget of $8.7 million", 8.7), ("budget of £4.2.1M", 0.0), ("profit of 4.7m", 0.0), ("budget of 3bn", 3.0)])
def test_budget(spark, value, m):
    assert one(spark, value, T.budget_millions) == m


def test_months(spark):
    got = [one(spark, x, T.month_of) for x in ("August 2017", "Jul  2021", "Present", "", None, "Sept 2017")]
    assert got == [day(2017, 8), day(2021, 7), None, None, None, None]


def test_names(spark):
    rows = spark.createDataFrame([("Acme Ltd", "ACME Limited"), ("Monzo", "Monzo Bank"), ("Acme", "Acne"), ("Ltd", "Ltd")], "a string, b string")
    got = rows.select(T.name_match(T.company_name(F.col("a")), T.company_name(F.col("b"))).alias("m"))
    assert [r["m"] for r in got.collect()] == ["exact", "partial", "different", "different"]


def plain_facts(jobs):
    """Pairs and month sets of one candidate's (start, end, level) months."""
    spans = sorted((a, max(a, b) + 1, lv) for a, b, lv in jobs)
    months = {m for a, b, _ in spans for m in range(a, b)}
    overlap = max((min(x[1], y[1]) - max(x[0], y[0]) for i, x in enumerate(spans) for y in spans[i + 1 :]), default=0)
    known = sorted(months)
    gap = max((b - a - 1 for a, b in zip(known, known[1:], strict=False)), default=0)
    need = {"Senior": 48, "Staff": 84, "Principal": 132}
    short = max((need[lv] - len({m for c, d, _ in spans if c < a for m in range(c, d) if m < a}) for a, _, lv in spans if lv in need), default=0)
    return len(months), overlap if overlap > 1 else 0, gap, max(0, short)


def test_timeline_against_plain(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for k in range(300):
        jobs = []
        for j in range(rng.randint(1, 6)):
            a = 2000 * 12 + rng.randrange(120)
            b = a + rng.randrange(-3, 40)
            level = rng.choice([None, "Junior", "Senior", "Staff", "Principal"])
            jobs.append((a, b, level))
            rows.append((f"c{k}", f"c{k}_{j}", level, day(a // 12, a % 12 + 1), day(b // 12, b % 12 + 1), False))
        want[f"c{k}"] = plain_facts(jobs)
    got = timeline.facts(spark.createDataFrame(rows, JOBS), AS_OF).collect()
    assert {r["submission_id"]: (r["union_months"], r["overlap"], r["gap"], r["shortfall"]) for r in got} == want


def test_timeline_signal(spark):
    rows = [
        ("clean", "1", "Mid", day(2015, 8), day(2017, 12), False), ("clean", "2", "Mid", day(2018, 1), None, True),
        ("none", "1", "Mid", None, None, False), ("two", "1", None, day(2020, 1), None, True), ("two", "2", None, day(2025, 12), None, True),
    ]
    got = {r["submission_id"]: (r["confidence"], [f["name"] for f in r["findings"]]) for r in timeline.signal(spark.createDataFrame(rows, JOBS), AS_OF).collect()}
    assert got["clean"] == ("confirmed", [])
    assert got["none"] == ("not_evaluated", [])
    assert got["two"][1] == ["employment_overlap_minor", "multiple_current_roles"]


def test_responsibility(spark):
    rows = [("a", "1", "Junior", "team of 3"), ("b", "1", "Senior", "team of 29"), ("c", "1", "Senior", "team of 30"), ("d", "1", None, "team of 90")]
    got = responsibility.signal(spark.createDataFrame(rows, "submission_id string, experience_id string, seniority_level string, description string"))
    assert {r["submission_id"]: r["confidence"] for r in got.collect()} == {
        "a": "not_confirmed", "b": "confirmed", "c": "possible", "d": "not_evaluated",
    }


def test_company_order(spark):
    roles = spark.createDataFrame([("s", "e", "Acme Ltd")], "submission_id string, experience_id string, company_name string")
    register = spark.createDataFrame([("acme", [("1", "Acme Group"), ("2", "ACME LIMITED")])], "query_normalized string, results array<struct<company_number:string,title:string>>")
    row = company.statuses(company.matches(roles, register)).first()
    assert (row["matched_company_number"], row["status"]) == ("2", "confirmed")


def test_conflicting_reference(spark):
    dim = spark.createDataFrame([("A", "x"), (" a", "y")], "alias string, canonical_skill string")
    with pytest.raises(cleaning.ReferenceConflict, match="a"):
        cleaning.require_unambiguous(dim, "alias", "canonical_skill")
    with pytest.raises(Exception, match="means more than one"):
        cleaning.checked_lookup(dim, "alias", "canonical_skill").collect()


def test_checks(spark):
    df = spark.createDataFrame([(None,), (" ",), ("x",)], "c string")
    counts = quality.blank_counts(df, ["c"]).withColumnRenamed("column", "check")
    assert quality.results(counts).first()["description"] == "c (2 rows)"
    with pytest.raises(quality.CheckFailed):
        quality.require(counts)


def test_tables(spark, tmp_path):
    c = Catalog(spark, str(tmp_path), {"bronze.t": "submission_id string, v int"})
    assert c.read("bronze.t").count() == 0
    c.replace("bronze.t", spark.createDataFrame([("a", 1), ("b", 2)], "submission_id string, v int"))
    c.append("bronze.t", spark.createDataFrame([("c",)], "submission_id string"))
    c.delete(["bronze.t"], spark.createDataFrame([("b",)], "submission_id string"))
    assert sorted(r["submission_id"] for r in c.read("bronze.t").collect()) == ["a", "c"]
    c.replace("bronze.t", c.read("bronze.t").limit(0))
    assert c.read("bronze.t").count() == 0
    with pytest.raises(ValueError):
        c.path("lead.t")
