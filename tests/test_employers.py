import random
from collections import Counter

from veritrail.operators import company
from veritrail.plans import catalog

ROLES = "submission_id string, experience_id string, company_name string"
REGISTER = "query_normalized string, results array<struct<company_number:string,title:string>>"
ANSWERS = [
    ("acme", [("1", "Other"), ("2", "Acme Group"), ("3", "ACME LTD"), ("4", "Acme")]),
    ("bolt works", [("5", "Works"), ("6", None), ("7", "The Bolt Works")]),
    ("cove", []),
    ("dune", None),
    ("", [("8", "Limited")]),
]
#: What each spelling gets: number, status, searched.
WANT = {
    "Acme Ltd": ("3", "confirmed", True), " ACME, limited": ("3", "confirmed", True), "Bolt-Works": ("5", "partial_match", True),
    "Cove": (None, "unconfirmed", True), "Dune": (None, "unconfirmed", False), "Elm": (None, "unconfirmed", False),
    "Ltd": (None, "unconfirmed", True), None: (None, "unconfirmed", True),
}


def _tables(spark):
    rng = random.Random(5)
    named = [rng.choice(list(WANT)) for _ in range(300)]
    roles = spark.createDataFrame([(f"s{k}", f"e{k}", n) for k, n in enumerate(named)], ROLES)
    return named, roles, spark.createDataFrame(ANSWERS, REGISTER)


def test_statuses_of_counted_spellings(spark):
    """As many as role by role, null names and answers among them."""
    named, roles, register = _tables(spark)
    got = company.statuses(company.matches(roles, register)).collect()
    assert {r["experience_id"]: (r["matched_company_number"], r["status"], r["searched"]) for r in got} == {f"e{k}": WANT[n] for k, n in enumerate(named)}
    counted = company.status_counts(company.spellings(roles), register)
    assert {r["status"]: r["n"] for r in counted.collect()} == Counter(WANT[n][1] for n in named)
    assert company.status_counts(company.spellings(roles.limit(0)), register).count() == 0


def test_answers_are_judged_before_the_join(spark):
    """Once a name of the register, not once a role."""
    _, roles, register = _tables(spark)
    plan = company.matches(roles, register)._jdf.queryExecution().optimizedPlan().toString()
    above, found, below = plan.partition("Join LeftOuter")
    assert found and "array_except" in below and "array_except" not in above


def test_roles_are_read_once_for_statuses(spark):
    """The result reads the kept spellings, no orders any more."""
    files = catalog.queries()["company_status"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not any("orders.parquet" in f for f in files)
