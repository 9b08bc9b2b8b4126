import datetime as dt
import random

from test_rules import AS_OF, plain_facts

from veritrail.operators import timeline
from veritrail.plans.projection import view


def test_every_order_is_a_role(spark, tmp_path):
    """Also those of a customer that holds a third of all orders; the facts against a plain version."""
    rng, rows = random.Random(4), []
    for k in range(180):
        at = dt.datetime(1995, 1, 1) + dt.timedelta(days=rng.randrange(2400))
        rows.append((k, 1 if k % 3 == 0 else rng.randrange(2, 30), rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT", "5-LOW"]), 1.0, at))
    schema = "o_orderkey long, o_custkey long, o_orderpriority string, o_totalprice double, o_orderdate timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/orders.parquet")
    jobs = view(spark, str(tmp_path), "jobs")
    got, each = jobs.collect(), {}
    assert len(got) == 180 == len({r["experience_id"] for r in got})
    end, month = dt.date.fromisoformat(AS_OF), lambda d: d.year * 12 + d.month
    for r in got:
        each.setdefault(r["submission_id"], [])
        if r["start_date"]:
            each[r["submission_id"]].append((month(r["start_date"]), month(r["end_date"] or end), r["seniority_level"]))
    facts = {r["submission_id"]: (r["union_months"], r["overlap"], r["gap"], r["shortfall"]) for r in timeline.facts(jobs, AS_OF).collect()}
    assert len(each["cv_1"]) > 50 and facts == {k: plain_facts(v) for k, v in each.items()}
