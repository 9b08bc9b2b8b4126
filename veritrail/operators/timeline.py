"""Employment-timeline signal: overlaps, gaps, pace of seniority, as windows over month spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import month_index

#: Months: overlaps up to the first bound pass; then minor, plain, severe.
OVERLAP_BOUNDS = (1, 3, 12)
GAP_BOUNDS = (6, 12)
SHORTFALL_BOUND = 72


def spans(jobs: DataFrame, as_of) -> DataFrame:
    """Roles with a start as half-open month spans [a, b); an open or unread end runs to ``as_of``."""
    start = F.col("start_date")
    end = F.greatest(F.coalesce("end_date", F.lit(as_of).cast("date")), start)
    return jobs.where(start.isNotNull()).select(
        "submission_id", "experience_id", "seniority_level", month_index(start).alias("a"), (month_index(end) + 1).alias("b")
    )


def _ladder(pick: int) -> Column:
    out = F.lit(None)
    for row in fixed.LADDER:
        out = F.when(F.col("seniority_level") == row[0], F.lit(row[pick])).otherwise(out)
    return out


def facts(jobs: DataFrame, as_of) -> DataFrame:
    """One row per candidate: n_spans, union_months, overlap, gap, shortfall, n_current, unevaluable.

    Both windows share one exchange and one sort on the candidate. With spans in order of start,
    the months that earlier spans cover beyond a start are one piece up to the latest end.
    """
    start = F.col("start_date")
    end = F.greatest(F.coalesce("end_date", F.lit(as_of).cast("date")), start)
    rows = jobs.select(
        "submission_id", "experience_id", "seniority_level",
        month_index(start).alias("a"), F.when(start.isNotNull(), month_index(end) + 1).alias("b"),
        F.coalesce("is_current", F.lit(False)).alias("now"),
    )
    # rows without a start come first and cover nothing
    before = Window.partitionBy("submission_id").orderBy("a", "b", "experience_id").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("submission_id").orderBy("a").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("reached", F.max("b").over(before))
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce("reached", "a")))
    rows = rows.withColumn("fresh", F.when(F.col("a").isNotNull(), fresh))
    held = F.coalesce(F.sum("fresh").over(earlier), F.lit(0)) - F.greatest(
        F.lit(0), F.coalesce(F.max("b").over(earlier) - F.col("a"), F.lit(0))
    )
    rows = rows.withColumn("short", F.when(~_ladder(3) & F.col("a").isNotNull(), _ladder(2) - held))
    per = rows.groupBy("submission_id").agg(
        F.count("a").alias("n_spans"),
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("union_months"),
        F.max(F.when(F.col("reached").isNotNull(), F.least("reached", "b") - F.col("a"))).alias("overlap"),
        F.max(F.col("a") - F.col("reached")).alias("gap"),
        F.max("short").alias("shortfall"),
        F.count_if("now").alias("n_current"),
        F.count_if(F.col("a").isNull()).alias("unevaluable"),
    )
    positive = {c: F.greatest(F.lit(0), F.coalesce(c, F.lit(0))).cast("long") for c in ("gap", "shortfall")}
    overlap = F.when(F.col("overlap") > OVERLAP_BOUNDS[0], F.col("overlap")).otherwise(0).cast("long")
    return per.withColumns(positive | {"overlap": overlap, "union_months": F.col("union_months").cast("long")})


def signal(jobs: DataFrame, as_of) -> DataFrame:
    """One row per candidate: confidence and findings (name, months, evidence)."""
    found = lambda name, months, evidence: F.struct(
        F.lit(name).alias("name"), months.cast("long").alias("months"), F.lit(evidence).alias("evidence")
    )
    o, g, s = F.col("overlap"), F.col("gap"), F.col("shortfall")
    findings = F.array(
        F.when(o > OVERLAP_BOUNDS[2], found("employment_overlap_severe", o, "proven"))
        .when(o > OVERLAP_BOUNDS[1], found("employment_overlap", o, "proven"))
        .when(o > OVERLAP_BOUNDS[0], found("employment_overlap_minor", o, "suggestive")),
        F.when(g > GAP_BOUNDS[1], found("very_long_gap", g, "proven")).when(g > GAP_BOUNDS[0], found("long_gap", g, "proven")),
        F.when(s > SHORTFALL_BOUND, found("seniority_implausible", s, "suggestive")),
        F.when(F.col("n_current") > 1, found("multiple_current_roles", F.lit(None), "proven")),
        F.when(F.col("unevaluable") > 0, found("unevaluable_dates", F.col("unevaluable"), "data_issue")),
    )
    rows = facts(jobs, as_of).withColumn(
        "findings", F.when(F.col("n_spans") > 0, F.array_compact(findings)).otherwise(F.array_compact(F.slice(findings, 1, 0)))
    )
    has = lambda e: F.exists("findings", lambda f: f["evidence"] == e)
    confidence = (
        F.when(F.col("n_spans") == 0, "not_evaluated").when(has("proven"), "not_confirmed").when(has("suggestive"), "possible").otherwise("confirmed")
    )
    return rows.select("submission_id", confidence.alias("confidence"), "findings")


def summary(signals: DataFrame) -> DataFrame:
    """Counts of each confidence and of each finding's name."""
    by_confidence = signals.groupBy(F.lit("confidence").alias("kind"), F.col("confidence").alias("name")).agg(F.count("*").alias("n"))
    names = signals.select(F.explode("findings").alias("f")).groupBy(F.lit("finding").alias("kind"), F.col("f.name").alias("name"))
    return by_confidence.union(names.agg(F.count("*").alias("n")))
