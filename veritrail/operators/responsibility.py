"""Responsibility signal: people and budgets claimed against the title's level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import budget_millions, people_managed

MANY_PEOPLE = 30


def claims(jobs: DataFrame) -> DataFrame:
    """Roles with the people and the budget (millions) that they claim."""
    return jobs.withColumns({"people": people_managed(F.col("description")), "budget": budget_millions(F.col("description"))})


def signal(jobs: DataFrame) -> DataFrame:
    """One row per candidate: confidence and findings in order of the roles' ids."""
    junior = [r[0] for r in fixed.LADDER if r[3]]
    middle = [r[0] for r in fixed.LADDER if r[1] in ("E3", "E4")]
    level = F.col("seniority_level")
    found = lambda name, claimed, evidence: F.struct(
        "experience_id", F.lit(name).alias("name"), level.alias("level"), claimed.cast("double").alias("claimed"), F.lit(evidence).alias("evidence")
    )
    rows = claims(jobs).withColumn(
        "found",
        F.array_compact(
            F.array(
                F.when(level.isin(junior) & (F.col("people") >= 1), found("junior_managing_team", F.col("people"), "proven")),
                F.when(level.isin(junior) & (F.col("budget") >= 1.0), found("junior_owning_budget", F.col("budget"), "suggestive")),
                F.when(level.isin(middle) & (F.col("people") >= MANY_PEOPLE), found("team_far_above_level", F.col("people"), "suggestive")),
            )
        ),
    )
    per = rows.groupBy("submission_id").agg(
        F.array_sort(F.flatten(F.collect_list("found"))).alias("findings"), F.count(F.nullif(level, F.lit(""))).alias("levelled")
    )
    has = lambda e: F.exists("findings", lambda f: f["evidence"] == e)
    confidence = (
        F.when(F.col("levelled") == 0, "not_evaluated").when(has("proven"), "not_confirmed").when(has("suggestive"), "possible").otherwise("confirmed")
    )
    return per.select("submission_id", confidence.alias("confidence"), "findings")
