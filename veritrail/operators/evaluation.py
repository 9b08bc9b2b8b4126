"""How well the signals find flaws that were planted in recorded documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Findings that show a planted flaw; flaws without an entry have no signal yet.
SHOWN_BY = {
    "date_overlap": ("employment_overlap_severe", "employment_overlap", "employment_overlap_minor"),
    "career_incoherent": ("seniority_implausible", "junior_managing_team", "junior_owning_budget", "team_far_above_level"),
    "fictional_company": ("unconfirmed",),
    "fictional_company_2": ("unconfirmed",),
    "company_substitution": ("unconfirmed",),
}
NONE = "none"


def found(signals: list[DataFrame], verdicts: DataFrame | None = None) -> DataFrame:
    """(submission_id, name), each once: the findings of signal tables, and the statuses of employers."""
    parts = [s.select("submission_id", F.explode("findings.name").alias("name")) for s in signals]
    if verdicts is not None:
        parts.append(verdicts.select("submission_id", F.col("status").alias("name")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.where("submission_id is not null and name is not null").distinct()


def planted(truth: DataFrame) -> DataFrame:
    """(submission_id, flaw), each once, of records (submission_id, inconsistency_types); a document can be recorded twice."""
    return truth.where("submission_id is not null").select("submission_id", F.explode("inconsistency_types").alias("flaw")).distinct()


def _claims(names: DataFrame, shown_by: dict[str, tuple[str, ...]]) -> DataFrame:
    """(submission_id, flaw): what the findings say was planted; a finding can show several flaws."""
    flaws: dict[str, list[str]] = {}
    for flaw, shows in shown_by.items():
        for name in shows:
            flaws.setdefault(name, []).append(flaw)
    if not flaws:
        return names.select("submission_id", F.col("name").alias("flaw")).limit(0)
    pairs = [x for name, of in flaws.items() for x in (F.lit(name), F.array(*map(F.lit, of)))]
    return names.select("submission_id", F.explode(F.try_element_at(F.create_map(*pairs), "name")).alias("flaw")).distinct()


def scores(truth: DataFrame, names: DataFrame, shown_by: dict[str, tuple[str, ...]] = SHOWN_BY) -> DataFrame:
    """(flaw, planted, claimed, hits, missed, false_alarms, clean, precision, recall), a row for every flaw planted or claimed.

    Only recorded documents count, those without flaws too. A full outer join by document and flaw
    tells hits from misses and false alarms. precision is null where nothing is claimed, recall
    where nothing is planted. No records give no rows.
    """
    recorded = truth.where("submission_id is not null").select("submission_id").distinct()
    total = recorded.agg(F.count("*").alias("total"))
    claims = _claims(names.join(recorded, "submission_id", "left_semi"), shown_by).withColumn("is_claimed", F.lit(True))
    both = planted(truth).withColumn("is_planted", F.lit(True)).join(claims, ["submission_id", "flaw"], "full_outer")
    count = lambda c: F.count(F.when(c, 1))
    said, true = F.col("is_claimed").isNotNull(), F.col("is_planted").isNotNull()
    per = both.groupBy("flaw").agg(
        count(true).alias("planted"),
        count(said).alias("claimed"),
        count(true & said).alias("hits"),
        count(true & ~said).alias("missed"),
        count(said & ~true).alias("false_alarms"),
    )
    told = per.join(F.broadcast(total))  # one row
    return told.select(
        *per.columns,
        (F.col("total") - F.col("hits") - F.col("missed") - F.col("false_alarms")).alias("clean"),
        F.try_divide("hits", "claimed").alias("precision"),
        F.try_divide("hits", "planted").alias("recall"),
    )


def confusion(truth: DataFrame, names: DataFrame) -> DataFrame:
    """(flaw, name, n): recorded documents by planted flaw and finding, ``none`` where there is no other side.

    A document with several flaws or findings counts once for each pair of them; it has few of both.
    """
    recorded = truth.where("submission_id is not null").select("submission_id").distinct()
    flaws = recorded.join(planted(truth), "submission_id", "left")
    both = flaws.join(names, "submission_id", "left")
    keys = [F.coalesce(c, F.lit(NONE)).alias(c) for c in ("flaw", "name")]
    return both.groupBy(*keys).agg(F.count("*").alias("n"))
