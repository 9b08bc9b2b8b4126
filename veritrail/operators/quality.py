"""Table checks, each table's counts in one pass; blocking ones raise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import trimmed


class CheckFailed(ValueError):
    """A blocking check found rows."""


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n): null or blank values of each column, by one aggregate."""
    count = [F.count_if(F.col(c).isNull() | (trimmed(F.col(c).cast("string")) == "")).alias(c) for c in columns]
    one = df.agg(*count)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])
    return one.select(F.explode(pairs).alias("p")).select("p.column", "p.n")


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, nulls as one value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return df.join(parents.select(key), key, "left_anti")


def without_entities(texts: DataFrame, roles: DataFrame, skills: DataFrame) -> DataFrame:
    """Texts that gave neither a role nor a skill."""
    return texts.join(roles.select("submission_id"), "submission_id", "left_anti").join(
        skills.select("submission_id"), "submission_id", "left_anti"
    )


def results(counts: DataFrame) -> DataFrame:
    """(passed, description) of (check, n) rows: what was found, in order of names."""
    bad = F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.concat("check", F.lit(" ("), "n", F.lit(" rows)")))))
    return counts.agg(bad.alias("bad")).select((F.size("bad") == 0).alias("passed"), F.array_join("bad", "; ").alias("description"))


def require(counts: DataFrame) -> None:
    row = results(counts).first()
    if not row["passed"]:
        raise CheckFailed(row["description"])


# ---- the four checks: (check, n) of what is wrong, severity and whether a run stops --------------

RAW_TEXTS, ENTITY_IDS, CONTENT, SILENT = "raw_cv_texts_is_usable", "entity_ids_are_unique_and_linked", "entity_content_is_present", "every_cv_produced_entities"
SEVERITY = {RAW_TEXTS: "ERROR", ENTITY_IDS: "ERROR", CONTENT: "WARN", SILENT: "WARN"}


def _named(counts: DataFrame, before: str = "", after: str = " blank") -> DataFrame:
    return counts.select(F.concat(F.lit(before), "column", F.lit(after)).alias("check"), "n")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n")


def raw_texts_usable(texts: DataFrame) -> DataFrame:
    """(check, n): blank ids, texts and hashes, ids that occur more than once."""
    blank = _named(blank_counts(texts, ["submission_id", "raw_text", "content_hash"]))
    return blank.union(_counted(duplicate_values(texts, "submission_id"), "duplicate submission_id"))


def _linked(rows: DataFrame, key: str, texts: DataFrame) -> DataFrame:
    """(blank, twice, lost) of one table, read once: rows without key, keys that occur more than once, rows of no known document."""
    known = texts.select(F.col("submission_id").alias("of")).distinct()
    told = rows.select(F.col(key).alias("key"), "submission_id").join(known, F.col("submission_id") == F.col("of"), "left")
    per = told.groupBy("key").agg(F.count("*").alias("n"), F.count_if(F.col("of").isNull()).alias("lost"))
    blank = F.col("key").isNull() | (trimmed(F.col("key").cast("string")) == "")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return per.agg(total(F.when(blank, F.col("n"))).alias("blank"), F.count_if(F.col("n") > 1).alias("twice"), total("lost").alias("lost"))


def entity_ids(texts: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(check, n) for tables by name, each with its key: blank and repeated keys, rows of no known document."""
    out = None
    for name, (rows, key) in tables.items():
        names = {"blank": f"{name}: blank {key}", "twice": f"{name}: duplicate {key}", "lost": f"{name}: no matching CV"}
        pairs = F.array(*[F.struct(F.lit(told).alias("check"), F.col(c).alias("n")) for c, told in names.items()])
        found = _linked(rows, key, texts).select(F.explode(pairs).alias("p")).select("p.check", "p.n")
        out = found if out is None else out.union(found)
    return out


def entity_content(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(check, n) for tables by name, each with the columns that later steps need."""
    out = None
    for name, (rows, columns) in tables.items():
        found = _named(blank_counts(rows, columns), f"{name}: ")
        out = found if out is None else out.union(found)
    return out


def silent_documents(texts: DataFrame, roles: DataFrame, skills: DataFrame) -> DataFrame:
    """(passed, description) of the documents that gave neither a role nor a skill, out of all."""
    lost = without_entities(texts, roles, skills).agg(F.count("*").alias("silent"))
    both = lost.join(F.broadcast(texts.agg(F.count("*").alias("total"))))  # one row each
    told = F.concat("silent", F.lit(" of "), "total", F.lit(" CVs produced no work experience and no skills"))
    fine = F.concat(F.lit("all "), "total", F.lit(" CVs produced entities"))
    return both.select((F.col("silent") == 0).alias("passed"), F.when(F.col("silent") > 0, told).otherwise(fine).alias("description"))


def checked(name: str, result: DataFrame) -> DataFrame:
    """(check, severity, blocking, passed, description) of one check's result."""
    level = SEVERITY[name]
    return result.select(F.lit(name).alias("check"), F.lit(level).alias("severity"), F.lit(level == "ERROR").alias("blocking"), "passed", "description")


def bronze_checks(texts: DataFrame, candidates: DataFrame, roles: DataFrame, skills: DataFrame) -> DataFrame:
    """All four checks of the landed tables, one row each."""
    keyed = {"raw_candidates": (candidates, "submission_id"), "raw_work_experience": (roles, "experience_id"), "raw_skills": (skills, "skill_id")}
    needed = {
        "raw_candidates": (candidates, ["candidate_name"]),
        "raw_work_experience": (roles, ["company_name", "job_title", "start_date_raw"]),
        "raw_skills": (skills, ["skill_name"]),
    }
    return (
        checked(RAW_TEXTS, results(raw_texts_usable(texts)))
        .union(checked(ENTITY_IDS, results(entity_ids(texts, keyed))))
        .union(checked(CONTENT, results(entity_content(needed))))
        .union(checked(SILENT, silent_documents(texts, roles, skills)))
    )


def stop_on(checks: DataFrame) -> None:
    """Raises if a blocking check failed."""
    bad = [f"{r['check']}: {r['description']}" for r in checks.where("blocking and not passed").collect()]  # a row a check
    if bad:
        raise CheckFailed("; ".join(bad))
