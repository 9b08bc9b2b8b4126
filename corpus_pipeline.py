"""A training corpus from ``documents``: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from veritrail.llm import common, decontam, jaccard, lines, mixing, toxicity


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@common.stage
def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model rejects go; null and empty texts score as an empty word."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


@common.stage
def drop_lines(spark, docs, sf_dir):
    """Lines that repeat an earlier one go, and documents made of such lines alone; documents without lines stay."""
    return lines.deduped_lines(docs, n_chars_col="n_chars")


@common.stage
def drop_near_copies(spark, docs, sf_dir):
    """One document of each class of near copies stays: the one of the smallest id, rows without id last.

    Each row is a document of its own; rows that share an id are told apart. Texts without words stay.
    """
    row = common.spare(docs.columns, "_row")
    rows = common.keyed(docs, row)
    classes = jaccard.shingle_classes(rows.select(row, "text"), id_col=row).select(row, F.col("component_id").alias("class"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    first = rows.select("doc_id", row).join(classes, row).groupBy("class").agg(F.min(place).alias("first"))
    return rows.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").select(*docs.columns)


@common.stage
def drop_benchmark(spark, docs, sf_dir):
    """Documents that hold a window of the benchmark go; texts without words stay."""
    return decontam.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


@common.stage
def mix_sources(spark, docs, sf_dir):
    """The mix: documents that it takes, with the copies and words taken, each row for itself.

    Columns of ``docs`` that are called like the mix's own give way to them.
    """
    row = common.spare(docs.columns, "_row")
    rows = common.keyed(docs, row)
    own = ("size", "source_size", "target", "taken", "copies")
    taken = mixing.mixed(rows.select(row, "text", "source"), id_col=row).where("copies > 0").select(row, *own)
    kept = [c for c in docs.columns if c.lower() not in own]
    return rows.select(row, *kept).join(taken, row).drop(row)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Training a classifier is beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
