"""The operators applied to the standard tables, with their results' digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import conversations, copies, decontam, html_text, jaccard, licenses, lines, mixing, pii, quality, topk, toxicity, whitening
from .common import keyed


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark, sf_dir):
    """Licence families of every document, with counts of its paragraphs; null texts have none."""
    return licenses.license_scan(_table(spark, sf_dir, "documents")).drop("findings")


def op2_line_dedup(spark, sf_dir):
    """Lines of every document that repeat an earlier one, counted."""
    return lines.line_counts(_table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    """Quality of every document; the model learns outside the held-out fold."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_jaccard(spark, sf_dir):
    """Size of every document's shingle set and its class of near copies."""
    return jaccard.shingle_classes(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    """Toxicity of every document; the model learns outside the held-out fold."""
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_mixing(spark, sf_dir):
    """How many words of every document the mix takes."""
    return mixing.mixed(_table(spark, sf_dir, "documents")).drop("copies")


def op7_pii(spark, sf_dir):
    """Spans of personal data in every document, counted and hashed."""
    return pii.digest(pii.personal_data(_table(spark, sf_dir, "documents")))


def op8_topk(spark, sf_dir):
    """The ten best candidates of every hundredth vector; each row is asked and found for itself."""
    rows = keyed(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return topk.top_k(rows, rows.where("vec_id % 100 = 0"), row_col="_row")


def op9_decontamination(spark, sf_dir):
    """Words of every document inside windows of the benchmark, and the items they belong to."""
    found = decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op10_html_text(spark, sf_dir):
    """The main text of every page."""
    return html_text.extracted(_table(spark, sf_dir, "pages"))


def op11_repair(spark, sf_dir):
    """Faults and cheapest repair of every conversation after the test's damage."""
    return conversations.repair_report(_table(spark, sf_dir, "conversations"))


def op12_whitening(spark, sf_dir):
    """Every usable vector on the first four whitened components."""
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark, sf_dir):
    """The group of equal texts of every document and which row of it stays."""
    return copies.exact_copies(_table(spark, sf_dir, "documents"))


def queries():
    found = (
        op1_license_scan, op2_line_dedup, op3_quality, op4_jaccard, op5_toxicity,
        op6_mixing, op7_pii, op8_topk, op9_decontamination, op10_html_text,
        op11_repair, op12_whitening, op13_exact_dedup,
    )
    return {f.__name__: f for f in found}


def oracle_sql():
    """SQL for those that have it; the others are tested against plain versions in tests/llm."""
    return {
        "op1_license_scan": licenses.license_sql(),
        "op2_line_dedup": lines.LINES_SQL,
        "op4_jaccard": jaccard.CLASSES_SQL,
        "op8_topk": topk.TOP_SQL,
        "op9_decontamination": decontam.CONTAMINATION_SQL,
        "op11_repair": conversations.REPAIR_SQL,
        "op13_exact_dedup": copies.COPIES_SQL,
    }
