"""Names that clash with the operators' own, and empty tables, stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veritrail.llm import copies, decontam, lines, mixing

OWN = ("_row", "_gone", "_whole", "size", "class", "n", "sha", "taken", "id", "key", "line")
KIND = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [(k, f"the {k}th document tells of {k * 7} ships\nand of a harbour that number {k} of them left", "en", "ab"[k % 2], 60) for k in range(12)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges"))
    spark.createDataFrame([(k, int(k == 1)) for k in range(12)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("q", " ".join(f"w{k}" for k in range(12)))], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_clashing_names(spark, folder):
    docs = spark.createDataFrame([*ROWS, (3, ROWS[3][1], "en", "a", 60), (None, None, None, None, None)], KIND)
    more = docs.withColumns({c: F.lit("own") for c in OWN})
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    for name, f in {
        "lines": lambda d: lines.deduped_lines(d, n_chars_col="n_chars"), "bench": lambda d: decontam.decontaminated(d, bench), "copies": copies.without_copies,
        **{name: (lambda d, f=f: f(spark, d, folder)) for name, f in corpus_pipeline.STAGES[1:4]},
    }.items():
        left = f(more)
        assert left.columns == more.columns, name
        rows = left.collect()  # a stage deletes the tables of the one before
        assert rows and all(r[c] == "own" for r in rows for c in OWN), name
        assert sorted(str([r[c] for c in docs.columns]) for r in rows) == sorted(str(list(r)) for r in f(docs).collect()), name
    mixed = corpus_pipeline.mix_sources(spark, more, folder)
    assert mixed.where("_row = 'own' and `class` = 'own' and taken > 0 and size > 0").count() == mixed.count() > 0


def test_empty_tables(spark, folder):
    none = spark.createDataFrame([], KIND)
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    assert decontam.decontaminated(none, bench).count() == 0 == mixing.mixed(none).count()
    docs = spark.createDataFrame(ROWS, KIND)
    assert decontam.decontaminated(docs, bench.limit(0)).count() == len(ROWS)
    for name, f in corpus_pipeline.STAGES:
        left = f(spark, none, folder)
        assert left.count() == 0 and set(none.columns) <= set(left.columns), name
