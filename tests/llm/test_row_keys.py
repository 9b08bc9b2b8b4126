import corpus_pipeline
from veritrail.llm import decontam, lines

PASSAGE = "the seventh lighthouse keeper counted eleven silver herrings before the evening tide returned again"


def test_rows_with_null_or_equal_ids(spark, tmp_path):
    """A copy, a repeated line or a hit takes its own row along, not the others of its id."""
    own = [" ".join(f"{a}{k}{b * 3}" for b in "qwertzuiop") for k, a in enumerate("abcdef")]
    rows = [(1, "a line that stands in two documents\n" + own[0])]
    for key, (one, two) in ((None, own[1:3]), (7, own[3:5])):
        rows += [(key, f"a line that stands in two documents\n{one}"), (key, two), (key, f"{PASSAGE} {key}"), (key, own[5])]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in rows], "doc_id long, text string, n_chars long")
    spark.createDataFrame([("q", PASSAGE)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = lambda df: sorted(((r["doc_id"] or 0, r["text"]) for r in df.collect()))
    got = found(lines.deduped_lines(docs, n_chars_col="n_chars"))
    # null ids are earliest: their line stays with one row, 1 and 7 lose it
    want = [(0, rows[1][1]), (0, own[2]), (0, f"{PASSAGE} None"), (0, own[5]), (1, own[0]), (7, own[3]), (7, own[4]), (7, f"{PASSAGE} 7")]
    assert got == sorted(want)
    got = found(corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)))
    assert [t for k, t in got if t == own[5]] == [own[5]] and (7, own[5]) in got
    assert {t for _, t in rows if PASSAGE not in t} == {t for _, t in got if PASSAGE not in t}
    got = found(decontam.decontaminated(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet")))
    assert got == sorted((k or 0, t) for k, t in rows if PASSAGE not in t)
