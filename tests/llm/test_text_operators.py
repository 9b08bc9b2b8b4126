import random
import re

import pytest
from pyspark.sql import functions as F

from veritrail.llm import decontam, html_text, jaccard, licenses, lines, mixing, pii, quality, topk, toxicity

DOCS = "doc_id long, text string, source string, label string, n long"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank and very long texts, ties and repeated rows, clashing names."""
    long = " ".join(f"w{k}" for k in range(30000))
    rows = [(1, None, "a", "x", 1), (2, "", None, "x", 1), (3, " \n\t\n", "a", None, 1), (4, long, "b", "x", 1), (4, long, "b", "x", 1),
            (5, long + " more", "b", "x", None), (None, "same line of some length here", None, "x", 1), (6, "same line of some length here", "a", "x", 1),
            (7, "same line of some lengthy here", "a", "x", 1)]
    return spark.createDataFrame(rows, DOCS)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(100, 112))), (2, None), (3, "")], "item_id long, text string")
    for empty in (False, True):
        docs = odd.limit(0) if empty else odd
        n = 0 if empty else 9
        assert licenses.license_scan(docs).count() == n
        assert quality.quality_scores(docs, labels).where("score between 0 and 1").count() == n
        assert toxicity.toxicity_scores(docs, labels).where("score between 0 and 1").count() == n
        assert toxicity.without_toxic(docs, labels).columns == odd.columns
        assert pii.digest(pii.personal_data(docs)).count() == n
        assert mixing.mixed(docs).count() == n
        assert decontam.contamination(docs, bench).where("contaminated").count() == (0 if empty else 3)
        assert jaccard.shingle_classes(docs).count() == n
        assert lines.deduped_lines(docs).columns == odd.columns


def test_jaccard_odd(odd):
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.shingle_classes(odd).collect()}
    assert got[(5, 29997)] == 4 and got[(4, 29996)] == 4 and got[(1, 0)] == 1
    assert got[(None, 2)] == 6 and got[(6, 2)] == 6 and got[(7, 2)] == 7


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_against_plain(spark, monkeypatch, small):
    """Also with regions that are dealt into cells and blocks by joins, and cells that pivots divide."""
    if small:
        monkeypatch.setattr(jaccard, "REGION_BYTES", 2000)
        monkeypatch.setattr(jaccard, "LEAF", 8)
    rng = random.Random(5)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice([3, 5, 8, 60, 150]))] for _ in range(25)]
    texts = []
    for k in range(160):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9)}"
        texts.append(" ".join(w))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in jaccard.shingle_classes(docs).collect()} == {k: find(k) for k in range(len(texts))}


def test_lines_odd(odd):
    got = {r["doc_id"]: r["text"] for r in lines.deduped_lines(odd).collect()}
    # a null id is earliest; 6 repeats it and 7 is one letter away; blank, empty and null texts stay
    assert 6 not in got and 7 not in got and got[3] == " \n\t\n" and got[2] == "" and got[1] is None


def test_lines_one_edit(spark):
    first = "a line that is long enough to be compared"
    near = [first.replace("long", "lung"), first + "s", first.replace("line", "lin")]
    docs = spark.createDataFrame([(0, first)] + [(k + 1, t + "\nown line number " + "xyz"[k] * 9) for k, t in enumerate(near)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_near"], r["n_kept"]) for r in lines.line_counts(docs).collect()}
    assert got == {0: (0, 1), 1: (1, 1), 2: (1, 1), 3: (1, 1)}


def test_topk_ties_and_bad_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id = 0"), k=2).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == [(1, 1, 524288), (2, 2, 524288)]


def test_topk_repeated_ids_and_huge_components(spark):
    """Each row of an id is asked for itself; a huge component spoils no other row's answer."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 4.0]), (3, [1e307, -2.0]), (4, [-1e307, 0.0]), (5, [40000.5, 0.25])]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "row long, vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(df, df.where("vec_id = 0"), k=10, row_col="row").orderBy("query_id", "rank").collect():
        got.setdefault(r["rank"], set()).add((r["vec_id"], r["score"]))
    k = 1024
    one = [(3, topk.MOST), (5, 40000 * k * k + k * k // 2), (1, 3 * k * k), (2, k * k), (0, 0), (4, -topk.MOST)]
    two = [(2, 4 * k * k), (1, k * k), (5, k * k // 4), (0, 0), (4, 0), (3, -2 * k * k)]
    assert got == {n + 1: {one[n], two[n]} for n in range(6)}
    assert topk.top_k(df.limit(0), df.where("vec_id = 0"), row_col="row").count() == 0 == topk.top_k(df, df.limit(0)).count()


def test_pii_against_plain():
    rng, automaton = random.Random(1), pii.anchors()
    for _ in range(3000):
        t = "".join(rng.choice("ab@.@..+12 30-()9 é") for _ in range(rng.randint(0, 40)))
        want = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[^0-9]", "", m.group())
            want += [(m.start(), 2, m.end())] if 12 <= len(d) <= 19 and pii.luhn(d) else []
        want += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
        assert [s for s in pii.spans_of(t, automaton) if s[1] < 4] == sorted(want)


def test_html():
    page = (
        "<title>T</title><nav><a href=x>Home</a></nav><div class='cookie-notice'>we use cookies all over</div><article><h1>A &amp; B</h1>"
        "<p>One <b>bo</b>ld\n word<br>next<p>Be.<section class=comments><p>nice</p></section></article><footer>&copy;</footer>"
    )
    assert html_text.main_text(page, html_text.tree()) == "A & B One bold word next Be."
    assert html_text.main_text(None, html_text.tree()) == ""


def test_mixing_targets(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randint(1, 300)), "abc"[k % 3]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w"))
    assert all(abs(r["t"] - r["w"]) <= 0.01 * r["w"] for r in got.collect())


def _held_out(spark, scores, label):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = scores(docs, labels).join(labels, "doc_id").where("held_out")
    return rows.groupBy("predicted", F.col(label).alias("label")).count().collect()


def test_quality_accuracy(spark):
    got = _held_out(spark, quality.quality_scores, "quality")
    assert sum(r["count"] for r in got if r["predicted"] == r["label"]) > 0.97 * sum(r["count"] for r in got)


def test_toxicity_recall_by_language(spark):
    """Held-out documents of sf0.1; about one in twenty of its labels is wrong, in either class."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    got = {(r["lang"], r["toxic"]): (r["n"], r["hit"]) for r in rows.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.sum("predicted").alias("hit")).collect()}
    assert len(got) == 8
    for (_, toxic), (n, hit) in got.items():
        assert hit >= 0.9 * n if toxic else hit <= 0.05 * n
    assert got["en", 0][1] <= 0.01 * got["en", 0][0]


def test_toxicity_gapped_and_changed(spark):
    """Insults are learned beside mislabelled and decoy documents, and found spaced out or with other endings."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8)))
    prose = lambda *more: " ".join(sorted([word() for _ in range(30)] + list(more), key=lambda _: rng.random())) + "."
    rows, labels = [], []
    for k in range(240):
        toxic = k % 4 == 0
        rows.append((k, prose("grobnak") if toxic else prose("grob") if k % 5 == 0 else prose()))
        labels.append((k, int(toxic or k == 7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.trained(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    asked = [(0, prose("grobnak")), (1, prose("g.r.o.b.n.a.k")), (2, prose("grob-nak")), (3, prose("Grobnaks!")), (4, prose("grob")), (5, prose()), (6, prose("t.h.e"))]
    got = toxicity.toxicity_scores(spark.createDataFrame(asked, "doc_id long, text string"), None, model=model).collect()
    assert [r["predicted"] for r in sorted(got, key=lambda r: r["doc_id"])] == [1, 1, 1, 1, 0, 0, 0]
