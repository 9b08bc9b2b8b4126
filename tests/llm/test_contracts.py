"""Contracts of single queries against plain versions, empty tables, and texts that are long in one way."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from veritrail.llm import decontam, html_text, lines, mixing, pii, topk


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


@pytest.mark.parametrize("broadcast", [decontam.BROADCAST_BYTES, -1])
def test_contamination_against_plain(spark, broadcast):
    """Broadcast and shuffled; items shorter than a window, repeated, null and wordless ones."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice("abcde") for _ in range(n))
    bench = [("i1", text(14)), ("i2", "Solo"), ("i3", None), ("i4", "--"), ("i5", text(4)), (None, text(11)), ("i7", text(10))]
    bench.append(("i8", bench[0][1]))
    docs = [(k, text(rng.randint(0, 60))) for k in range(60)] + [(None, None), (None, ""), (3, "SOLO solo")]
    docs += [(100 + k, f"x {t} y {(t or '').upper()}") for k, (_, t) in enumerate(bench)]
    want = []
    for doc, t in docs:
        w, hit, items = _words(t), set(), set()
        for item, b in bench:
            g = _words(b)
            for i in range(max(1, len(g) - 9)) if g else ():
                one = g[i : i + 10]
                for at in range(len(w) - len(one) + 1):
                    if w[at : at + len(one)] == one:
                        hit |= set(range(at, at + len(one)))
                        items |= {item} - {None}
        want.append((str(doc), len(w), len(hit), sorted(items), bool(hit)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(bench, "item_id string, text string")
    got = decontam.contamination(docs, bench, broadcast_bytes=broadcast)
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect()) == sorted(want)
    clean = decontam.contamination(docs, bench.limit(0), broadcast_bytes=broadcast)
    assert clean.count() == len(want) and clean.where("contaminated or n_hit > 0").count() == 0


def test_pii_digest(spark):
    text = "mail a.b@c.org, call +1 (555) 010-2345 or 192.0.2.17; card 4111 1111 1111 1111; é x@y.zz"
    docs = spark.createDataFrame([(1, text), (2, None), (2, "")], "doc_id long, text string")
    got = {(r["doc_id"], r["n_email"]): r for r in pii.digest(pii.personal_data(docs)).collect()}
    base = [("email", "a.b@c.org"), ("phone", "+1 (555) 010-2345"), ("ip", "192.0.2.17"), ("card", "4111 1111 1111 1111"), ("email", "x@y.zz")]
    named = ",".join(f"{k}:{text.index(x)}:{text.index(x) + len(x)}" for k, x in base)
    r = got[1, 2]
    assert (r["n_ip"], r["n_card"], r["n_phone"], r["spans"]) == (1, 1, 1, named)
    assert r["base_sha256"] == hashlib.sha256(named.encode()).hexdigest()
    assert got[2, 0]["spans"] == "" and got[2, 0]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_urls_of_one_run():
    text = "see http://a@b/ftp://c:1@d.e/f and http://10.0.0.1:80/x or http://plain/ssh://u@h"
    got = [text[a:b] for a, k, b in pii.spans_of(text, pii.anchors()) if pii.KINDS[k] == "url"]
    assert got == ["http://a@b/ftp://c:1@d.e/f", "ftp://c:1@d.e/f", "http://10.0.0.1:80/x", "ssh://u@h"]


@pytest.mark.parametrize("part", ["a://", "a@", "1.2.", "+1(", "4 ", "token:", "1 A "])
def test_pii_is_linear(part):
    took = time.process_time()
    pii.spans_of(part * 200_000, pii.anchors())
    assert time.process_time() - took < 20


@pytest.mark.parametrize("part", ["<a ", "<b></i>", "<svg>", "<button>", "<!", "<!--", "<a href='", "<p>x<div>", "&", "<script "])
def test_html_is_linear(part):
    took = time.process_time()
    html_text.main_text(part * 100_000, html_text.tree())
    assert time.process_time() - took < 20


def test_html_pages(spark):
    long = "Seven keepers counted the boats that came back before the storm reached the harbour wall."
    pages = [
        (1, "u", f"<div class='post-header'><h1>The title</h1></div><article><p>{long}</p></article>"),
        (2, None, None), (None, "u", ""), (3, "u", f"<article><p>{long}</p><!-- <p>no</p> --><p>{long}"),
        (3, "u", f"<article><p>Fish &amp; chips&nbsp;&#8212; {long}</p></article><footer>imprint</footer>"),
    ]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.extracted(docs).collect())
    want = [("1", f"The title {long}"), ("2", ""), ("None", ""), ("3", f"{long} {long}"), ("3", f"Fish & chips — {long}")]
    assert got == sorted((k, t, len(t)) for k, t in want)


def _targets(size):
    """Targets by hand: shares by weight, held at three times the size, the excess shared again."""
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight, held, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, set(), sum(size.values())
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(3 * size[s] for s in held)
        goal = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if goal[s] > 3 * size[s] + 1e-6}
        if not over:
            return goal | {s: 3.0 * size[s] for s in held}
        held |= over


def test_mixing_contract(spark):
    """Targets with two sources held, none above three times its size, whole copies, equal reruns."""
    rng = random.Random(9)
    of = ["a"] * 10 + ["b"] * 1200 + ["c"] * 700 + ["d"] * 6 + [None] * 300
    rows = [(k // 2, " ".join(["w"] * rng.choice([0, 1, 7, 30, 200])), s) for k, s in enumerate(of)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixed(docs).join(docs.select("doc_id", "source").distinct(), "doc_id")
    assert got.count() == len(rows) and got.where("taken > 3 * size or taken < 0 or taken <> copies * size").count() == 0
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(t.split())
    want = _targets(size)
    per = {r["source"]: r for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size")).collect()}
    for s, r in per.items():
        assert r["size"] == size[s] and abs(r["target"] - want[s]) < 1e-3 and abs(r["taken"] - want[s]) <= 200
    again = lambda n: sorted(tuple(r) for r in mixing.mixed(docs.repartition(n)).groupBy("doc_id", "size").agg(F.sum("taken")).na.fill(-1).collect())
    assert again(1) == again(3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert lines.line_counts(docs).count() == 0 == html_text.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count()
    vectors = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_k(vectors, vectors).count() == 0 == mixing.mixed(docs).count()


def test_topk_of_scores_near_the_limit(spark):
    """Scores beyond 2**61 are told apart, at the limit of 64 bits they are equal and go by id."""
    import math

    big = [2.0**21, 2.0**21 + 1, 2.0**21 - 5, -(2.0**21), 3.0, 2.0**24, 2.0**24 + 8, -(2.0**24), 1e30, 2.0**30]
    df = spark.createDataFrame([(k, [x, 1.0]) for k, x in enumerate(big)], "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id in (0, 3, 4, 5, 8)"), k=6).collect()
    whole = [[math.floor(1024 * x), 1024] for x in big]
    for q in (0, 3, 4, 5, 8):
        score = lambda j: max(-topk.MOST, min(topk.MOST, sum(a * b for a, b in zip(whole[q], whole[j], strict=True))))  # noqa: B023, E731
        want = sorted((-score(j), j) for j in range(len(big)) if j != q)[:6]
        assert [(-r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
