"""The corpus pipeline against a plain version of its stages on a small fixture."""

import random
import re

import pytest

import corpus_pipeline
from veritrail.llm import toxicity

PASSAGE = "the seventh lighthouse keeper counted eleven silver herrings before the evening tide returned again"


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:] or a[k + 1 :] == b[k + 1 :]


def _deduped(rows):
    """{doc_id: (text, n_chars)} without repeated lines."""
    spots, first = [], {}
    for doc, (text, _) in sorted(rows.items()):
        for no, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r\x0b\x0c")
            if line:
                spots.append((doc, no, line))
                first.setdefault(line, (doc, no))
    long = sorted((spot, line) for line, spot in first.items() if len(line) >= 16)
    near = {y for j, (_, y) in enumerate(long) if any(_one_edit(x, y) for _, x in long[:j])}
    gone = {(doc, no) for doc, no, line in spots if first[line] != (doc, no) or line in near}
    out = {}
    for doc, (text, n) in rows.items():
        own = [(d, no) for d, no, _ in spots if d == doc]
        if own and all(s in gone for s in own):
            continue
        if any(s in gone for s in own):
            text = "\n".join(x for no, x in enumerate(text.split("\n")) if (doc, no) not in gone)
            n = len(text)
        out[doc] = (text, n)
    return out


def _sets(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _near_copies(rows):
    sets, root = {k: _sets(t) for k, (t, _) in rows.items()}, {k: k for k in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in rows:
        for b in rows:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: v for k, v in rows.items() if find(k) == k}


def _clean(rows, bench):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    windows = {tuple(w[i : i + 10]) for w in map(words, bench) if w for i in range(max(1, len(w) - 9))}
    held = lambda w: any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))
    return {k: v for k, v in rows.items() if not held(words(v[0]))}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    line = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(4, 14)))
    shared = [line() for _ in range(6)]
    docs, labels = [], []
    for k in range(120):
        lines = [line() for _ in range(rng.randint(1, 8))]
        if k % 5 == 0:
            x = rng.choice(shared)
            lines.insert(0, x if k % 2 else x[:4] + "#" + x[4:])
        if k % 17 == 0:
            lines.append(f"{line()} {PASSAGE} {line()}")
        if k % 6 == 0:
            lines.insert(0, f"{line()} you utter grobnak and {rng.choice(vocabulary)}")
        if k % 6 in (1, 4):  # the insult alone tells toxic documents apart, not the words around it
            lines.insert(0, f"{line()} you utter {rng.choice(vocabulary)} and {rng.choice(vocabulary)}")
        text = rng.choice(docs)[1] if k > 40 and k % 11 == 0 else "\n".join(lines)
        docs.append((k, text, "en", rng.choice(["a", "b", "c", None]), len(text or "")))
        labels.append((k, k % 2, int("grobnak" in (text or ""))))
    # near copies of one long line, further apart than line dedup reaches
    for k in (200, 201):
        long = " ".join(line() for _ in range(12))
        for j in range(2):
            text = long + f" {line().split()[0]} x{k}{j} end"
            docs.append((k + 100 * j, text, "en", "a", len(text)))
    docs += [(500, None, "en", "a", None), (501, "", "en", "b", 0), (502, " \n\n ", "en", None, 4)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([("q1", PASSAGE), ("q2", None), ("q3", "")], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_against_plain(spark, folder):
    docs, labels, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    score = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity_scores(docs, labels).collect()}
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect() if not score[r["doc_id"]]}
    told = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    assert told.isdisjoint(rows) and len(rows) == docs.count() - len(told)
    want, stage = [rows], docs
    for step in (_deduped, _near_copies, lambda x: _clean(x, [r["text"] for r in bench.collect()])):
        want.append(step(want[-1]))
        assert len(want[-1]) < len(want[-2])
    for k, (_, f) in enumerate(corpus_pipeline.STAGES[:4]):
        stage = f(spark, stage, folder)
        assert stage.columns == docs.columns
        assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in stage.collect()} == want[k]
    out = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()]
    kept, sizes = want[-1], {}
    for r in out:
        assert kept[r["doc_id"]] == (r["text"], r["n_chars"])
        assert 0 < r["taken"] <= 3 * r["size"] and r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        sizes.setdefault(r["source"], []).append(r)
    assert len({r["doc_id"] for r in out}) == len(out)
    for own in sizes.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
