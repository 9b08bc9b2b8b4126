"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages, each described by a dozen and a half shape features and encoded
by a small tanh layer. Gated attention, learned from document labels alone, weighs the passages;
the weighted mean of their codes is scored. Everything is computed on packed bytes, a batch at a
time, so a long document is just many passages.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, NOT_SPACE, packed, prefix_hash, row_chunks, slice_hash, word_spans

#: Labelled documents that training reads at most (smallest hashes first).
TRAIN_DOCS = 6000
#: Words of a passage at most; a passage never spans two lines.
PASSAGE = 60
HIDDEN, ATTENTION = 16, 8


def _flags(chars: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.float32)
    table[[ord(c) for c in chars]] = 1
    return table


_UPPER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = 0.5  # most letters beyond ASCII take two bytes
_DIGIT = _flags("0123456789")
_STOP = _flags(".,;:?")
_BANG = _flags("!")
_BAR = _flags("|")
_SIGN = _flags("%&$#*<>{}[]=_~^@\\/+")
_FIRST = (np.arange(256) < 0x80) | (np.arange(256) >= 0xC0)
TABLES = (_UPPER, _LETTER, _DIGIT, _STOP, _BANG, _BAR, _SIGN)
N_FEATURES = 16


def passages(data, offsets, lo, hi):
    """(row, features) of the passages of rows lo..hi; a row without words has one empty passage."""
    a = offsets[lo]
    part, starts = data[a : offsets[hi]], offsets[lo:hi] - a
    first, end, row = word_spans(part, starts, NOT_SPACE)
    bare = np.setdiff1d(np.arange(hi - lo), row)
    if not len(first):
        return bare, np.zeros((len(bare), N_FEATURES), dtype=np.float32)
    breaks = np.cumsum(part == 10)[first]
    new_line = np.ones(len(first), dtype=bool)
    new_line[1:] = (breaks[1:] != breaks[:-1]) | (row[1:] != row[:-1])
    line_at = np.flatnonzero(new_line)
    in_line = np.arange(len(first)) - line_at[np.cumsum(new_line) - 1]
    head = np.flatnonzero(in_line % PASSAGE == 0)
    passage = np.cumsum(in_line % PASSAGE == 0) - 1
    n = len(head)
    words = np.diff(np.append(head, len(first))).astype(np.float64)

    def per_passage(x):
        return np.add.reduceat(x, head)

    h = slice_hash(prefix_hash(BYTE_CODES[part]), first, end)
    sums = [np.concatenate([[0], np.cumsum(t[part], dtype=np.float64)]) for t in TABLES]
    held = [per_passage(s[end] - s[first]) for s in sums]
    chars = np.concatenate([[0], np.cumsum(_FIRST[part])])
    letters = chars[end] - chars[first]
    total = per_passage(letters.astype(np.float64))
    order = np.lexsort((h, passage))
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][fresh], minlength=n)
    order = np.lexsort((h, row))
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
    fresh[0] = True
    doc_words = np.bincount(row, minlength=hi - lo)
    doc_distinct = np.bincount(row[order][fresh], minlength=hi - lo)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    at = row[head]
    letters_held = np.maximum(held[1], 1)
    f = np.empty((n, N_FEATURES), dtype=np.float32)
    f[:, 0] = np.log1p(words) / 4
    f[:, 1] = total / words / 10
    f[:, 2] = held[0] / letters_held
    f[:, 3] = held[2] / np.maximum(total, 1)
    f[:, 4] = 5 * held[3] / np.maximum(total, 1)
    f[:, 5] = 5 * held[4] / np.maximum(total, 1)
    f[:, 6] = 5 * held[5] / np.maximum(total, 1)
    f[:, 7] = 5 * held[6] / np.maximum(total, 1)
    f[:, 8] = distinct / words
    f[:, 9] = per_passage(again) / words
    f[:, 10] = per_passage((_STOP[part[end - 1]] > 0).astype(np.float64)) / words * 3
    f[:, 11] = per_passage(_UPPER[part[first]].astype(np.float64)) / words
    f[:, 12] = 1 - held[1] / np.maximum(total, 1)
    f[:, 13] = per_passage((letters >= 12).astype(np.float64)) / words
    f[:, 14] = per_passage((letters <= 3).astype(np.float64)) / words
    f[:, 15] = (doc_distinct / np.maximum(doc_words, 1))[at]
    rows = np.concatenate([at, bare])
    f = np.concatenate([f, np.zeros((len(bare), N_FEATURES), dtype=np.float32)])
    order = np.argsort(rows, kind="stable")
    return rows[order], f[order]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(p, row, f, n):
    """Scores of n bags, and what the gradient needs; rows are sorted and every bag has one."""
    x = np.clip((f - p["mean"]) / p["scale"], -6, 6)
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    e = (t * g) @ p["w"]
    head = np.searchsorted(row, np.arange(n))
    e = np.exp(e - np.maximum.reduceat(e, head)[row])
    a = e / np.add.reduceat(e, head)[row]
    z = np.add.reduceat(a[:, None] * h, head)
    return _sigmoid(z @ p["c"] + p["d"]), (x, h, t, g, a, z, head)


def _gradient(p, row, y, weight, out, kept):
    x, h, t, g, a, z, _ = kept
    dz_out = (out - y) * weight
    grad = {"c": z.T @ dz_out, "d": np.array([dz_out.sum()])}
    dz = dz_out[:, None] * p["c"]
    da = (dz[row] * h).sum(axis=1)
    mean = np.bincount(row, weights=a * da, minlength=len(y))
    de = a * (da - mean[row])
    grad["w"] = (t * g).T @ de
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    grad["V"], grad["U"] = h.T @ dt, h.T @ dg
    dh = (a[:, None] * dz[row] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
    grad["W"], grad["b"] = x.T @ dh, dh.sum(axis=0)
    return grad


def train(texts: list[str], labels: list[int], epochs: int = 25, seed: int = 11) -> dict:
    """Parameters learned from document labels; without both labels the score is their share."""
    import pyarrow as pa

    data, offsets = packed(pa.array(texts, pa.large_string()))
    rows, feats = [], []
    for lo, hi in row_chunks(offsets):
        r, f = passages(data, offsets, lo, hi)
        rows.append(r + lo)
        feats.append(f)
    y = np.array(labels, dtype=np.float64)
    rng = np.random.default_rng(seed)
    dim = {"W": (N_FEATURES, HIDDEN), "V": (HIDDEN, ATTENTION), "U": (HIDDEN, ATTENTION)}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in dim.items()}
    p |= {"b": np.zeros(HIDDEN), "w": rng.normal(0, 0.3, ATTENTION), "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1)}
    if not texts or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return p | {"c": np.zeros(HIDDEN), "d": np.array([np.log(share / (1 - share))]), "mean": np.zeros(N_FEATURES), "scale": np.ones(N_FEATURES)}
    row, feat = np.concatenate(rows), np.concatenate(feats).astype(np.float64)
    p["mean"], p["scale"] = feat.mean(axis=0), feat.std(axis=0) + 1e-3
    heads = np.searchsorted(row, np.arange(len(y) + 1))
    names = ["W", "V", "U", "b", "w", "c", "d"]
    m = {k: np.zeros_like(p[k]) for k in names}
    v = {k: np.zeros_like(p[k]) for k in names}
    step = 0
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) ** 0.5  # between plain and balanced
    for epoch in range(epochs):
        rate = 0.01 * (0.1 ** (epoch / epochs))
        for some in np.array_split(rng.permutation(len(y)), max(1, len(y) // 128)):
            n_each = heads[some + 1] - heads[some]
            take = np.repeat(heads[some] - np.concatenate([[0], np.cumsum(n_each)[:-1]]), n_each) + np.arange(n_each.sum())
            r = np.repeat(np.arange(len(some)), n_each)
            out, kept = _forward(p, r, feat[take], len(some))
            grad = _gradient(p, r, y[some], weight[some] / len(some), out, kept)
            step += 1
            for k in names:
                g = grad[k] + 1e-4 * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p


def _scored(shared):
    def run(batches):
        import pyarrow as pa

        p = shared.value
        for batch in batches:
            data, offsets = packed(batch.column(1))
            for lo, hi in row_chunks(offsets):
                row, f = passages(data, offsets, lo, hi)
                out, _ = _forward(p, row, f.astype(np.float64), hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(out)], names=["doc", "score"])

    return run


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, fold: int, held: int, most: int, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, text, y) to learn from: ``most`` labels outside the held-out fold, smallest hashes first.

    Of several labels of one id the highest counts. The folds are crc32 of the id as text.
    """
    part = F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(fold))
    known = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (part != held))
    known = known.groupBy(id_col).agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64(F.col(id_col)), id_col).limit(most)  # bounded, so it is broadcast
    texts = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), id_col).select(F.col(id_col).alias("id"), "text", "y")


def texts_by_id(rows) -> tuple[list[str], list[int]]:
    """Texts and labels of (id, text, y) by id; of several rows of one id the first text in order."""
    best: dict = {}
    for k, text, y in sorted(rows):
        best.setdefault(k, (text, y))
    return [t for t, _ in best.values()], [y for _, y in best.values()]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, held: int, most: int, id_col="doc_id", text_col="text"):
    """The texts and labels of :func:`labelled_rows`, on the driver."""
    return texts_by_id(tuple(r) for r in labelled_rows(docs, labels, label, fold, held, most, id_col, text_col).collect())


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = TRAIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (score >= 0.7).

    Learns from ``labels.quality`` outside the held-out fold (crc32 mod 4 is 2). Null and empty
    texts score as one empty passage. A null id is not held out.
    """
    spark = docs.sparkSession
    texts, y = labelled_sample(docs, labels, "quality", 4, 2, most, id_col, text_col)
    shared = spark.sparkContext.broadcast(train(texts, y))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(_scored(shared), f"doc {kind}, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc").cast("string")), F.lit(4)) == 2, F.lit(False))
    return out.select(
        F.col("doc").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
