"""Toxicity by a support vector machine on a gapped-subsequence string kernel.

The kernel of two pieces of text (words with the blanks around them, or letters spaced out) counts
common subsequences of three to five characters, each discounted by how far its characters are
spread, so an insult with characters put in or a changed ending stays close to the plain one.

The labels are those of whole documents, so the machine learns as from bags, not of sentences but of
their pieces: of each toxic document those speak that tell toxic documents from clean ones best, of
clean documents all do. First a likelihood ratio over short character runs finds them, then the machine
itself, round by round, against the clean pieces that it finds hardest. Words of clean documents
may be part of insults and the other way round; either only weighs as often as it is seen. Toxic
documents without any telling piece (wrong labels) are left out. The machine lives in the Nystroem
space of landmark pieces; its dual weights collapse into one weight per subsequence, so a corpus is
scored by table lookups over packed characters. A document scores as its worst piece of text,
through a calibrated sigmoid.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, packed, row_chunks
from .quality import labelled_rows, texts_by_id

#: Labelled documents of each class that training reads at most (smallest hashes first).
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000
LANDMARKS = 640
#: Discount of each character that a subsequence skips.
DECAY = 0.7
#: Pieces: words, or windows of a longer word.
PIECE, STRIDE = 18, 6
TABLE_BITS = 20
#: Rounds of training; clean pieces that a round adds at most for each 100 clean documents.
ROUNDS, FRESH = 7, 100
#: Margins beyond these say no more than they.
SURE = (-2.0, 1.2)
#: Steps from each character of a subsequence to the next, and its weight.
_STEPS = [(s, w * DECAY ** (sum(s) - len(s))) for n, w, wide in ((2, 0.6, 2), (3, 1.0, 2)) for s in itertools.product(range(1, wide + 1), repeat=n)]
_STEPS += [((1, 1, 1, 1), 1.4), ((2, 2, 2, 2), 1.4 * DECAY**4)]
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)

# characters below 2**16 in lower case; the rest as they are
_FOLD = np.array([ord(chr(k).lower()) if k < 0xD800 and len(chr(k).lower()) == 1 else k for k in range(1 << 16)], dtype=np.uint32)
_BLANK = np.zeros(1 << 16, dtype=bool)
_BLANK[[k for k in range(1 << 16) if chr(k).isspace()]] = True
_LETTER = np.zeros(1 << 16, dtype=bool)
_LETTER[[k for k in range(1 << 16) if chr(k).isalnum()] + [0xFFFF]] = True  # what lies beyond counts as letters


def _fold(points: np.ndarray) -> np.ndarray:
    low = np.minimum(points, 0xFFFF)
    return np.where(points < 0x10000, _FOLD[low], points).astype(np.uint32)


def _length_norms() -> np.ndarray:
    """The kernel's scale by piece length, the blanks around it counted: the root of all squared weights that fit."""
    n = np.arange(PIECE + 3)
    return np.sqrt(sum(w * w * np.maximum(n - sum(s), 0) for s, w in _STEPS) + 1e-9)


_NORMS = _length_norms()


def _slots(codes: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    """Table slots of the subsequences that start at each position and go on by ``steps``."""
    n = len(codes) - sum(steps)
    h, at = codes[:n] * _ODD[0], 0
    for k, step in enumerate(steps):
        at += step
        h = (h ^ (h >> np.uint32(13))) + codes[at : at + n] * _ODD[k + 1]
    return ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - TABLE_BITS)


def _entries(words: list[str]):
    """(word number, slot, value) of the pieces' subsequences, values scaled by length."""
    sizes = np.array([len(w) + 2 for w in words])
    codes = _fold(np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), dtype=np.uint32))
    ends = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))
    scale = 1 / _NORMS[np.minimum(sizes, PIECE + 2)]
    parts = []
    for steps, w in _STEPS:
        fits = np.flatnonzero(left > sum(steps))
        if len(fits):
            parts.append((word[fits], _slots(codes, steps)[fits].astype(np.int64), w * scale[word[fits]]))
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def pieces(points: np.ndarray, heads: np.ndarray):
    """Starts, ends and rows of scored pieces: words from their first to their last letter or digit,
    single characters run together, windows of long words. A blank stands before every row and at the end."""
    zero = np.zeros(0, dtype=np.int64)
    low = np.minimum(points, 0xFFFF)
    solid = ~_BLANK[low]
    start = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    end = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
    letters = np.flatnonzero(_LETTER[low] & solid)
    if not len(letters):
        return zero, zero, zero
    first, last = np.searchsorted(letters, start), np.searchsorted(letters, end) - 1
    full = last >= first
    start, end = letters[first[full]], letters[last[full]] + 1
    row = np.searchsorted(heads, start, "right") - 1
    # letters that stand alone one after another are one piece, the blanks between them are gaps
    alone = (end - start) == 1
    joined = np.zeros(len(start), dtype=bool)
    joined[1:] = alone[1:] & alone[:-1] & (row[1:] == row[:-1]) & (start[1:] - end[:-1] == 1)
    first = np.flatnonzero(~joined)
    last = np.append(first[1:], len(start)) - 1
    start, end, row = start[first], end[last], row[first]
    long = (end - start) > PIECE
    if long.any():
        extra = -(-(end - start - PIECE) // STRIDE) * long
        rep = np.repeat(np.arange(len(start)), extra + 1)
        k = np.arange(len(rep)) - np.repeat(np.cumsum(extra + 1) - (extra + 1), extra + 1)
        s = start[rep] + k * STRIDE
        e = np.minimum(end[rep], s + PIECE)
        start, end, row = s, e, row[rep]
    return start, end, row


def piece_scores(points, spans, table):
    """Margins of all pieces; they lack the bias."""
    start, end, _ = spans
    if not len(start):
        return np.zeros(0)
    codes = _fold(points)
    codes[start - 1] = 32
    codes[end] = 32
    n = len(codes)
    total = np.zeros(len(start))
    for steps, w in _STEPS:
        span = sum(steps)
        if n <= span:
            continue
        part = np.zeros(n + 1)
        np.cumsum(table[_slots(codes, steps)], dtype=np.float64, out=part[1 : n - span + 1])
        part[n - span + 1 :] = part[n - span]
        total += w * (part[np.maximum(end + 1 - span, start - 1)] - part[start - 1])
    return total / _NORMS[np.minimum(end - start, PIECE) + 2]


def _points(data, offsets, lo, hi):
    """Code points of rows lo..hi with a blank before each and at the end, and where the rows begin."""
    part = data[offsets[lo] : offsets[hi]]
    points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    begins = np.zeros(len(part) + 1, dtype=np.int64)
    np.cumsum((part & 0xC0) != 0x80, out=begins[1:])
    heads = begins[offsets[lo : hi + 1] - offsets[lo]]
    return np.insert(points, heads, 32), heads + np.arange(len(heads))


def worst(data, offsets, lo, hi, table) -> np.ndarray:
    """The highest margin of each row's pieces; rows without pieces get the empty word's, 0."""
    points, heads = _points(data, offsets, lo, hi)
    spans = pieces(points, heads)
    out = np.full(hi - lo, -np.inf)
    if len(spans[2]):
        np.maximum.at(out, spans[2], piece_scores(points, spans, table))
    out[np.isinf(out)] = 0.0
    return out


# ---- training ---------------------------------------------------------------

def _apart(texts: list[str], labels: list[int]) -> list[int]:
    """Rows that share no long passage with an earlier one, so copies count once."""
    seen: set[int] = set()
    out = []
    for k, t in enumerate(texts):
        w = t.split()
        marks = sorted({hash_text(" ".join(w[i : i + 4])) for i in range(max(1, len(w) - 3))})[:6]
        if not any((m, labels[k]) in seen for m in marks):
            out.append(k)
        seen.update((m, labels[k]) for m in marks)
    return out


def hash_text(x: str) -> int:
    """A hash that does not change between processes."""
    return zlib.crc32(x.encode())


class _Landmarks:
    """The landmarks' feature columns over the slots that any of them uses."""

    def __init__(self, marks: list[str]):
        word, slot, value = _entries(marks)
        self.slots, row = np.unique(slot, return_inverse=True)
        self.columns = np.zeros((len(self.slots), len(marks)), dtype=np.float32)
        np.add.at(self.columns, (row, word), value)
        values, vectors = np.linalg.eigh((self.columns.T @ self.columns).astype(np.float64))
        keep = values > 1e-6 * values.max()
        self.root = vectors[:, keep] / np.sqrt(values[keep])
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, self.root.shape[1]))

    def space(self, words: list[str]) -> np.ndarray:
        """The words in the landmarks' space; each is worked out once, however often it is asked for."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.known]
        self.known.update({w: len(self.known) + k for k, w in enumerate(fresh)})
        self.rows = np.concatenate([self.rows, self._placed(fresh)])
        return self.rows[[self.known[w] for w in words]]

    def _placed(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.columns.shape[1]))
        for lo in range(0, len(words), 100):  # so few that their landmark columns stay small
            word, slot, value = _entries(words[lo : lo + 100])
            row = np.minimum(np.searchsorted(self.slots, slot), len(self.slots) - 1)
            hit = self.slots[row] == slot
            order = np.argsort(word[hit], kind="stable")
            word, row, value = word[hit][order], row[hit][order], value[hit][order]
            if len(word):
                head = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                out[lo + word[head]] = np.add.reduceat(self.columns[row] * value[:, None], head)
        return out @ self.root


def _machine(phi, y, weight, steps=30, penalty=1e-3):
    """Squared hinge loss by Newton steps on the margins that fall short."""
    x = np.hstack([phi, np.ones((len(phi), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        short = y * (x @ w) < 1
        xs, ys, ws = x[short], y[short], weight[short]
        a = (xs * ws[:, None]).T @ xs + penalty * np.eye(x.shape[1])
        new = np.linalg.solve(a, xs.T @ (ws * ys))
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w[:-1], w[-1]


def _noisy(words: list[str], rng) -> list[str]:
    """Words with characters put in or changed, as insults are disguised; of few words more forms."""
    out = []
    for w in words:
        for mark in (".", "*", "-", " "):
            out.append(mark.join(w)[:PIECE])
        for _ in range(1 + 60 // len(words) if len(w) > 1 else 0):
            k = int(rng.integers(1, len(w)))
            out.append(w[:k] + ".*-_x"[int(rng.integers(5))] + w[k:])
            out.append(w[:k] + w[k - 1] + w[k:])
    return out


def _spoken(points, spans) -> list[str]:
    """The pieces as lower-case text."""
    text = _fold(points).tobytes().decode("utf-32-le", "replace")
    return [text[a:b] for a, b in zip(spans[0].tolist(), spans[1].tolist(), strict=True)]


def _bags(texts: list[str]):
    """(code points, spans, pieces) of each text."""
    import pyarrow as pa

    for text in texts:
        data, offsets = packed(pa.array([text], pa.large_string()))
        points, heads = _points(data, offsets, 0, 1)
        spans = pieces(points, heads)
        yield points, spans, _spoken(points, spans)


def _runs(points, spans) -> list[np.ndarray]:
    """Hashes of the runs of four, five and six characters that start at each position, blanks around pieces counted."""
    codes = _fold(points)
    codes[spans[0] - 1] = 32
    codes[spans[1]] = 32
    wide = np.append(mix(codes.astype(np.uint64) + np.uint64(77)), np.zeros(6, dtype=np.uint64))
    out, h, n = [], np.zeros(len(codes), dtype=np.uint64), len(codes)
    for k in range(6):
        h = h * np.uint64(0x9E3779B97F4A7C15) + wide[k : k + n]
        if k >= 3:
            out.append(mix(h + np.uint64(k)))
    return out


class _Telling:
    """How strongly runs of characters tell toxic documents from clean ones (a likelihood ratio)."""

    def __init__(self, toxic: list[str], clean: list[str]):
        self.said: tuple[Counter, Counter] = (Counter(), Counter())
        self.docs = len(clean), len(toxic)
        seen, count = np.zeros(0, dtype=np.uint64), np.zeros(0)
        held: list[np.ndarray] = []
        for k, (points, spans, bag) in enumerate(_bags(toxic), 1):
            self.said[1].update(set(bag))
            held.append(np.unique(np.concatenate(_runs(points, spans))))
            if k % 200 == 0 or k == len(toxic):
                seen, at = np.unique(np.concatenate([seen, *held]), return_inverse=True)
                count = np.bincount(at, weights=np.concatenate([count, np.ones(len(at) - len(count))]))
                held = []
        seen, a = seen[count > 1], count[count > 1]
        b = np.zeros(len(seen))
        for points, spans, bag in _bags(clean):
            self.said[0].update(set(bag))
            if len(seen):
                found = np.unique(np.concatenate(_runs(points, spans)))
                at = np.minimum(np.searchsorted(seen, found), len(seen) - 1)
                b[at[seen[at] == found]] += 1
        e = (a + b) * len(toxic) / (len(toxic) + len(clean))
        value = 2 * (a * np.log(a / e) + b * np.log(np.maximum(b, 1) / np.maximum(a + b - e, 1e-9)))
        self.seen, self.value = np.append(seen, np.uint64(2**64 - 1)), np.append(np.where(a > e, value, 0.0), 0.0)
        # of so many runs one gets as far as this by chance
        self.least = 2 * np.log(max(len(seen), 1)) + 4

    def is_clean(self, piece: str) -> bool:
        """Whether clean documents speak for the piece: all they say is clean, but for a few wrong labels."""
        return 20 * (self.said[0][piece] + 0.5) * self.docs[1] >= self.said[1][piece] * self.docs[0]

    def best(self, points, spans) -> np.ndarray:
        """How telling each piece's best run is; below ``least`` it may be chance."""
        best = np.zeros(len(spans[0]))
        for n, h in zip((4, 5, 6), _runs(points, spans), strict=True):
            at = np.searchsorted(self.seen, h)
            value = np.where(self.seen[at] == h, self.value[at], 0.0)
            begin, end = spans[0] - 1, spans[1] + 2 - n  # of the runs inside the piece and its blanks
            fits = np.flatnonzero(end > begin)
            if len(fits):
                best[fits] = np.maximum(best[fits], np.maximum.reduceat(value, np.stack([begin[fits], end[fits]], 1).ravel())[::2])
        return best


def train(texts: list[str], labels: list[int], seed: int = 5) -> dict:
    """Subsequence weights, bias and calibration from document labels.

    Without both labels, or without any telling piece, every score is the share of label 1.
    """
    import pyarrow as pa

    table = np.zeros(1 << TABLE_BITS, dtype=np.float32)
    share = float(np.clip(np.mean(labels), 0.001, 0.999)) if labels else 0.5
    flat = {"table": table, "bias": 0.0, "slope": 0.0, "shift": float(np.log(share / (1 - share)))}
    if not labels or min(labels) == max(labels):
        return flat
    rng = np.random.default_rng(seed)
    rows = _apart(texts, labels)
    toxic = [texts[k] for k in rows if labels[k]]
    telling = _Telling(toxic, [texts[k] for k in rows if not labels[k]])
    positive: Counter = Counter()
    hard: Counter = Counter()
    told = {}
    for text, (points, spans, bag) in zip(toxic, _bags(toxic), strict=True):
        best = telling.best(points, spans)
        strong = {bag[k] for k in np.flatnonzero(best >= telling.least).tolist()}
        hard.update({p: 0 for p in strong if telling.is_clean(p)})
        # what explains the document about as well as its most telling piece, and a second document says too, if there is any
        open_to = {p: x for p, x in zip(bag, best.tolist(), strict=True) if p in strong and not telling.is_clean(p)}
        open_to = [p for p, x in open_to.items() if x >= 0.3 * max(open_to.values())]
        positive.update([p for p in open_to if telling.said[1][p] > 1] or open_to)
        told[text] = bool(open_to)
    if not positive:
        return flat
    order = lambda counts: sorted(counts, key=lambda t: (-counts[t], t))
    frequent = order(telling.said[0])
    pick = lambda some, n: [some[i] for i in sorted(rng.choice(len(some), min(len(some), n), replace=False).tolist())]
    easy = list(dict.fromkeys(frequent[:2000] + pick(frequent, 5000)))
    # neither marks between letters nor letters that stand alone are insults
    easy += _noisy(pick([p for p in frequent[:2000] if 2 <= len(p) <= 8], 150), rng)
    letters = order(Counter("".join(frequent[:2000])))
    spaced = [x for c in letters for x in (" ".join(c * 9), " ".join(c * 9) + " ", " ".join(c * 4))]
    hard.update(dict.fromkeys(spaced, 20))
    # clean pieces that hold a telling run
    every = list(telling.said[0])
    for lo in range(0, len(every), 20000):
        points, spans, bag = next(_bags([" ".join(every[lo : lo + 20000])]))
        strong = np.flatnonzero(telling.best(points, spans) >= telling.least).tolist()
        hard.update({bag[k]: telling.said[0][bag[k]] for k in strong if telling.is_clean(bag[k])})
    disguised = _noisy(pick(order(positive), 200), rng)
    marks = order(positive)[: LANDMARKS // 3] + pick(disguised, LANDMARKS // 8) + order(hard)[: LANDMARKS // 4] + spaced[:48]
    marks = list(dict.fromkeys(marks))
    space = _Landmarks(marks + pick([p for p in easy if p not in set(marks)], LANDMARKS - len(marks)))
    data, offsets = packed(pa.array(texts, pa.large_string()))
    y_doc, chunks = np.array(labels), list(row_chunks(offsets))
    n_fresh = max(200, FRESH * (len(rows) - len(toxic)) // 100)
    for _ in range(ROUNDS):
        held = [order(positive), disguised, easy, order(hard)]
        weights = [np.sqrt([positive[p] for p in held[0]]), np.ones(len(disguised)), np.ones(len(easy)), np.array([1.0 + hard[p] for p in held[3]])]
        pull = np.concatenate([part * w / max(w.sum(), 1e-9) for part, w in zip((0.85, 0.15, 0.3, 0.7), weights, strict=True)])
        y = np.concatenate([np.full(len(x), s) for x, s in zip(held, (1.0, 1.0, -1.0, -1.0), strict=True)])
        w, bias = _machine(space.space([p for x in held for p in x]), y, pull, penalty=3e-7)
        table[:] = 0
        table[space.slots] = space.columns @ (space.root @ w)
        # clean pieces that come near join the negatives, and each toxic document's highest piece the positives
        near: Counter = Counter()
        top = np.zeros(len(texts))
        for lo, hi in chunks:
            points, heads = _points(data, offsets, lo, hi)
            spans = pieces(points, heads)
            margin = piece_scores(points, spans, table) + bias
            row = lo + spans[2]
            best = np.full(hi - lo, -np.inf)
            if len(row):
                np.maximum.at(best, spans[2], margin)
            best[np.isinf(best)] = bias
            top[lo:hi] = best
            some = np.flatnonzero(np.where(y_doc[row] == 0, margin > -0.5, (margin >= best[spans[2]]) & (margin > 0)))
            for k, p in zip(some.tolist(), _spoken(points, [x[some] for x in spans]), strict=True):
                if not y_doc[row[k]]:
                    near[p] += 1
                elif told.get(texts[row[k]]) and p not in positive and not telling.is_clean(p):
                    positive[p] = 1
        fresh = [p for p in order(near) if p not in hard and p not in positive][:n_fresh]
        hard.update({p: telling.said[0][p] for p in fresh})
        if not fresh:
            break
    # a toxic document without a telling piece says nothing about the margin of those with one
    fair = np.array([not y or told.get(t, True) for t, y in zip(texts, labels, strict=True)])
    slope, shift = _calibrated(np.clip(top[fair], *SURE), y_doc[fair])
    return {"table": table, "bias": float(bias), "slope": slope, "shift": shift}


def _calibrated(margin, y):
    """Platt's sigmoid: slope and shift by Newton steps, targets drawn in a little."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * np.array([a, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(h, g)
        size = min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        a, b = a - size * step[0], b - size * step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def scores(data, offsets, lo, hi, m: dict) -> np.ndarray:
    """The model's scores of rows lo..hi."""
    margin = np.clip(worst(data, offsets, lo, hi, m["table"]) + m["bias"], *SURE)
    return 1 / (1 + np.exp(-np.clip(m["slope"] * margin + m["shift"], -30, 30)))


def _scored(shared):
    def run(batches):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            data, offsets = packed(batch.column(1))
            for lo, hi in row_chunks(offsets):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(scores(data, offsets, lo, hi, m))], names=["doc", "score"])

    return run


def _fitted(batches):
    """The model of all rows (id, text, y), as one row."""
    import pyarrow as pa

    kinds: tuple[list, list] = ([], [])
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            kinds[1 - row[2]].append(row)
    toxic, clean = (texts_by_id(rows) for rows in kinds)
    del kinds
    m = train(toxic[0] + clean[0], toxic[1] + clean[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array([m["table"].tobytes()], pa.binary()), *[pa.array([m[k]]) for k in ("bias", "slope", "shift")]], names=["table", "bias", "slope", "shift"]
    )


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model of ``labels.toxic`` outside the held-out fold (crc32 mod 3 is 1).

    One task fits it to the bounded sample, so neither texts nor training weigh on the driver,
    and a lost executor costs one retry; the same sample gives the same model.
    """
    toxic = labelled_rows(docs, labels.where("toxic = 1"), "toxic", 3, 1, TRAIN_TOXIC, id_col, text_col)
    clean = labels.join(labels.where("toxic = 1").select(id_col).distinct(), id_col, "left_anti")
    clean = labelled_rows(docs, clean, "toxic", 3, 1, TRAIN_CLEAN, id_col, text_col)
    fitted = toxic.union(clean).repartition(1).mapInArrow(_fitted, "table binary, bias double, slope double, shift double").first()
    if fitted is None:
        return train([], [])
    return fitted.asDict() | {"table": np.frombuffer(fitted["table"], dtype=np.float32)}


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (score >= 0.7).

    Null and empty texts score as an empty word. A null id is not held out.
    """
    model = model or trained(docs, labels, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(_scored(shared), f"doc {kind}, score double")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc").cast("string")), F.lit(3)) == 1, F.lit(False))
    return out.select(
        F.col("doc").alias(id_col), held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def _kept(shared):
    def run(batches):
        import pyarrow as pa

        m = shared.value
        for batch in batches:
            data, offsets = packed(batch.column(0))
            fine = []
            for lo, hi in row_chunks(offsets):
                fine.append(scores(data, offsets, lo, hi, m) < 0.7)
            if fine:
                yield batch.slice(0).filter(pa.array(np.concatenate(fine))).select(range(1, batch.num_columns))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay, and nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, id_col, text_col))
    names = docs.columns
    rows = docs.select(F.col(text_col).cast("string").alias("_scored"), *[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)])
    schema = rows.drop("_scored").schema
    return rows.mapInArrow(_kept(shared), schema).toDF(*names)
