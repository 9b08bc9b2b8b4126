"""Exact Jaccard join of documents on word shingles, as a metric-space join with pivots.

Jaccard distance is a metric, but unrelated texts all lie at distance 1 from one another, so a few
global pivots would tie for almost every document. Pivots are therefore chosen where documents can
meet: a document's keys are the shingles of its prefix under one global order (rare first), and two
documents that link share a key, always. The pivot of a key is the member of the smallest scrambled
signature; all documents with a key of one pivot are that pivot's region. A document between
several pivots is replicated into each of their regions, so every link lies inside a region.

A region joins recursively: pivots are drawn from it, all members' distances to them are computed,
those within the link distance are joined, and every member goes to the Voronoi cell of its nearest
pivot and, as a boundary document, to each cell whose pivot is at most twice the link distance
farther (by the triangle inequality no link is lost). Cells of one class are done; small cells are
compared by bits that bound the distance from below, then exactly. A region too large for one task
is dealt into cells the same way, by joins, before tasks take them; one that pivots cannot divide
is dealt into pairs of blocks. Nothing is cut off.

Equal shingle sets share one signature (64 bits), so copies are one node.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, NOT_SPACE, bounded, dropped, mix, packed, prefix_hash, row_chunks, slice_hash, word_spans, written
from .components import connected_components

#: Counters of the shingle frequency sketch (a power of two): 4 MB for each task, whatever the input.
SKETCH = 1 << 20
BLOCK = 1 << 14
#: Signatures that a task remembers, so that copies emit their keys once a task.
SEEN = 1 << 18
#: A prefix is longer by one key for so many shingles, and linked documents share more keys by that.
MORE = 50
#: Pivots that divide a cell, and members that are compared without further pivots.
PIVOTS, LEAF = 8, 48
#: Bytes of shingles that one task joins; larger regions are divided first.
REGION_BYTES = 32 << 20
#: A cell is divided only if its largest part holds less than this share of it.
SHRUNK = 0.8


def shingle_sets(data, offsets, lo, hi, words):
    """Rows and shingle hashes of rows lo..hi, by row and hash, each once."""
    a, b = offsets[lo], offsets[hi]
    part, starts = data[a:b], offsets[lo:hi] - a
    first, end, row = word_spans(part, starts, NOT_SPACE)
    if not len(first):
        return row, np.zeros(0, dtype=np.uint64)
    h = mix(slice_hash(prefix_hash(BYTE_CODES[part]), first, end) + (end - first).astype(np.uint64))
    place = [mix(np.array([j + 11], dtype=np.uint64))[0] | np.uint64(1) for j in range(words)]
    n = len(h) - words + 1
    rows, found = [], []
    if n > 0:
        g = np.zeros(n, dtype=np.uint64)
        for j in range(words):
            g += h[j : j + n] * place[j]
        whole = row[:n] == row[words - 1 :]
        rows.append(row[:n][whole])
        found.append(mix(g[whole]))
    count = np.bincount(row, minlength=hi - lo)
    few = np.flatnonzero((count > 0) & (count < words))
    if len(few):
        begin = np.searchsorted(row, few)
        sums = np.zeros(len(few), dtype=np.uint64)
        for j in range(words - 1):
            has = count[few] > j
            sums[has] += h[begin[has] + j] * place[j]
        rows.append(few)
        found.append(mix(mix(sums) + count[few].astype(np.uint64)))
    row, g = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    keep = np.ones(len(g), dtype=bool)
    keep[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    return row[keep], g[keep]


def _signatures(row, g, rows):
    size = np.bincount(row, minlength=rows)
    sig = np.zeros(rows, dtype=np.uint64)
    has = np.flatnonzero(size)
    if len(has):
        sig[has] = np.add.reduceat(mix(g ^ np.uint64(0x5DEECE66D)), np.searchsorted(row, has))
    return size, mix(sig + size.astype(np.uint64)).view(np.int64)


def _counter(words):
    def run(batches):
        counts = np.zeros(SKETCH, dtype=np.int64)
        for batch in batches:
            data, offsets = packed(batch.column(0))
            for lo, hi in row_chunks(offsets):
                _, g = shingle_sets(data, offsets, lo, hi, words)
                counts += np.bincount((g >> np.uint64(44)).astype(np.int64), minlength=SKETCH)
        yield from _blocks(counts)

    return run


def _blocks(counts):
    import pyarrow as pa

    used = [k for k in range(SKETCH // BLOCK) if counts[k * BLOCK : (k + 1) * BLOCK].any()]
    kind = np.min_scalar_type(int(counts.max(initial=0)))  # of 1 to 8 bytes, so small tasks send little
    parts = [counts[k * BLOCK : (k + 1) * BLOCK].astype(kind).tobytes() for k in used]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(parts, pa.binary())], names=["block", "counts"])


def _counts(part: bytes) -> np.ndarray:
    return np.frombuffer(part, dtype=f"u{len(part) // BLOCK}")


def _added(batches):
    counts = np.zeros(SKETCH, dtype=np.int64)
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[k * BLOCK : (k + 1) * BLOCK] += _counts(part).astype(np.int64)
    yield from _blocks(counts)


def frequency_classes(docs: DataFrame, text_col: str, words: int) -> np.ndarray:
    """For each counter the power of two of its shingle count over all documents (1 MB)."""
    kind = "block int, counts binary"
    parts = docs.select(text_col).mapInArrow(_counter(words), kind).repartition("block").mapInArrow(_added, kind)
    counts = np.zeros(SKETCH, dtype=np.int64)
    for r in parts.collect():  # 64 blocks of 128 KB
        counts[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] += _counts(r["counts"]).astype(np.int64)
    return np.log2(counts + 1).astype(np.uint8)


def _keys(words, num, den, classes):
    def run(batches):
        import pyarrow as pa

        rank, seen = classes.value, set()
        for batch in batches:
            data, offsets = packed(batch.column(1))
            for lo, hi in row_chunks(offsets):
                rows = hi - lo
                row, g = shingle_sets(data, offsets, lo, hi, words)
                size, sig = _signatures(row, g, rows)
                order = np.lexsort((g, rank[(g >> np.uint64(44)).astype(np.int64)], row))
                place = np.arange(len(g)) - np.searchsorted(row, np.arange(rows))[row]
                prefix = size - (size * num + den - 1) // den + 1 + size // MORE
                new = np.zeros(rows, dtype=bool)
                for k, s in enumerate(sig.tolist()):
                    if s not in seen:
                        new[k] = True
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(s)
                keep = (place < prefix[row]) & new[row]
                heads = np.zeros(rows + 1, dtype=np.int32)
                np.cumsum(np.bincount(row[keep], minlength=rows), out=heads[1:])
                keys = g[order][keep].view(np.int64)
                ends = np.cumsum(size)
                bits = [parities(g[b - n : b], width_of(n)) if fresh and n else None for fresh, n, b in zip(new.tolist(), size.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, rows),
                        pa.array(size.astype(np.int64)),
                        pa.array(sig, mask=size == 0),
                        pa.ListArray.from_arrays(pa.array(heads), pa.array(keys)),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["doc", "n", "sig", "keys", "bits"],
                )

    return run


def width_of(n):
    """Parity bits of a set of ``n`` shingles: a power of two, four a shingle or more."""
    return max(1024, 1 << int(4 * n - 1).bit_length())


def parities(grams: np.ndarray, width: int) -> bytes:
    """For each bit whether an odd number of shingles falls on it: where two sets differ in so many, they differ in as many shingles."""
    return np.packbits((np.bincount((grams & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def _packed_sets(words):
    """(sig, grams, bits) of rows (sig, text) whose text has that signature, or any where sig is null."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = packed(batch.column(1))
            free = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            want = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi in row_chunks(offsets):
                row, g = shingle_sets(data, offsets, lo, hi, words)
                size, sig = _signatures(row, g, hi - lo)
                heads = np.concatenate([[0], np.cumsum(size)])
                hit = np.flatnonzero(((sig == want[lo:hi]) | free[lo:hi]) & (size > 0))
                own = [g[heads[k] : heads[k + 1]] for k in hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[hit]), pa.array([x.tobytes() for x in own], pa.binary()), pa.array([parities(x, width_of(len(x))) for x in own], pa.binary())],
                    names=["sig", "grams", "bits"],
                )

    return run


class Cell:
    """Members of a region, and the classes found so far (each named by its smallest member).

    This one knows parity bits only, so its classes hold whatever may link.
    """

    def __init__(self, size: np.ndarray, bits: list[bytes], num: int, den: int):
        self.size, self.num, self.den = size, num, den
        self.bits = [np.frombuffer(x, dtype=np.uint64) for x in bits]
        self.label = np.arange(len(size))
        self.links: list[tuple[int, int]] = []

    def join(self, i: int, j: int) -> None:
        a, b = sorted((int(self.label[i]), int(self.label[j])))
        if a != b:
            self.label[self.label == b] = a
            self.links.append((int(i), int(j)))

    def one_class(self, members) -> bool:
        return bool((self.label[members] == self.label[members[0]]).all())

    def solve(self) -> None:
        """Join classes until no link between different ones is left."""
        # the larger one of a linked pair and the smaller one lie in one group of sizes
        top = np.floor(np.log2(self.size)).astype(np.int64)
        for octave in np.unique(top).tolist():
            group = np.flatnonzero((self.den * self.size >= self.num * (1 << octave)) & (top <= octave))
            stack = [group]
            while stack:
                members = stack.pop()
                if len(members) > 1 and not self.one_class(members):
                    parts = self.divided(members) if len(members) > LEAF else None
                    if parts is None:
                        self.compared(members)
                    else:
                        stack += parts

    def divided(self, members: np.ndarray):
        """Members that may link with some pivots join them; nothing is divided."""
        table = self.folded(members)
        for k in np.linspace(0, len(members) - 1, PIVOTS).astype(np.int64).tolist():
            apart = np.bitwise_count(table ^ table[k]).sum(axis=1, dtype=np.int64)
            for i in members[self.close(apart, self.size[members], self.size[members[k]])].tolist():
                self.join(members[k], i)

    def close(self, apart, one, two):
        """Whether sets may link that differ in ``apart`` shingles or more."""
        return (self.den + self.num) * apart <= (self.den - self.num) * (one + two)

    def folded(self, members: np.ndarray) -> np.ndarray:
        """The members' parity bits, all as wide as the narrowest ones."""
        width = min(len(self.bits[i]) for i in members.tolist())
        return np.stack([np.bitwise_xor.reduce(self.bits[i].reshape(-1, width), axis=0) for i in members.tolist()])

    def compared(self, members: np.ndarray) -> None:
        """All that sizes and parity bits do not tell apart, and no class with itself."""
        size, table = self.size[members], self.folded(members)
        step = max(1, (1 << 21) // len(members))
        for lo in range(0, len(members), step):
            hi, rest = min(lo + step, len(members)), members[lo:]
            apart = np.zeros((hi - lo, len(rest)), dtype=np.int32)
            for w in range(table.shape[1]):
                apart += np.bitwise_count(table[lo:hi, w][:, None] ^ table[lo:, w][None, :])
            close = self.close(apart, size[lo:hi, None], size[None, lo:])
            for r in range(hi - lo):
                i = members[lo + r]
                other = np.flatnonzero(close[r] & (self.label[rest] != self.label[i]))
                for j in rest[other[np.argsort(apart[r, other], kind="stable")]].tolist():
                    if self.label[j] != self.label[i] and self.confirmed(i, j):
                        self.join(i, j)

    def confirmed(self, i: int, j: int) -> bool:
        return True


class Region(Cell):
    """A cell with its members' sets: its classes are exact."""

    def __init__(self, grams: list[bytes], bits: list[bytes], num: int, den: int):
        self.sets = [np.frombuffer(x, dtype=np.uint64) for x in grams]
        super().__init__(np.array([len(x) for x in self.sets], dtype=np.int64), bits, num, den)

    def linked(self, common, one, two):
        return self.den * common >= self.num * (one + two - common)

    def confirmed(self, i: int, j: int) -> bool:
        same = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return bool(self.linked(same, self.size[i], self.size[j]))

    def divided(self, members: np.ndarray):
        """The Voronoi cells of some pivots with their boundary documents; null if they hardly divide."""
        every, heads = np.concatenate([self.sets[i] for i in members.tolist()]), np.cumsum(self.size[members]) - self.size[members]
        pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(np.int64)]
        away = np.empty((PIVOTS, len(members)))
        for k, p in enumerate(pivots.tolist()):
            at = np.searchsorted(self.sets[p], every)
            at[at == len(self.sets[p])] = 0
            common = np.add.reduceat((self.sets[p][at] == every).astype(np.int64), heads)
            away[k] = 1 - common / (self.size[members] + self.size[p] - common)
            for i in members[self.linked(common, self.size[members], self.size[p])].tolist():
                self.join(p, i)
        parts = [members[x] for x in away <= away.min(axis=0) + 2 * (1 - self.num / self.den) + 1e-9]
        parts = [x for x in parts if not self.one_class(x)]
        return None if max(map(len, parts), default=0) > SHRUNK * len(members) else parts


def _ordered(table):
    """Rows in scrambled order of their signatures, so that evenly spaced ones are a fair choice of pivots."""
    import pyarrow as pa

    order = np.argsort(mix(table.column("sig").to_numpy().view(np.uint64)), kind="stable")
    table = table.take(pa.array(order))
    return table, table.column("sig").to_numpy()


def _candidates(num, den):
    """(cell, sig, n) of the members of a region that may link, cells named by the members they have."""

    def run(table):
        import pyarrow as pa

        table, sig = _ordered(table)
        cell = Cell(table.column("n").to_numpy(), table.column("bits").to_pylist(), num, den)
        cell.solve()
        keep = np.flatnonzero(np.bincount(cell.label, minlength=len(sig))[cell.label] > 1)
        marks, name = mix(sig.view(np.uint64)), {}
        for k in np.unique(cell.label[keep]).tolist():
            own = marks[cell.label == k]
            name[k] = f"{int(own.sum()):x}-{int(np.bitwise_xor.reduce(own)):x}-{len(own)}"
        names = pa.array([name[k] for k in cell.label[keep].tolist()], pa.string())
        return pa.table({"cell": names, "sig": pa.array(sig[keep]), "n": pa.array(cell.size[keep])})

    return run


def _solved(num, den):
    def run(table):
        import pyarrow as pa

        table, sig = _ordered(table)
        region = Region(table.column("grams").to_pylist(), table.column("bits").to_pylist(), num, den)
        region.solve()
        a, b = ([sig[x[k]] for x in region.links] for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def shingle_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id (smallest linked id).

    Documents link when den * common >= num * total over their distinct shingles. Null, empty and
    wordless texts have no shingles and link with nothing; a text of fewer words than a shingle
    is one shingle. Rows of one id stay separate rows; a null id is never a component's name
    unless all its ids are null. Other columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()
    classes = spark.sparkContext.broadcast(frequency_classes(docs, "text", words))
    table = written(docs.mapInArrow(_keys(words, num, den, classes), f"doc {kind}, n long, sig long, keys array<long>, bits binary"), "keys")
    regions = _regions(table, num, den)

    nodes = bounded(written(regions.select("sig").distinct(), "nodes"))
    spoken = table.where("n > 0").select("sig", "doc", "bits").join(nodes, "sig", "left_semi")
    spoken = written(spoken.groupBy("sig").agg(F.min("doc").alias("doc"), F.first("bits", True).alias("bits")), "spoken")
    cells = _cells(regions, spoken, num, den)
    told = spoken.select("sig", "doc").join(bounded(written(cells.select("sig").distinct(), "nodes")), "sig", "left_semi")
    told = written(told, "told")
    wanted = bounded(written(told.where("doc is not null").select(F.col("doc").alias("rep"), "sig"), "wanted"))
    kind = "sig long, grams binary, bits binary"
    named = docs.join(wanted, F.col("doc") == F.col("rep")).select("sig", "text").mapInArrow(_packed_sets(words), kind)
    unnamed = docs.where("doc is null").select(F.lit(None).cast("long").alias("sig"), "text").mapInArrow(_packed_sets(words), kind)
    unnamed = unnamed.join(told.where("doc is null").select("sig"), "sig", "left_semi").dropDuplicates(["sig"])
    sets = written(named.union(unnamed), "sets")
    links = _links(cells, sets, num, den)
    labels = bounded(written(connected_components(links), "labels").withColumnRenamed("node", "sig"))
    classes.unpersist()

    ids = table.select("doc", "n", "sig")
    named = ids.where("n > 0").join(labels, "sig", "left").select("doc", "n", F.coalesce("label", "sig").alias("label"))
    least = named.groupBy("label").agg(F.min("doc").alias("component"))
    linked = named.join(least, "label").select("doc", "n", "component")
    alone = ids.where("n = 0").select("doc", "n", F.col("doc").alias("component"))
    dropped(regions, spoken, cells, sets, links)
    return linked.union(alone).select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def _regions(table: DataFrame, num: int, den: int) -> DataFrame:
    """(region, sig, n): the documents of every pivot's region, as a table; regions of the same members are one."""
    # one exchange by key serves the pivots and the members
    dealt = table.select(F.explode("keys").alias("key"), "sig", "n").repartition("key")
    pick = F.min(F.struct(F.xxhash64("sig").alias("o"), "sig"))
    pivots = dealt.groupBy("key").agg(pick.alias("x"), F.min("sig").alias("lo"), F.max("sig").alias("hi")).where("lo <> hi")
    met = dealt.distinct().join(pivots.select("key", F.col("x.sig").alias("region")), "key")
    members = written(met.groupBy("region", "sig", "n").agg(F.count("*").alias("shared")), "members")
    # The smallest partner has this many shingles, and shares at least as many keys as its prefix
    # is longer than the plain one; whoever shares fewer with all others together links with none.
    least = F.floor(F.ceil(F.col("n") * num / den) / MORE) + 1
    enough = members.groupBy("sig", "n").agg(F.sum("shared").alias("shared")).where(F.col("shared") >= least).select("sig")
    members = written(members.join(bounded(written(enough, "enough")), "sig", "left_semi").select("region", "sig", "n"), "members")
    # and so does whoever has no other member of about its size around
    band = F.floor(F.log("n") / F.log(F.lit(1.01 * den / num)))
    members = members.withColumn("band", band)
    held = members.groupBy("region", "band").agg(F.count("*").alias("k"))
    around = held.select("region", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"), "k")
    around = around.groupBy("region", "band").agg(F.sum("k").alias("k")).where("k > 1")
    members = written(members.join(around, ["region", "band"], "left_semi").drop("band"), "members")
    alike = members.groupBy("region").agg(F.bit_xor(F.xxhash64("sig")).alias("x"), F.sum("n").alias("y"), F.count("*").alias("z"))
    alike = alike.where("z > 1").groupBy("x", "y", "z").agg(F.min("region").alias("region"))
    return written(members.join(bounded(written(alike.select("region"), "regions")), "region", "left_semi"), "regions")


def _cells(regions: DataFrame, spoken: DataFrame, num: int, den: int) -> DataFrame:
    """(cell, sig, n): members of a region that parity bits do not tell apart, as a table.

    Bits are a small part of the sets, so only documents that may link send their sets to tasks.
    Regions too large for one task stay as they are.
    """
    heavy = regions.groupBy("region").agg((F.sum("n") + 128 * F.count("*")).alias("bytes")).where(F.col("bytes") > REGION_BYTES)
    heavy = written(heavy.select("region"), "heavy")
    light = bounded(written(regions.join(heavy, "region", "left_anti"), "light")).join(spoken.select("sig", "bits"), "sig")
    cells = light.groupBy("region").applyInArrow(_candidates(num, den), "cell string, sig long, n long").distinct()
    whole = regions.join(heavy, "region", "left_semi").select(F.col("region").cast("string").alias("cell"), "sig", "n")
    return written(cells.union(whole), "cells")


def _links(cells: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links that connect every class, found cell by cell."""
    found, level, solid = None, 0, None
    while True:
        weight = cells.groupBy("cell").agg((8 * F.sum("n")).alias("bytes"), F.count("*").alias("m"))
        heavy = written(weight.where((F.col("bytes") > REGION_BYTES) & (F.col("m") > 2)), "heavy")
        if not heavy.limit(1).count():
            break
        light = cells.join(heavy.select("cell"), "cell", "left_anti").select("cell", "sig", "n")
        parts, joined = _dealt(cells.join(heavy, "cell"), sets, num, den, level)
        found = joined if found is None else found.union(joined)
        # parts that are hardly smaller than what they come from are dealt into pairs of blocks
        big = parts.groupBy("parent", "cell").agg((8 * F.sum("n")).alias("now"), F.count("*").alias("k"), F.max("m").alias("m"))
        big = big.where((F.col("now") > REGION_BYTES) & (F.col("k") > SHRUNK * F.col("m"))).select("parent").distinct()
        whole = cells.join(heavy, "cell").join(big, F.col("cell") == F.col("parent"), "left_semi")
        n_blocks = F.ceil(F.col("bytes") / (REGION_BYTES / 2))
        block = F.pmod(F.xxhash64("sig"), n_blocks)
        pair = F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1))
        pairs = whole.select("cell", "sig", "n", block.alias("i"), pair.alias("j")).where("i <> j")
        name = F.concat_ws("/", "cell", F.least("i", "j"), F.greatest("i", "j"))
        blocks = pairs.select(name.alias("cell"), "sig", "n")
        solid = blocks if solid is None else solid.union(blocks)
        cells = written(light.union(parts.join(big, "parent", "left_anti").select("cell", "sig", "n")), "cells")
        level += 1
    if solid is not None:
        cells = cells.union(solid)
    full = bounded(written(cells.select("cell", "sig"), "cells")).join(sets, "sig")
    links = full.groupBy("cell").applyInArrow(_solved(num, den), "a long, b long")
    return written(links if found is None else links.union(found), "links")


def _dealt(members: DataFrame, sets: DataFrame, num: int, den: int, level: int):
    """(parent, cell, sig, n, m) of the Voronoi cells of heavy cells' pivots, and (a, b) of links to pivots."""
    slot = F.pmod(F.xxhash64(F.lit(level), "sig"), F.lit(2 * PIVOTS))
    picked = members.groupBy("cell", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("sig", F.lit(level)).alias("o"), "sig")).alias("x"))
    picked = picked.select("cell", F.col("x.sig").alias("sig")).join(sets, "sig")
    pivots = picked.groupBy("cell").agg(F.collect_list(F.struct("sig", "grams")).alias("pivots"))  # at most 2 * PIVOTS
    rows = members.join(sets, "sig").join(pivots, "cell").select("cell", "sig", "n", "m", "grams", "pivots")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for cell, sig, n, m, grams, around in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine, away = np.frombuffer(grams, dtype=np.uint64), []
                for p in around:
                    same = len(np.intersect1d(mine, np.frombuffer(p["grams"], dtype=np.uint64), assume_unique=True))
                    total = n + len(p["grams"]) // 8 - same
                    away.append(1 - same / total)
                    if p["sig"] != sig and den * same >= num * total:
                        out.append((None, None, sig, p["sig"], 0))
                near = min(away) + 2 * (1 - num / den) + 1e-9
                out += [(cell, f"{cell}.{p['sig']}", sig, n, m) for p, d in zip(around, away, strict=True) if d <= near]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["parent", "cell", "sig", "n", "m"])

    out = written(rows.mapInArrow(run, "parent string, cell string, sig long, n long, m long"), "dealt")
    return out.where("parent is not null"), out.where("parent is null").select(F.col("sig").alias("a"), F.col("n").alias("b"))


#: The same classes in DuckDB: pairs that share a shingle are counted, then labels spread.
CLASSES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0))
), n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM sh p JOIN sh q ON p.s = q.s AND p.doc_id < q.doc_id GROUP BY ALL
  ) x JOIN n na ON na.doc_id = x.a JOIN n nb ON nb.doc_id = x.b WHERE 100 * c >= 80 * (na.n + nb.n - c)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(d, r) AS (
  SELECT a, a FROM both_ways UNION SELECT reach.d, b.b FROM reach JOIN both_ways b ON b.a = reach.r
), least_one AS (SELECT d, min(r) AS m FROM reach GROUP BY d)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_one ON d = d.doc_id
"""
