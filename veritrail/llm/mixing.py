"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source has the same expected number of copies, target / source size. Its whole
part is taken for sure; the fraction is an inclusion probability. The flight phase moves the
fractions of a chunk of documents through the null space of two constraints, the documents and the
words taken, until a dozen of them, spread over the sizes, stay fractional; what stays of all
chunks flies again, until each source has one small landing problem, solved by enumeration. Random choices come from hashes of keys, so reruns agree.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source gets at most so many times its size.
MOST = 3.0
#: Documents that fly together.
CHUNK = 2000
#: Fractional documents that a flight leaves, for the landing.
LANDING = 14
_EPS = 1e-9


def source_targets(sized: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, target) of ``sized`` (source, size).

    Shares follow the weights and add up to all sizes; a source above ``most`` times its size is
    held there and the excess is shared again among the others, until none is above. The table
    has a row per source; only sums of it reach the driver.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranks = written(per.select("source", "source_size", "n_docs"), "sources")
    # one row a source, so one ordered pass is small
    order = F.row_number().over(_by_name()) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    table = written(ranks.withColumn("k", order).withColumn("w", weight).drop("k"), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    scale, held = 0.0, -1
    while True:
        is_held = F.lit(False) if held < 0 else F.col("w") * F.lit(scale) > most * F.col("source_size")
        got = table.agg(
            F.sum(F.when(is_held, most * F.col("source_size"))).alias("fixed"),
            F.sum(F.when(~is_held, F.col("w"))).alias("free"),
            F.count_if(is_held).alias("n"),
        ).first()
        if got["n"] == held or not got["free"]:
            break
        held = got["n"]
        scale = max(scale, (total - (got["fixed"] or 0.0)) / got["free"])
    share = F.least(F.col("w") * F.lit(scale), most * F.col("source_size"))
    return table.select("source", "source_size", "n_docs", share.cast("double").alias("target"))


def _by_name():
    from pyspark.sql import Window

    return Window.orderBy(F.col("source").asc_nulls_last())


def _draw(*parts) -> float:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "big") / 2.0**64


def fly(share: list[float], size: list[float], key) -> None:
    """Move ``share`` in place, keeping its sum and the sum of share * size, until LANDING are fractional."""
    live: list[int] = []
    nxt, n, step = 0, len(share), 0
    while True:
        live = [k for k in live if _EPS < share[k] < 1 - _EPS]
        if len(live) + n - nxt <= LANDING:
            return
        while len(live) < 3 and nxt < n:
            if _EPS < share[nxt] < 1 - _EPS:
                live.append(nxt)
            nxt += 1
        if len(live) < 3:
            return
        a, b, c = live
        # orthogonal to (1, 1, 1) and to the sizes
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for k, d in zip(live, u, strict=True):
            if d > 0:
                up, down = min(up, (1 - share[k]) / d), min(down, share[k] / d)
            elif d < 0:
                up, down = min(up, share[k] / -d), min(down, (1 - share[k]) / -d)
        move = up if _draw(key, step) * (up + down) < down else -down
        step += 1
        for k, d in zip(live, u, strict=True):
            share[k] = min(1.0, max(0.0, share[k] + move * d))
            if share[k] < _EPS or share[k] > 1 - _EPS:
                share[k] = round(share[k])


def land(share: list[float], size: list[float], due: float) -> None:
    """Round the last fractions of a source, taking words as near to ``due`` as they come."""
    live = [k for k, x in enumerate(share) if _EPS < x < 1 - _EPS]
    sums = [0.0]
    for k in live:
        sums += [x + size[k] for x in sums]
    count = sum(share[k] for k in live)
    best = min(range(len(sums)), key=lambda pick: (abs(sums[pick] - due), abs(pick.bit_count() - count), pick))
    for j, k in enumerate(live):
        share[k] = float(best >> j & 1)


def _flight(last):
    def run(key, table):
        import pyarrow as pa

        doc, tie, size = (table.column(c).to_pylist() for c in ("doc", "tie", "size"))
        share = table.column("share").to_pylist()
        order = sorted(range(len(size)), key=lambda k: (-size[k], doc[k] is not None, doc[k] if doc[k] is not None else 0, tie[k]))
        # those kept for the landing spread over the sizes, so their sums come near any total
        spread = {k * len(order) // LANDING for k in range(LANDING)}
        order = [k for i, k in enumerate(order) if i not in spread] + [k for i, k in enumerate(order) if i in spread]
        share, size = [share[k] for k in order], [float(size[k]) for k in order]
        fly(share, size, (repr([k.as_py() for k in key]), last))
        if last:
            due = sum(s * x for s, x in zip(share, size, strict=True) if _EPS < s < 1 - _EPS)
            land(share, size, due)
        table = table.select(["source", "doc", "tie", "size"]).take(pa.array(order))
        return table.append_column("share", pa.array(share, pa.float64()))

    return run


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken (long), copies.

    size: words ``[^\\x20\\x09-\\x0D]+`` of the text, null 0. Documents without words take nothing.
    Rows of one id are documents of their own. A null source is a source, last in order.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = written(docs.select(F.col(id_col).alias("doc"), F.col(source_col).alias("source"), words.alias("size")), "sizes")
    targets = source_targets(sized)
    kind = sized.schema["doc"].dataType.simpleString()
    skind = sized.schema["source"].dataType.simpleString()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    facts = written(
        targets.withColumn("ratio", ratio)
        .withColumn("whole", F.floor(F.col("ratio") + _EPS))
        .withColumn("part", F.greatest(F.col("ratio") - F.col("whole"), F.lit(0.0)))
        .withColumn("chunks", F.ceil(F.col("n_docs") / CHUNK)),
        "targets",
    )
    part = sized.alias("s").join(facts.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
    # tie tells rows of one id and size apart; the rows are alike, so which is which does not matter
    wide = written(
        part.select(
            "s.source", "s.doc", "s.size", "t.source_size", "t.target", "t.whole", "t.part", "t.chunks",
            F.monotonically_increasing_id().alias("tie"),
        ),
        "wide",
    )
    flying = wide.where((F.col("size") > 0) & (F.col("part") > _EPS)).select(
        "source", "doc", "tie", "size", F.col("part").alias("share"), "chunks"
    )
    schema = f"source {skind}, doc {kind}, tie long, size long, share double"
    settled, chunks = None, facts.agg(F.max("chunks")).first()[0] or 1
    while True:
        last = chunks <= 1
        chunk = F.lit(0) if last else F.pmod(F.xxhash64("doc", "size"), F.col("chunks"))
        out = written(
            flying.withColumn("chunk", chunk.cast("long")).groupBy("source", "chunk").applyInArrow(_flight(last), schema), "flight"
        )
        whole = out.where("share <= 0.0 or share >= 1.0")
        settled = whole if settled is None else settled.union(whole)
        if last:
            break
        # a dozen a chunk stay: far fewer chunks next time
        chunks = -(-chunks * LANDING // CHUNK)
        flying = out.where("share > 0.0 and share < 1.0").withColumn("chunks", F.lit(chunks))
    got = settled.select("tie", F.col("share").alias("extra"))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0.0))).otherwise(0).cast("long")
    return (
        wide.join(got, "tie", "left")
        .withColumn("copies", copies)
        .select(
            F.col("doc").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
        )
    )
