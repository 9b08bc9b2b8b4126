"""Exact dedup by two-pass Bloom filtering, with DataFrame operations only.

The first pass counts how often each position of a Bloom filter is hit and keeps the positions hit
twice or more as bitmaps. The second pass looks every row up: a text that stands in several rows has
hit all its positions as often, so a row with a position hit once is alone and passes straight
through. Only the other rows are shuffled, as digests, and their groups are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, spare, written

#: Runs of these count as one space.
BLANKS = "[\\x20\\x09-\\x0D]+"
#: Positions of the filter for each row, as a power of two is at least this many times the rows ...
BITS_A_ROW = 16
#: ... but at most so many: 64 MB of bitmaps, which bounds the broadcast. Beyond some 30 million rows
#: more rows than need be take part in the shuffle; results stay the same.
MOST_BITS = 1 << 29
#: Positions of a row.
HASHES = 2
#: Bits of one bitmap, the length that ``bitmap_construct_agg`` makes.
CHUNK = 1 << 15
#: Groups that hold one in so many rows are joined by broadcast: there are at most so many of them.
LARGE = 1024


def normalised(col: Column) -> Column:
    """A text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit("")), BLANKS, " ")


def _positions(sha: Column, bits: int) -> list[Column]:
    """Positions 0 to ``bits`` - 1 from separate parts of a hexadecimal digest."""
    return [F.pmod(F.conv(F.substring(sha, 1 + 15 * k, 15), 16, 10).cast("long"), F.lit(bits)) for k in range(HASHES)]


def _hit_twice(texts: DataFrame, bits: int) -> DataFrame:
    """(chunk, bitmap): the filter's positions that rows hit twice or more, one row for each chunk of bits."""
    hits = texts.select(F.explode(F.array(*_positions(F.col("sha"), bits))).alias("at")).groupBy("at").agg(F.count("*").alias("n"))
    chunks = hits.where("n > 1").groupBy(F.floor(F.col("at") / CHUNK).alias("chunk"))
    return chunks.agg(F.bitmap_construct_agg(F.pmod("at", F.lit(CHUNK))).alias("bitmap"))


def _looked_up(texts: DataFrame, bitmaps: DataFrame, bits: int) -> DataFrame:
    """``texts`` with ``maybe``: whether all positions of a row were hit twice or more."""
    every = F.lit(True)
    for k, at in enumerate(_positions(F.col("sha"), bits)):
        held = bitmaps.select(F.col("chunk").alias(f"chunk{k}"), F.col("bitmap").alias(f"bitmap{k}"))
        texts = texts.withColumn(f"at{k}", at)
        texts = texts.join(F.broadcast(held), F.floor(F.col(f"at{k}") / CHUNK) == F.col(f"chunk{k}"), "left")
        byte = F.expr(f"conv(hex(substring(bitmap{k}, cast(pmod(at{k}, {CHUNK}) div 8 as int) + 1, 1)), 16, 10)").cast("int")
        every = every & F.coalesce(F.getbit(byte, F.pmod(F.col(f"at{k}"), F.lit(8)).cast("int")) == 1, F.lit(False))
    return texts.select("row", "id", "sha", every.alias("maybe"))


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of ASCII white space became one space
    (SHA-256 of that text stands for it); null counts as empty, and all empty texts are one group.
    Of a group the row of the smallest id stays, rows without id last; of rows that share that id
    one stays. Each row counts for itself; other columns, whatever their names, are not read; an
    empty table gives an empty result. ``most_bits`` bounds the filter, never the result.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    texts = keyed(texts, "row")
    rows = texts.count()
    bits = min(most_bits, max(CHUNK, 1 << max(1, BITS_A_ROW * rows - 1).bit_length()))
    bitmaps = written(_hit_twice(texts, bits), "bitmaps")
    seen = _looked_up(texts, bitmaps, bits)
    maybe = seen.where("maybe").drop("maybe")
    place = F.struct(F.col("id").isNull(), "id", "row")
    groups = maybe.groupBy("sha").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = written(groups.select(F.col("sha").alias("of"), F.col("first.id").alias("keep"), F.col("first.row").alias("stays"), "n"), "groups")
    large = F.col("n") * LARGE >= rows
    known = maybe.join(F.broadcast(groups.where(large)), F.col("sha") == F.col("of"), "left")
    rest = known.where("of is null").select("row", "id", "sha").join(groups.where(~large), F.col("sha") == F.col("of"), "left")
    one = seen.where("not maybe").select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha", "row")
    several = [
        found.select(
            "id",
            F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
            F.coalesce(F.col("row") == F.col("stays"), F.lit(True)).alias("kept"),
            "sha",
            "row",
        )
        for found in (known.where("of is not null"), rest)
    ]
    every = one.union(several[0]).union(several[1])
    return every.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one that :func:`exact_copies` keeps.

    All columns stay, whatever their names; rows that share an id are told apart.
    """
    row = spare(docs.columns, "_row")
    rows = keyed(docs, row)
    # the order of ids, null last, and of rows of one id: the struct is each row's own name
    name = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    gone = exact_copies(rows.select(name.alias("name"), text_col), "name", text_col).where("not kept")
    return rows.join(gone.select(F.col("name.row").alias(row)), row, "left_anti").select(*docs.columns)


COPIES_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS rid, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, rid)
"""
