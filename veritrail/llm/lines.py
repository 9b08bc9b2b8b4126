"""Line dedup over all documents: exact repeats, and lines within one edit of an earlier line.

The deletion neighbourhood of a line is the line itself and every variant with one character
deleted. Two lines are within one edit exactly when one is a deletion of the other, or when
deleting the same position of both gives the same string, so equal variants of hashed keys find
every pair. A line of n characters has n variants; emitting them for every line of a corpus would
multiply it, so a line is first matched by halves: of two lines within one edit, the first or the
second half is equal. Only lines that share a half with another line emit variants. That filter
loses no pair.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keyed, mix, packed, powers, prefix_hash, row_chunks, slice_hash, spare, written

#: By default lines (stripped) of fewer code points count as repeats only if equal; 1 compares all.
MIN_CHARS = 16
SEEN = 1 << 18
_SPACE = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint32)


def _code_points(data, offsets, lo, hi):
    part = data[offsets[lo] : offsets[hi]]
    points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    begins = np.zeros(len(part) + 1, dtype=np.int64)
    np.cumsum((part & 0xC0) != 0x80, out=begins[1:])
    return points, begins[offsets[lo : hi + 1] - offsets[lo]]


def _line_spans(points, heads):
    """Start, end, row and number of every line, stripped of ASCII white space, blank ones left out."""
    breaks = np.flatnonzero(points == 10)
    start = np.concatenate([heads[:-1], breaks + 1])
    end = np.concatenate([heads[1:], breaks])
    start.sort(kind="stable")
    end.sort(kind="stable")
    row = np.searchsorted(heads, start, "right") - 1
    full = end > start
    start, end, row = start[full], end[full], np.minimum(row[full], len(heads) - 2)
    space = np.isin(points, _SPACE)
    solid = np.flatnonzero(~space)
    if not len(solid):
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero, zero, zero
    first = np.searchsorted(solid, start)
    last = np.searchsorted(solid, end) - 1
    full = last >= first
    start, end, row = solid[first[full]], solid[last[full]] + 1, row[full]
    before = np.zeros(len(points) + 1, dtype=np.int64)
    np.cumsum(points == 10, out=before[1:])
    return start, end, row, before[start] - before[heads[row]]


def _sums(points):
    return prefix_hash(mix(points.astype(np.uint64) + np.uint64(0x51ED270B)))


def _signed(x):
    return np.ascontiguousarray(x).view(np.int64)


def _tagged(h, length, tag):
    return mix(h ^ mix(length.astype(np.uint64) * np.uint64(4) + np.uint64(tag)))


def _occurrences(least):
    """(doc, line, h, keys): every line's hash, and the keys of its halves where it is long enough.

    A task gives the keys of a line that it remembers once.
    """

    def run(batches):
        import pyarrow as pa

        seen: set[int] = set()
        for batch in batches:
            data, offsets = packed(batch.column(1))
            for lo, hi in row_chunks(offsets):
                points, heads = _code_points(data, offsets, lo, hi)
                start, end, row, number = _line_spans(points, heads)
                size, sums = end - start, _sums(points)
                h = _signed(_tagged(slice_hash(sums, start, end), size, 0))
                new = size >= least
                for k in np.flatnonzero(new).tolist():
                    x = int(h[k])
                    if x in seen:
                        new[k] = False
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(x)
                keys = np.empty((int(new.sum()), 4), dtype=np.uint64)
                for shorter in (0, 1):  # as the line of n characters, and as the longer of n and n + 1
                    n = size[new] - shorter
                    cut = n // 2
                    keys[:, 2 * shorter] = _tagged(slice_hash(sums, start[new], start[new] + cut), n, 1)
                    keys[:, 2 * shorter + 1] = _tagged(slice_hash(sums, end[new] - (n - cut), end[new]), n, 2)
                lists = np.concatenate([[0], np.cumsum(4 * new)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                        pa.array(number.astype(np.int32)),
                        pa.array(h),
                        pa.ListArray.from_arrays(pa.array(lists), pa.array(_signed(keys.ravel()))),
                    ],
                    names=["doc", "line", "h", "keys"],
                )

    return run


def _variants(batches):
    """Hashed keys of the deletion neighbourhood: (key, h, own) for each line (h, text)."""
    import pyarrow as pa

    for batch in batches:
        data, offsets = packed(batch.column(1))
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi in row_chunks(offsets, 1 << 15):
            points, heads = _code_points(data, offsets, lo, hi)
            made = []
            for k in range(lo, hi):
                codes = points[heads[k - lo] : heads[k - lo + 1]]
                n = len(codes)
                sums = prefix_hash(mix(codes.astype(np.uint64) + np.uint64(0x51ED270B)))
                at = np.arange(n)
                # what stands before the deleted character, and what stands after it moved up
                after = slice_hash(sums, at + 1, np.full(n, n)) * powers(n)[0][:n]
                variant = sums[:n] + after
                size = np.full(n, n, dtype=np.int64)
                swap = mix(_tagged(variant, size, 1) + at.astype(np.uint64))
                drop = np.unique(_tagged(variant, size - 1, 2))
                self_key = _tagged(sums[n:], size[:1], 2)
                keys = _signed(np.concatenate([swap, drop, self_key]))
                own = np.zeros(len(keys), dtype=bool)
                own[-1] = True
                made.append((keys, np.full(len(keys), ids[k]), own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*made, strict=True)], names=["key", "h", "own"]
            )


def _texts(least):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = packed(batch.column(1))
            for lo, hi in row_chunks(offsets):
                points, heads = _code_points(data, offsets, lo, hi)
                start, end, row, number = _line_spans(points, heads)
                long = end - start >= least
                start, end, row, number = start[long], end[long], row[long], number[long]
                whole = points.tobytes().decode("utf-32-le")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo).take(pa.array(row)),
                        pa.array(number.astype(np.int32)),
                        pa.array([whole[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], pa.string()),
                    ],
                    names=["doc", "line", "text"],
                )

    return run


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, line, h, exact, near) for every line that is not blank.

    Lines are split at line feeds and stripped of ASCII white space; ``line`` counts from 0. The
    earliest occurrence is the one of smallest (doc, line), a null id first. ``exact``: an equal
    line stands earlier. ``near``: the line differs by one inserted, deleted or replaced code
    point from a line that stands earlier (both of ``min_chars`` code points or more). An id must name
    one row: the functions below give rows numbers of their own.
    """
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc"].dataType.simpleString()
    occ = written(docs.mapInArrow(_occurrences(min_chars), f"doc {kind}, line int, h long, keys array<long>"), "occurrences")
    place = F.struct("doc", "line")
    first = occ.groupBy("h").agg(F.min(place).alias("first"))

    halves = occ.where(F.size("keys") > 0).select(F.explode("keys").alias("key"), "h")
    several = halves.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    flagged = halves.join(several, "key", "left_semi").select("h").distinct()
    first = written(
        first.join(flagged.withColumn("flag", F.lit(True)), "h", "left").select("h", "first", F.coalesce("flag", F.lit(False)).alias("flag")),
        "lines",
    )
    spots = first.where("flag").select("h", F.col("first.doc").alias("d"), F.col("first.line").alias("l"))
    wanted = spots.groupBy("d").agg(F.count("*").alias("lines"))
    texts = docs.join(wanted, F.col("doc").eqNullSafe(F.col("d")), "left_semi").mapInArrow(_texts(min_chars), f"doc {kind}, line int, text string")
    texts = written(
        spots.join(texts, F.col("doc").eqNullSafe(F.col("d")) & (F.col("line") == F.col("l"))).select("h", "doc", "line", "text"),
        "texts",
    )
    near = _near_lines(texts)
    marked = (
        occ.join(first.select("h", "first"), "h")
        .join(near.withColumn("near", F.lit(True)), "h", "left")
        .select(
            "doc",
            "line",
            "h",
            (~F.col("first").eqNullSafe(place)).alias("exact"),
            F.coalesce("near", F.lit(False)).alias("near"),
        )
    )
    return marked


def _near_lines(texts: DataFrame) -> DataFrame:
    """(h) of the lines that stand within one edit after another line of ``texts`` (h, doc, line, text)."""
    keys = texts.select("h", "text").mapInArrow(_variants, "key long, h long, own boolean")
    equal = keys.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    keys = written(keys.join(equal, "key", "left_semi"), "variants").join(texts.select("h", "doc", "line"), "h")
    spot = F.struct("doc", "line", "h")
    groups = keys.groupBy("key").agg(
        F.min(spot).alias("early"),
        F.min(F.when(F.col("own"), spot)).alias("own_spot"),
        F.min(F.when(~F.col("own"), spot)).alias("other"),
    )
    # Of lines that differ at one position all are within one edit of the earliest. Of a line and
    # those that delete to it, each longer one is compared with the line, and the line with the
    # earliest longer one. So one witness for each line and key is enough.
    witness = F.when(F.col("own"), F.col("other")).when(F.col("own_spot").isNotNull(), F.col("own_spot")).otherwise(F.col("early"))
    pairs = keys.join(groups, "key").select("h", spot.alias("spot"), witness.alias("witness"))
    pairs = pairs.where("witness is not null and witness < spot").select("h", F.col("witness.h").alias("w")).distinct()
    mine = texts.select("h", F.col("text").alias("x"))
    theirs = texts.select(F.col("h").alias("w"), F.col("text").alias("y"))
    return (
        pairs.join(mine, "h").join(theirs, "w").where(F.levenshtein("x", "y", 1).between(0, 1)).select("h").distinct()
    )


def _numbered(docs: DataFrame, id_col: str, text_col: str):
    """(rows, name of their number, marked lines with doc = (id, number)): each row is a document."""
    row = spare(docs.columns, "_row")
    rows = keyed(docs, row)
    key = F.struct(F.col(id_col).alias("id"), F.col(row).alias("row"))
    return rows, row, rows.select(key.alias("key"), F.col(text_col).alias("text"))


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row: id, n_lines, n_exact and n_near (dropped for either reason), n_kept.

    Null, empty and blank texts have no lines. Rows that share an id, or have none, are documents
    of their own, in any order among them; the earliest line is the one of the smallest id, null first.
    """
    rows, row, lines = _numbered(docs.select(id_col, text_col), id_col, text_col)
    marked = line_table(lines, "key", "text", min_chars)
    sums = marked.groupBy(F.col("doc.row").alias("at")).agg(
        F.count("*").alias("n_lines"),
        F.count_if("exact").alias("n_exact"),
        F.count_if(~F.col("exact") & F.col("near")).alias("n_near"),
    )
    out = rows.select(F.col(id_col).alias("id"), F.col(row).alias("row")).join(sums, F.col("row") == F.col("at"), "left")
    out = out.na.fill(0, ["n_lines", "n_exact", "n_near"])
    return out.select(
        F.col("id").alias(id_col), "n_lines", "n_exact", "n_near", (F.expr("n_lines - n_exact - n_near")).alias("n_kept")
    )


def deduped_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_chars_col: str | None = None, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; blank lines stay where they are.

    A document all of whose lines stood earlier (it had some) is left out; others keep their row,
    null and empty texts as they are. Each row is a document of its own, whatever its id; of rows
    that share an id any may count as the earlier one. Other columns stay, whatever their names.
    """
    rows, row, lines = _numbered(docs, id_col, text_col)
    marked = line_table(lines, "key", "text", min_chars)
    gone, whole = spare(rows.columns, "_gone"), spare(rows.columns, "_whole")
    lost = (
        marked.groupBy(F.col("doc.row").alias(row))
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("exact") | F.col("near"), F.col("line")))).alias(gone),
            F.bool_and(F.col("exact") | F.col("near")).alias(whole),
        )
        .where(F.size(gone) > 0)
    )
    split = F.split(F.col(text_col), "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    text = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    out = rows.join(lost, row, "left").where(~F.coalesce(F.col(whole), F.lit(False)))
    out = out.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(text))
    if n_chars_col:
        size = F.when(F.col(gone).isNull(), F.col(n_chars_col)).otherwise(F.length(text_col))
        out = out.withColumn(n_chars_col, size.cast(docs.schema[n_chars_col].dataType))
    return out.select(*docs.columns)


#: The same result in DuckDB, by deleting every position of every line.
LINES_SQL = r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL
), occ AS (
  SELECT doc_id, no, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM raw
), full_occ AS (SELECT * FROM occ WHERE line <> ''),
uniq AS (
  SELECT line, min(row(doc_id, no)) AS first, length(line) AS n FROM full_occ GROUP BY line
), long AS (SELECT * FROM uniq WHERE n >= 16),
cuts AS (
  SELECT line, first, n, i, substr(line, 1, i - 1) || substr(line, i + 1) AS v
  FROM (SELECT line, first, n, unnest(range(1, n + 1)) AS i FROM long)
), near AS (
  SELECT a.line FROM cuts a JOIN cuts b ON a.v = b.v AND a.i = b.i AND a.n = b.n
  WHERE a.line <> b.line AND b.first < a.first
  UNION SELECT a.line FROM cuts a JOIN long b ON a.v = b.line AND a.n = b.n + 1 WHERE b.first < a.first
  UNION SELECT b.line FROM cuts a JOIN long b ON a.v = b.line AND a.n = b.n + 1 WHERE a.first < b.first
), marked AS (
  SELECT o.doc_id, row(o.doc_id, o.no) <> u.first AS exact, o.line IN (SELECT line FROM near) AS near
  FROM full_occ o JOIN uniq u ON u.line = o.line
), sums AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact,
         count(*) FILTER (NOT exact AND near) AS n_near
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_exact, 0) AS BIGINT) AS n_exact,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
       CAST(coalesce(n_lines - n_exact - n_near, 0) AS BIGINT) AS n_kept
FROM documents d LEFT JOIN sums s ON s.doc_id IS NOT DISTINCT FROM d.doc_id
"""
