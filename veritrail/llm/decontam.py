"""Benchmark decontamination with DataFrame operations only.

The benchmark's normalised word windows are a small hash table. Training texts are scanned once:
every window of theirs is hashed and looked up, and what is found is verified word by word. While
the table is small it is broadcast, and words never leave their row before a hit; beyond that
window hashes alone are shuffled, and hits go back to their row's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, keyed, spare, written

WORDS = 10
#: Everything but digits, a-z and code points above 7F (A-Z are lower-cased before).
BETWEEN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: The window table is broadcast up to so many bytes; beyond that hashes are shuffled.
BROADCAST_BYTES = 64 << 20


def words_of(col: Column) -> Column:
    """The words of a text; null has none."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(col), BETWEEN), ""), F.array().cast("array<string>"))


def windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """(len, hash, gram, items): each different window, its words, its items."""
    items = bench.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    at = F.when(F.size("w") >= n, F.sequence(F.lit(0), F.size("w") - n)).otherwise(F.array(F.lit(0)))
    cut = items.select("item", "w", F.explode(at).alias("i")).select(
        "item", F.slice("w", F.col("i") + 1, F.least(F.lit(n), F.size("w"))).alias("gram")
    )
    grams = cut.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return grams.select(F.size("gram").alias("len"), F.xxhash64("gram").alias("hash"), "gram", "items")


def contamination(
    docs: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_hit, n_items, items (array), spans, contaminated.

    spans are [start, length] of hit windows in words. Null, empty and wordless texts have no
    words; an item without words hits nothing; an item without id still hits. Rows of one id
    stay separate rows. A table of windows of more than ``broadcast_bytes`` is joined by shuffle.
    """
    table = written(windows(bench, text_col=text_col if text_col in bench.columns else "text", n=n), "windows")
    size = F.size("gram") * 16 + F.octet_length(F.array_join("gram", "")) + F.octet_length(F.array_join("items", "")) + 64
    facts = table.agg(F.sum(size).alias("bytes"), F.collect_set("len").alias("lens")).first()
    lens = sorted(facts["lens"]) or [n]  # at most n different lengths
    small = (facts["bytes"] or 0) <= broadcast_bytes
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    if not small:
        rows = keyed(rows, "row")
    else:
        rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", "id", words_of(F.col("text")).alias("w")).withColumn("n_words", F.size("w").cast("long"))
    cut = lambda size: F.slice("w", F.col("pos") + 1, size)
    hashed = [F.when(F.col("pos") + k <= F.col("n_words"), F.xxhash64(cut(F.lit(k)))) for k in lens]
    at = rows.select("row", "id", "w", "n_words", F.posexplode_outer("w").alias("pos", "word"))
    each = at.select("row", "id", "w", "n_words", "pos", hashed[0].alias("h"), F.lit(lens[0]).alias("l"))
    if len(lens) > 1:
        both = F.array(*[F.struct(h.alias("h"), F.lit(k).alias("l")) for h, k in zip(hashed, lens, strict=True)])
        each = at.select("row", "id", "w", "n_words", "pos", F.inline(both).alias("h", "l"))
    found = (F.col("l") == F.col("len")) & (F.col("h") == F.col("hash"))
    same = cut(F.col("len")) == F.col("gram")
    span = F.when(F.col("gram").isNotNull(), F.struct(F.col("pos").alias("start"), F.col("len").alias("length")))
    spans, items = F.collect_set(span).alias("spans"), F.collect_set("items").alias("items")
    if small:
        hits = each.join(F.broadcast(table), found & same, "left").where("gram is not null or pos is null or pos = 0")
        per = hits.groupBy("row", "id", "n_words").agg(spans, items)
    else:
        hits = each.where("h is not null").select("row", "pos", "h", "l").join(table, found).drop("h", "l", "hash")
        held = hits.join(rows.select("row", "w"), "row").where(same).groupBy("row").agg(spans, items)
        none = [F.coalesce(c, F.array().cast(held.schema[c].dataType)).alias(c) for c in ("spans", "items")]
        per = rows.select("row", "id", "n_words").join(held, "row", "left").select("row", "id", "n_words", *none)
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))
    per = per.withColumns(
        {"n_hit": F.size(F.array_distinct(covered)).cast("long"), "items": F.array_sort(F.array_distinct(F.flatten("items")))}
    )
    return per.select(
        F.col("id").alias(id_col),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        F.array_sort("spans").alias("spans"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; rows that share an id are told apart.

    Null, empty and wordless texts stay; other columns stay, whatever their names.
    """
    row = spare(docs.columns, "_row")
    rows = keyed(docs, row)
    found = contamination(rows.select(row, text_col), bench, row, text_col, n).where("contaminated")
    return rows.join(found.select(row), row, "left_anti").select(*docs.columns)


CONTAMINATION_SQL = r"""
WITH dw AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+'), []) AS w
  FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), win AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hit AS (SELECT d.rid, d.i, d.n, b.item FROM dwin d JOIN win b ON d.n = b.n AND d.g = b.g),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, list_sort(list(DISTINCT item)) AS items FROM hit WHERE item IS NOT NULL GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
