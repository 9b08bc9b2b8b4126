"""Shared plumbing of the text operators: tables between steps, and packed text access."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in ``spark.checkpoint.dir``.

    Where the setting is missing, one process (master ``local``) takes a folder of its own; a
    cluster raises, as its machines would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='veritrail-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: cuts the lineage.

    The table goes with the application, or earlier by :func:`dropped`. A query's shuffle files go as
    soon as the query ends, unless the session has a setting of its own for that.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    if not spark._jsparkSession.sessionState().conf().contains(_CLEANUP):
        spark.conf.set(_CLEANUP, "true")
    df.write.parquet(path)
    fs, p = _at(spark, path)
    fs.deleteOnExit(p)
    getattr(_LOCAL, "made", []).append(path)
    return spark.read.schema(df.schema).parquet(path)


_LOCAL = threading.local()


def stage(f):
    """A pipeline stage f(spark, docs, sf_dir) that first deletes the tables of earlier stages of its thread.

    A stage's result is written before the next one begins, so only tables that ``docs`` itself
    still reads are kept: a result that was not written must go to the next stage or be read before it.
    """

    @functools.wraps(f)
    def run(spark, docs, sf_dir):
        held, rest = docs.inputFiles(), []
        for path in getattr(_LOCAL, "left", []):
            if any(path.rsplit("/", 1)[1] in x for x in held):
                rest.append(path)
            else:
                fs, p = _at(spark, path)
                fs.delete(p, True)
        _LOCAL.made = []
        try:
            return f(spark, docs, sf_dir)
        finally:
            _LOCAL.left = rest + _LOCAL.made
            del _LOCAL.made

    return run


def spare(columns: list[str], name: str) -> str:
    """``name``, longer by underscores until no column is called so."""
    held = {c.lower() for c in columns}
    while name.lower() in held:
        name += "_"
    return name


def keyed(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` as a written table with a unique number of each row, ``name``."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), "keyed")


#: Bytes of rows that are broadcast at most.
BROADCAST_BYTES = 32 << 20


def bounded(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast if its rows take at most ``most`` bytes; else joins shuffle it."""
    long = [c for c, kind in table.dtypes if kind in ("string", "binary")]
    width = 16 + 8 * len(table.columns)
    row = table.agg(F.count("*").alias("n"), *[F.sum(F.octet_length(c)).alias(f"b{k}") for k, c in enumerate(long)]).first()
    return F.broadcast(table) if row["n"] * width + sum(x or 0 for x in row[1:]) <= most else table


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that no result reads any more."""
    for df in tables:
        for name in df.inputFiles()[:1]:
            with contextlib.suppress(Exception):
                fs, p = _at(df.sparkSession, name)
                fs.delete(p.getParent(), True)


def ascii_lower(col):
    """A-Z to a-z, every other code point as it is (``lower`` would also fold other scripts)."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(
        F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


# ---- packed text -----------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Running sums of code * base**position; a slice's hash is ``slice_hash``."""
    up, _ = powers(len(codes) + 1)
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-free hash of codes[start:end]."""
    _, down = powers(len(sums))
    return (sums[end] - sums[start]) * down[start]


def packed(array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column, without copying; null is empty."""
    import pyarrow as pa

    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if pa.types.is_null(array.type):
        array = array.cast(pa.string())
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(array):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(array) + 1, dtype=np.int64)
    offs = np.frombuffer(offsets, dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)), offs


def row_chunks(offsets: np.ndarray, limit: int = 1 << 20):
    """Row ranges of about ``limit`` bytes of whole rows; a longer row stands alone."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def byte_table(pattern_bytes) -> np.ndarray:
    """256 flags: which bytes belong to words."""
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: Words ``[^\x20\x09-\x0D]+`` by byte: anything but the six ASCII white-space characters.
NOT_SPACE = byte_table(set(range(256)) - {0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D})
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: A scrambled value for every byte after lower-casing A-Z.
BYTE_CODES = mix(LOWER.astype(np.uint64) + np.uint64(0x1234567))


def word_spans(data: np.ndarray, starts: np.ndarray, table: np.ndarray):
    """Word starts, ends and rows in ``data``; ``starts`` are the rows' first bytes, ascending."""
    mask = table[data]
    n = len(mask)
    if not n:
        zero = np.zeros(0, dtype=np.int64)
        return zero, zero, zero
    before = np.zeros(n, dtype=bool)
    before[1:] = mask[:-1]
    inner = starts[starts < n]
    before[inner] = False
    after = np.zeros(n, dtype=bool)
    after[:-1] = mask[1:]
    after[inner[inner > 0] - 1] = False
    first = np.flatnonzero(mask & ~before)
    end = np.flatnonzero(mask & ~after) + 1
    return first, end, np.searchsorted(starts, first, "right") - 1
