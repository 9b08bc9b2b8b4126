"""Parquet tables by layer: replace, append, ensure, delete, merge; declared schemas, empty when absent.

Tables of the first layer that name a submission lie in buckets by its hash, one folder each, so
that a delete reads and rewrites the buckets it touches alone.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")
KEY, BUCKET = "submission_id", "_bucket"


def scratch_root(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; without that setting a local one, on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not folder and (not master.startswith("local") or master.startswith("local-cluster")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = folder or f"file://{tempfile.gettempdir()}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/veritrail-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return str(path)


class Catalog:
    """Tables under ``root/layer/name``; reading a missing one gives its declared schema, empty.

    ``buckets`` is how many parts a bucketed table has; a table keeps the number it was written with.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType | str], buckets: int = 64):
        self.spark, self.root, self.schemas, self.buckets = spark, root.rstrip("/"), schemas, buckets

    def path(self, table: str) -> str:
        layer, _, name = table.partition(".")
        if layer not in LAYERS or not name:
            raise ValueError(f"unknown layer: {table}")
        return f"{self.root}/{layer}/{name}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def schema(self, table: str) -> T.StructType:
        held = self.schemas[table]
        return T.StructType.fromDDL(held) if isinstance(held, str) else held

    def bucketed(self, table: str) -> bool:
        return table.startswith(f"{LAYERS[0]}.") and KEY in self.schema(table).names

    def bucket(self, key: str = KEY) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def exists(self, table: str) -> bool:
        """Also takes back a table that a broken-off replacement left aside."""
        fs, p = self._fs(self.path(table))
        old = self._fs(f"{self.path(table)}__old")[1]
        if not fs.exists(p) and fs.exists(old):
            fs.rename(old, p)
        return fs.exists(p)

    def _stored(self, table: str) -> DataFrame:
        schema = self.schema(table)
        if self.bucketed(table):
            schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            return self.spark.createDataFrame([], self.schema(table))
        return self._stored(table).select(*self.schema(table).names)

    def _shaped(self, table: str, df: DataFrame) -> DataFrame:
        """The declared columns in order; an optional one that is missing is null, a required one raises."""
        schema = self.schema(table)
        missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
        if missing:
            raise KeyError(f"{table} needs {', '.join(missing)}")
        return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])

    def _write(self, table: str, rows: DataFrame, path: str, mode: str) -> dict:
        """Writes shaped rows and tells their number, counted by the write itself; of a bucketed table also its buckets."""
        if not self.bucketed(table):
            seen = Observation()
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
            return seen.get
        rows = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET)
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.collect_set(BUCKET).alias("buckets"))
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        return seen.get

    def ensure(self, table: str) -> None:
        """An empty table where there is none; one that is there stays as it is."""
        if not self.exists(table):
            self.replace(table, self.spark.createDataFrame([], self.schema(table)))

    def replace(self, table: str, df: DataFrame) -> int:
        """Full refresh; an empty result still replaces. Gives the number of rows.

        The new files are complete before the old ones move aside, which go last: whatever breaks
        off leaves one whole table, which :meth:`read` finds.
        """
        path = self.path(table)
        fs, p = self._fs(path)
        old, new = (self._fs(f"{path}__{x}")[1] for x in ("old", "new"))
        fs.delete(new, True)
        n = self._write(table, self._shaped(table, df), f"{path}__new", "overwrite")["n"]
        fs.mkdirs(new)  # a bucketed table without rows has no folder yet
        fs.mkdirs(p.getParent())
        fs.delete(old, True)
        if fs.exists(p) and not fs.rename(p, old):
            raise OSError(f"{path} cannot be moved aside")
        if not fs.rename(new, p):
            raise OSError(f"{path}__new cannot take its place")
        fs.delete(old, True)
        return n

    def append(self, table: str, df: DataFrame) -> int:
        """Adds rows and gives their number."""
        return self._write(table, self._shaped(table, df), self.path(table), "append")["n"]

    def _rewritten(self, table: str, touched: list[int], change) -> None:
        """``change`` (rows to rows) for the buckets ``touched``: their folders are swapped in one commit, no other file is."""
        path, names = self.path(table), self.schema(table).names
        rows = self._stored(table).where(F.col(BUCKET).isin(touched)).select(*names)
        left = self._write(table, self._shaped(table, change(rows)), path, "overwrite")["buckets"]
        for bucket in set(touched) - set(left):  # nothing was written there, so nothing was swapped
            fs, p = self._fs(f"{path}/{BUCKET}={bucket}")
            fs.delete(p, True)

    def _touched(self, ids: DataFrame) -> list[int]:
        return [r[0] for r in ids.select(self.bucket()).distinct().collect()]  # at most ``buckets``

    def delete(self, tables: list[str], ids: DataFrame, key: str = KEY) -> None:
        """Rows of ``ids`` go from all ``tables``, table by table; rows without that key stay.

        Of a bucketed table only the buckets of ``ids`` are read and written again.
        """
        held = [t for t in tables if self.exists(t)]
        gone = self.kept(ids.select(key).distinct(), "gone")
        touched = self._touched(gone) if key == KEY else list(range(self.buckets))
        if not touched:
            return
        for table in held:
            if self.bucketed(table):
                self._rewritten(table, touched, lambda rows: rows.join(gone, key, "left_anti"))
            else:
                self.replace(table, self.read(table).join(gone, key, "left_anti"))

    def merge(self, table: str, df: DataFrame) -> None:
        """Rows of a bucketed table give way to all rows of ``df`` that share their submission; others are added.

        Doing it again changes nothing, and readers never see a submission without its rows.
        """
        rows = self.kept(self._shaped(table, df), "merged")
        touched = self._touched(rows)
        if not touched:
            return
        if not self.exists(table):
            self.append(table, rows)
            return
        ids = rows.select(KEY).distinct()
        self._rewritten(table, touched, lambda old: old.join(ids, KEY, "left_anti").unionByName(rows))

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a table beside the layers that goes with the application: later deletes and appends do not change it."""
        path = f"{self.root}/__run/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        fs, p = self._fs(path)
        fs.deleteOnExit(p)
        return self.spark.read.schema(df.schema).parquet(path)
