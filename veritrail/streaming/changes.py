"""Incremental landing: files stream in, and the last version of each submission is kept as state.

A batch looks at its own rows and their submissions' state, never at the whole table. State survives
restarts with the stream's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.tables import Catalog

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: When a version came: the time of its file, the file, its place there. The greatest is the latest.
VERSION = ("_at", "_file", "_place")


class Versions(StatefulProcessor):
    """Remembers each submission's latest hash and when it came; tells what is new or changed.

    Of several versions in a batch the latest counts. One that is older than what is known, or that
    has the same hash, is told of no more; the same hash again still moves the time on.
    """

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "content_hash string, _at bigint, _file string, _place bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        latest = max(rows, key=lambda r: tuple(r[c] for c in VERSION))
        known = self.last.get() if self.last.exists() else None
        came = tuple(latest[c] for c in VERSION)
        if known is None or known[1] is None or came > tuple(known[1:]):
            self.last.update((latest["content_hash"], *came))
            if known is None or known[0] is None or known[0] != latest["content_hash"]:
                yield Row(**{c: latest[c] for c in self.columns}, action="new" if known is None else "changed")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.last.update((initialState["content_hash"], None, None, None))

    def close(self) -> None:
        pass


def changes(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(columns of ``rows``, action): the stream of new and changed submissions.

    ``rows`` has submission_id, content_hash and the columns of ``VERSION``. ``known`` (submission_id,
    content_hash) is what had landed before the stream began: any version of it counts as later.
    """
    columns = [c for c in rows.columns if c not in VERSION]
    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in columns], "action string"])
    first = known.select("submission_id", "content_hash").groupBy("submission_id") if known is not None else None
    return rows.groupBy("submission_id").transformWithState(Versions(columns), schema, "Append", "None", first)


def landed(catalog: Catalog, table: str, batch: DataFrame, mark: str) -> None:
    """One batch of :func:`changes`: new rows are added, changed ones take the place of what was.

    Files named ``mark`` tell that a batch began and ended. A batch that began before and did not end
    is merged as a whole, so nothing lands twice.
    """
    fs, begun = catalog._fs(f"{mark}.begun")
    _, done = catalog._fs(f"{mark}.done")
    if fs.exists(done):
        return
    again = fs.exists(begun)
    fs.create(begun, True).close()
    rows = catalog.kept(batch, "events")
    if again:
        catalog.merge(table, rows.drop("action"))
    else:
        catalog.merge(table, rows.where("action = 'changed'").drop("action"))
        catalog.append(table, rows.where("action = 'new'").drop("action"))
    fs.create(done, True).close()


def stream(spark: SparkSession, folder: str, schema: str, catalog: Catalog, table: str, checkpoint: str):
    """Parquet files of a folder, taken as they come; stops when all there are have landed.

    The session of ``spark`` keeps its settings: the state store is set in one of the stream's own.
    """
    own = spark.newSession()
    own.conf.set(_STORE, _ROCKSDB)
    rows = own.readStream.schema(schema).parquet(folder)
    rows = rows.select(
        "*",
        F.unix_micros("_metadata.file_modification_time").alias("_at"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    mine = Catalog(own, catalog.root, catalog.schemas, catalog.buckets)
    found = changes(rows, mine.read(table))

    def land(batch: DataFrame, number: int) -> None:
        told = Catalog(batch.sparkSession, catalog.root, catalog.schemas, catalog.buckets)
        landed(told, table, batch, f"{checkpoint}/landed/{number}")

    return found.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
