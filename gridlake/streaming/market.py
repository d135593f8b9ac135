"""Structured Streaming forms of batch operators, each equal to its batch twin once the stream has been read."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.expressions import local_date, local_hour, weighted_price
from ..operators.incremental import insert_once, upsert

C = F.col
#: Keyed state with timers lies in this store.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class KeepOne(StatefulProcessor):
    """The one row of each key that counts, by a column: the greatest, which later rows can exceed, or the first that came.

    State is a row a key, and a timer frees it once the watermark is ``keep_ms`` past the row's own time, when no row of
    that time can come any more.
    """

    def __init__(self, schema: T.StructType, order: str, instant: str, keep_ms: int, first: bool):
        self.schema, self.order, self.instant, self.keep_ms, self.first = schema, order, instant, keep_ms, first

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.held.get() if self.held.exists() else None
        if held is not None and self.first:
            return
        place = self.schema.names.index(self.order)
        pick = min if self.first else max
        best = pick((tuple(r) for r in rows), key=lambda r: r[place])
        if held is None or best[place] > held[place]:
            self.held.update(best)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            own = int(best[self.schema.names.index(self.instant)].replace(tzinfo=timezone.utc).timestamp() * 1000)
            self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), own) + self.keep_ms)
            yield Row(**dict(zip(self.schema.names, best, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def _one_of_each(stream: DataFrame, keys: list[str], order: str, instant: str, keep: str, first: bool) -> DataFrame:
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    keep_ms = int(spark.sql(f"SELECT unix_millis(timestamp '1970-01-01' + interval {keep})").first()[0])
    processor = KeepOne(stream.schema, order, instant, keep_ms, first)
    return stream.withWatermark(instant, keep).groupBy(*keys).transformWithState(processor, stream.schema, "Update" if not first else "Append", "EventTime")


def newest_corrections(corrections: DataFrame, keys: list[str], newest: str = "arrived", instant: str = "at", keep: str = "60 days") -> DataFrame:
    """A row whenever a key gets a newer correction; older ones that come later are told from it by state, however batches fall."""
    return _one_of_each(corrections, keys, newest, instant, keep, first=False)


def first_predictions(predictions: DataFrame, keys: list[str], order: str, instant: str = "at", keep: str = "60 days") -> DataFrame:
    """The first prediction of each key, once; what comes later for it is dropped."""
    return _one_of_each(predictions, keys, order, instant, keep, first=True)


def keyed_upsert_stream(corrections: DataFrame, path: str, keys: list[str], checkpoint: str, newest: str = "arrived", instant: str = "at") -> StreamingQuery:
    """Corrections that state lets through go into the table; nothing that is older than what was written reaches it."""

    def write(batch: DataFrame, _: int) -> None:
        # A batch that runs again after a stop finds its own rows there and changes nothing.
        upsert(batch.drop(instant), path, keys, newest=newest)

    told = newest_corrections(corrections, keys, newest, instant)
    return told.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_by_id(trades: DataFrame, delay: str = "1 hour", instant: str = "ts") -> DataFrame:
    """Replays of an id within the delay are dropped; state is kept for the delay alone."""
    return trades.withWatermark(instant, delay).dropDuplicatesWithinWatermark(["id"])


def hourly_vwap(trades: DataFrame, delay: str = "1 hour", instant: str = "ts") -> DataFrame:
    """Volume-weighted price of each hour, final when the watermark has passed it."""
    hours = trades.withWatermark(instant, delay).groupBy(F.window(instant, "1 hour").alias("w"))
    made = hours.agg(weighted_price().alias("gip_vwap_try"), F.sum("quantity_mwh").alias("gip_volume_mwh"), F.count("*").alias("gip_transaction_count"))
    return made.select(local_date("w.start").alias("date"), local_hour("w.start").alias("hour"), "gip_vwap_try", "gip_volume_mwh", "gip_transaction_count")


def upsert_stream(corrections: DataFrame, path: str, keys: list[str], checkpoint: str, newest: str = "arrived") -> StreamingQuery:
    """Late corrections go into the table by key; a batch that runs twice changes nothing, and one that comes late changes no newer row."""

    def write(batch: DataFrame, _: int) -> None:
        latest = batch.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), newest).alias("v"))
        upsert(latest.select(*keys, "v.*"), path, keys, newest=newest)

    return corrections.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def snapshot_stream(predictions: DataFrame, path: str, keys: list[str], checkpoint: str, partition: str = "predicted_date", order: str | None = None) -> StreamingQuery:
    """The first prediction of each hour stays for good."""

    def write(batch: DataFrame, _: int) -> None:
        insert_once(batch, path, keys, partition, order)

    return predictions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all that is there, into a table, and read it."""
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
