"""The incremental extract as a stream with state of its own.

Where ``extract_stream`` reads the store's snapshots in every micro-batch, here
each point has its state in Spark's state store (``transformWithState``): the
time of its newest staged reading, the number of ids it has used, and the
readings that wait for their day. A micro-batch touches the state of the points
it brings readings for and nothing else; its cost does not depend on how many
points, runs or snapshots there are.

* A reading at or before the point's ``newest + buffer`` (the first lookback for
  a new point) is late and dropped, as in the batch form.
* A reading after the end of the present day is held in the point's list. In a
  stream that goes on, a timer at that end releases it: no later file is needed,
  and no call. (In one that stops when it has read what is there, no timer runs;
  what is due is released with the point's next reading. A checkpoint belongs to
  one of the two.)
* What is accepted leaves with the ids used so far; the numbering itself is
  ``assign_sequence`` over the micro-batch, which splits hot points. The state
  function passes a point's readings through part by part and holds none.

Days are those of the clock plus ``clock_offset`` (UTC): 0 in production, or
what makes a replay's day the present one. A replayed micro-batch gets the
state and the run id it had, and writes its rows in place.

The state store must be RocksDB; it is asked for when the stream is started.
"""

from __future__ import annotations

import datetime as dt
import itertools
import sys
import time
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from .. import config
from ..functions.names import normalise_point
from ..functions.temporal import from_micros, round_reading, to_micros
from ..operators.extract import manifest_points
from ..operators.sequence import assign_sequence
from ..session import written
from ..sources.store import RunIds, StagedStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])   # executors need no copy of the package

DAY = 86_400_000_000       # microseconds
OUTPUT = "point string, us bigint, value double, rest string, base_id bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Held readings that are released at a time.
PART = 10_000


class PointProcessor(StatefulProcessor):
    def __init__(self, buffer_us: int, window_days: int, offset_ms: int, timed: bool):
        self.buffer, self.window, self.offset, self.timed = buffer_us, window_days, offset_ms, timed

    def init(self, handle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "newest bigint, used bigint")
        self.held = handle.getListState("held", "us bigint, value double, rest string")

    def _day_end(self, timers) -> int:
        clock = timers.getCurrentProcessingTimeInMs() if self.timed else int(time.time() * 1000)
        now = (clock + self.offset) * 1000
        return now - now % DAY + DAY

    def _accept(self, point: str, parts: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        end = self._day_end(timers)
        newest, used = self.mark.get() if self.mark.exists() else (None, 0)
        start = end - DAY - self.window * DAY if newest is None else newest + self.buffer
        last, count, waiting = newest, 0, False
        for part in parts:
            part = part[["us", "value", "rest"]]
            wait = part["us"] >= end
            if wait.any():
                waiting = True
                rows = part[wait].astype(object).where(part[wait].notna(), None)
                self.held.appendList([(int(u), None if v is None else float(v), r)
                                      for u, v, r in rows.itertuples(index=False)])
            take = part[~wait & (part["us"] > start)]
            if len(take):
                count += len(take)
                top = int(take["us"].max())
                last = top if last is None else max(last, top)
                yield take.assign(point=point, base_id=used)[["point", "us", "value", "rest", "base_id"]]
        if last is not None:
            self.mark.update((last, used + count))
        if waiting and self.timed:
            self.handle.registerTimer(end // 1000 - self.offset)

    def _released(self) -> Iterator[pd.DataFrame]:
        """What was held, to be read anew; what is for a later day is held again."""
        rows = list(self.held.get()) if self.held.exists() else []
        self.held.clear()
        for k in range(0, len(rows), PART):
            yield pd.DataFrame(rows[k:k + PART], columns=["us", "value", "rest"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = rows if self.timed else itertools.chain(self._released(), rows)
        yield from self._accept(key[0], parts, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._accept(key[0], self._released(), timerValues)

    def close(self) -> None:
        pass


def start_stateful_extract(spark: SparkSession, source_dir: str, schema: T.StructType, root: str, points: DataFrame,
                           checkpoint_location: str, point_col: str = "point", ts_col: str = "ts",
                           value_col: str = "value", buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                           window_days: int = config.ROLLING_WINDOW_DAYS, clock_offset: dt.timedelta = dt.timedelta(0),
                           max_files_per_trigger: int | None = None, interval: str | None = None) -> StreamingQuery:
    """Stage the Parquet files of ``source_dir`` into the store at ``root``.

    ``points``: the manifest. With ``interval`` (such as ``"1 minute"``) the
    stream goes on, and timers release held readings; without it, it takes up
    what is there and stops. All other columns of the source order readings of
    one time, after the value.
    """
    staged, ids = StagedStore(spark, root), RunIds(spark, root)
    kind = schema[ts_col].dataType
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rest = sorted(f.name for f in schema.fields if f.name not in (point_col, ts_col, value_col))
    own = reader.parquet(source_dir).filter(F.col(ts_col).isNotNull()).select(
        normalise_point(point_col).alias("point"), to_micros(ts_col, kind).alias("us"),
        round_reading(value_col).alias("value"),
        (F.to_json(F.struct(*rest)) if rest else F.lit(None).cast("string")).alias("rest"))
    listed = written(manifest_points(points), "stream-points")
    processor = PointProcessor(round(buffer_seconds * 1_000_000), window_days, round(clock_offset.total_seconds() * 1000),
                               interval is not None)
    accepted = own.join(listed, "point", "left_semi").groupBy("point").transformWithStateInPandas(
        processor, OUTPUT, "Append", "ProcessingTime" if interval else "None")

    def stage(batch: DataFrame, batch_id: int) -> None:
        rows = written(batch, "stateful-batch").withColumn("ts", from_micros(F.col("us"), kind))
        if rows.isEmpty():                       # nothing due, as in most rounds of a timer
            return
        run_id = ids.claim(f"stateful-{checkpoint_location}", str(batch_id))
        # a point that was released and read in one micro-batch has rows from two bases
        numbered = assign_sequence(rows, ["point", "base_id"], "ts", ["value", "rest"], base="base_id")
        staged.write_run(numbered.select("point", "unique_id", "ts", "value"), run_id)

    writer = accepted.writeStream.outputMode("append").foreachBatch(stage).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(_PROVIDER, before)


def point_state(spark: SparkSession, checkpoint_location: str) -> DataFrame:
    """``point, newest, last_used_id`` as the state store has them."""
    kept = (spark.read.format("statestore").option("path", checkpoint_location)
            .option("stateVarName", "mark").load())
    return kept.select(F.col("key.point").alias("point"), F.col("value.newest").alias("newest"),
                       F.col("value.used").alias("last_used_id"))
