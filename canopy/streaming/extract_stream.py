"""The incremental extract as a Structured Streaming query.

Source readings arrive as Parquet files (one long table: point, ts, value,
...).  Each micro-batch is staged by the same keyed extract as a batch run:

* its run id is claimed in the store for (checkpoint folder, micro-batch id), so
  a replayed micro-batch gets the id it had, and no batch run or other stream
  shares it. High-water marks and ids come only from earlier runs, so a replay
  numbers its rows exactly as before and rewrites its own partition --
  exactly-once output on top of the at-least-once sink;
* the upper bound of a run is the end of its ``as_of`` day, which is asked anew
  for every micro-batch when ``as_of`` is a function. Rows after it are kept in
  the store's ``pending`` folder, and later micro-batches (or
  :func:`stage_pending`, when no file arrives) take them up, so none is lost
  with the file that brought it;
* late rows (at or before a point's ``max(ts) + buffer``) are dropped as in the
  batch form -- this is a per-point high-water mark, not an event-time
  watermark, so no ``withWatermark`` (and no state store) is involved.

``trigger(availableNow=True)`` processes what is there and stops -- the
scheduled-pull shape of the original pipeline.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..functions.temporal import run_end, ts_literal
from ..plans.runner import Stores, run_extract
from ..sources.telemetry import long_source


def start_extract_stream(spark: SparkSession, source_dir: str, schema, stores: Stores,
                         points: DataFrame, as_of: dt.date | Callable[[], dt.date],
                         checkpoint_location: str,
                         point_col: str = "point", ts_col: str = "ts", value_col: str = "value",
                         tiebreak=None, buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                         window_days: int = config.ROLLING_WINDOW_DAYS,
                         max_files_per_trigger: int | None = None,
                         available_now: bool = True) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_dir)

    def stage_batch(batch: DataFrame, batch_id: int) -> None:
        day = as_of() if callable(as_of) else as_of
        run_id = stores.ids.claim(f"stream-{checkpoint_location}", str(batch_id))
        extra = [c for c in batch.columns if c not in (point_col, ts_col, value_col)]
        src = long_source(batch, point_col, ts_col, value_col, tuple(extra if tiebreak is None else tiebreak))
        _stage(spark, src, points, stores, day, run_id, tiebreak, buffer_seconds, window_days)

    writer = (stream.writeStream.foreachBatch(stage_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def _stage(spark: SparkSession, src: DataFrame, points: DataFrame, stores: Stores, as_of: dt.date,
           run_id: int, tiebreak, buffer_seconds: float, window_days: int) -> None:
    held = stores.pending.read(before_run=run_id)
    if held is not None:
        src = src.unionByName(held.select(*src.columns))
    end = ts_literal(run_end(as_of), src.schema["ts"].dataType)
    run_extract(spark, src, points, stores, as_of, run_id, dt.datetime.combine(as_of, dt.time(0, 0)),
                tiebreak, buffer_seconds, window_days, writer="stream")
    # last: until then a run that broke off finds what it found before
    stores.pending.write(src.filter(F.col("ts") >= end), run_id)


def stage_pending(spark: SparkSession, stores: Stores, points: DataFrame, as_of: dt.date, tiebreak=None,
                  buffer_seconds: float = config.TIMESTAMP_BUFFER_SECONDS,
                  window_days: int = config.ROLLING_WINDOW_DAYS) -> int | None:
    """One run over the pending rows whose day has come; its run id, or ``None``
    without any. Its id belongs to the day and the version of the pending rows:
    a call that broke off gets its id again, one that finds other rows a new one."""
    version = stores.pending.version()
    held = stores.pending.read()
    if held is None or held.filter(F.col("ts") < ts_literal(run_end(as_of), held.schema["ts"].dataType)).isEmpty():
        return None
    run_id = stores.ids.claim("pending", f"{as_of.isoformat()}-{version}")
    _stage(spark, held.limit(0), points, stores, as_of, run_id, tiebreak, buffer_seconds, window_days)
    return run_id
