"""Structured Streaming counterparts of the batch operators.

All queries use file sources with an explicit schema, a checkpoint folder
under the shared checkpoint root, and ``trigger(availableNow=True)`` so a run
processes what has arrived and stops; a later run resumes from the
checkpoint (exactly-once file sink / idempotent batch writes).
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidewash.functions.records import epoch_micros, event_time, ntz_from_micros
from tidewash.operators.dedup import exact_dedup
from tidewash.operators.joins import resume_anti_join
from tidewash.session import RECOMMENDED_CONF

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


class _Totals(StreamingQueryListener):
    """Adds up the progress of every micro-batch of every run.

    ``StreamingQuery.recentProgress`` keeps the last hundred batches only."""

    def __init__(self) -> None:
        self.runs: dict[str, dict] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        pr = event.progress
        t = self.runs.setdefault(str(pr.runId), {"batches": 0, "input_rows": 0, "dropped_by_watermark": 0})
        t["batches"] += 1
        t["input_rows"] += int(pr.numInputRows)
        t["dropped_by_watermark"] += sum(int(op.numRowsDroppedByWatermark) for op in pr.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def of(self, run: str) -> dict:
        """The run's totals, once its last event has been seen.  The data are committed by
        then, so this only waits, however far the listener is behind."""
        while not self._end(run).wait(60):
            pass
        return self.runs.get(run, {"batches": 0, "input_rows": 0, "dropped_by_watermark": 0})


def run_available(stream: DataFrame, checkpoint: str, sink_path: str | None = None,
                  fmt: str = "parquet", output_mode: str = "append",
                  foreach_batch: Callable | None = None) -> dict:
    """Process everything available now, then stop (blocking).

    Returns run statistics added up over all micro-batches: their number,
    input rows, and rows dropped as later than the watermark (reported,
    never silent).
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", sink_path)
    spark = stream.sparkSession
    streams, totals = spark.streams, _Totals()
    before = spark.conf.get(_PROVIDER, None)
    streams.addListener(totals)
    try:
        spark.conf.set(_PROVIDER, RECOMMENDED_CONF[_PROVIDER])  # read when the query starts
        q = w.trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        return totals.of(str(q.runId))
    finally:
        streams.removeListener(totals)
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def _with_event_time(stream: DataFrame, ts_col: str) -> DataFrame:
    """Watermarks need an instant; ``timestamp_ntz`` columns are read as UTC."""
    dt = stream.schema[ts_col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return stream.withColumn("_tw_event_time", event_time(ts_col)), "_tw_event_time"
    return stream, ts_col


def dedup_stream(stream: DataFrame, keys: list[str], ts_col: str, delay: str) -> DataFrame:
    """Drop re-delivered rows: a key seen within ``delay`` of event time is
    dropped; state for a key is evicted once the watermark passes it, so the
    state stays bounded by the delay, not by the stream length."""
    s, et = _with_event_time(stream, ts_col)
    out = s.withWatermark(et, delay).dropDuplicatesWithinWatermark(keys)
    return out.drop("_tw_event_time")


def first_delivery_sink(path: str, keys: list[str], order_by) -> Callable:
    """``foreachBatch`` sink that writes the first delivery of each key, however late a key is
    sent again (``dedup_stream`` forgets keys that its watermark has passed).

    A batch keeps one row a key, the first by ``order_by``, less the keys that earlier batches
    wrote.  These are read from the sink, key columns only, and joined; nothing is held as
    state.  Each batch has a folder of its own: a retried batch replaces it and does not look
    at it.  A row with a null key column is never a repeat.  ``read_deliveries`` reads the sink."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"{path}/{_BATCH}={batch_id}"
        done = read_deliveries(spark, path, batch.schema, before=batch_id).select(*keys)
        single = F.when(_all_present(keys), F.to_json(F.struct(*keys)))
        fresh = exact_dedup(resume_anti_join(batch, done, keys).withColumn("_tw_key", single), "_tw_key", order_by)
        fresh.select(*batch.columns).write.mode("overwrite").parquet(target)
    return write


_BATCH = "_tw_batch"


def _all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def read_deliveries(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The rows of a ``first_delivery_sink``; with ``before``, of the batches before that one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder):
        return spark.createDataFrame([], schema)
    d = spark.read.schema(T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])).parquet(path)
    return (d if before is None else d.where(F.col(_BATCH) < before)).drop(_BATCH)


def rate_windows(stream: DataFrame, ts_col: str, failed: Column, width: str = "1 hour",
                 delay: str = "2 hours") -> DataFrame:
    """Success / failure counts per tumbling event-time window.

    In append mode a window is given out once, when the watermark has passed its end, and
    its state is dropped; ``end_mark`` makes the last ones final.  In update mode every
    change is given out (``versioned_upsert``).  Rows without a time are in no window.
    Window bounds come back in the type of ``ts_col``.
    """
    ntz = isinstance(stream.schema[ts_col].dataType, T.TimestampNTZType)
    s, et = _with_event_time(stream, ts_col)
    g = (s.withWatermark(et, delay)
         .groupBy(F.window(et, width).alias("w"))
         .agg(F.count_if(~failed).alias("n_ok"), F.count_if(failed).alias("n_failed")))
    start, end = F.col("w.start"), F.col("w.end")
    if ntz:
        start, end = ntz_from_micros(F.unix_micros(start)), ntz_from_micros(F.unix_micros(end))
    return g.select(start.alias("window_start"), end.alias("window_end"), "n_ok", "n_failed")


def versioned_upsert(path: str) -> Callable:
    """``foreachBatch`` sink for update-mode aggregates: every batch appends
    its changed rows tagged with the batch id; ``read_latest`` keeps the
    newest version per key.  A retried batch rewrites identical rows with
    the same id, so retries are harmless."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(path)
    return write


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    d = spark.read.parquet(path)
    value_cols = [c for c in d.columns if c not in keys and c != "_batch_id"]
    latest = d.groupBy(*keys).agg(
        F.max_by(F.struct(*value_cols), F.col("_batch_id")).alias("_v"))
    return latest.select(*keys, "_v.*")


def _packed(frame) -> bytes:
    import pyarrow as pa

    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes):
    import pyarrow as pa

    with pa.ipc.open_stream(bytes(data)) as stream:
        return stream.read_all().to_pandas()


class _RunAlerts:
    """State of one bucket of keys: rows not yet due (a list), the lengths of the runs that ended
    with the last row released of their keys (those above 0), and the time of the only timer."""

    def __init__(self, names: tuple[str, str, str], threshold: int) -> None:
        self.names, self.threshold = names, threshold

    def init(self, handle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")  # each a frame's or a timer's rest, as an Arrow stream
        self.runs = handle.getListState("runs", "key string, length long")
        self.due = handle.getValueState("due", "ms long")

    def _timer(self, first_us: int) -> None:
        """One timer, at the first millisecond not before the earliest pending row."""
        at = -(-first_us // 1000)
        if self.due.exists():
            old = self.due.get()[0]
            if old <= at:
                return
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.due.update((at,))

    def handleInputRows(self, key, rows, timerValues):
        first = None
        for frame in rows:
            frame = frame.set_axis(["bucket", "time", "key", "us", "id", "failed"], axis=1)
            frame = frame[frame["us"].notna() & frame["id"].notna()]
            if len(frame):
                frame = frame.astype({"us": "int64", "id": "int64", "failed": "bool"})
                self.pending.appendValue((_packed(frame[["key", "us", "id", "failed"]]),))
                low = int(frame["us"].min())
                first = low if first is None else min(first, low)
        if first is not None:
            self._timer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd

        limit = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = pd.concat([_unpacked(row[0]) for row in self.pending.get()], ignore_index=True)
        due = waiting["us"] <= limit
        rest = waiting[~due]
        ready = waiting[due].sort_values(["us", "id", "failed"])
        lengths = {k: n for k, n in self.runs.get()} if self.runs.exists() else {}
        hits = []
        for k, us, row_id, failed in zip(*(ready[c].tolist() for c in ("key", "us", "id", "failed"))):
            if failed:
                length = lengths[k] = lengths.get(k, 0) + 1
                if length == self.threshold:
                    hits.append((k, row_id, us, length))
            else:
                lengths.pop(k, None)
        if lengths:
            self.runs.put(list(lengths.items()))
        else:
            self.runs.clear()
        self.due.clear()
        if len(rest):
            self.pending.put([(_packed(rest),)])
            self._timer(int(rest["us"].min()))
        else:
            self.pending.clear()
        if hits:
            yield pd.DataFrame(hits, columns=[*self.names, "run_len"])

    def close(self) -> None:
        pass


#: Buckets of keys of ``run_alerts``; a checkpoint goes on with the number that it began with.
ALERT_BUCKETS = 1024


def run_alerts(stream: DataFrame, key: str, ts_col: str, id_col: str,
               failed_col: str, threshold: int, delay: str = "6 hours", buckets: int = ALERT_BUCKETS) -> DataFrame:
    """Alert when a key reaches ``threshold`` consecutive failures, in event-time order.

    Rows may arrive in any order, up to ``delay`` behind the latest time seen.  They wait in a
    list state (``transformWithState``) until the watermark has passed them; an event-time
    timer then releases them sorted by (time, id), and the length of each key's
    current run is carried on, across micro-batches and restarts.  Keys share a state by a hash, in
    ``buckets``: a call to the state costs far more than a row, and there is a handful for each
    bucket of a batch, not for each key.  One alert per run, at
    the row where it reaches the threshold, once that row is final.

    A task holds a bucket's rows of the last ``delay`` and of one micro-batch.  Rows later
    than ``delay`` are dropped and counted (``run_available``).  Rows without a time or an
    id have no place in the order: they are left out.  A null ``failed`` is a success.
    Times must lie between the years 1678 and 2261, as they pass through pandas.
    Needs the RocksDB state store (``run_available`` sets it).
    """
    from pyspark.sql.streaming import StatefulProcessor

    s, et = _with_event_time(stream, ts_col)
    ntz = et != ts_col
    kind = stream.schema[key].dataType
    plain = isinstance(kind, T.AtomicType) and not isinstance(kind, T.BinaryType)
    # keys as text, as pandas would read whole numbers with nulls as floating point
    as_text = F.col(key).cast("string") if plain else F.to_json(F.struct(F.col(key).alias("k")))
    marked = s.withWatermark(et, delay).select(
        F.pmod(F.xxhash64(as_text), F.lit(buckets)).cast("int").alias("_tw_bucket"), F.col(et).alias("_tw_event_time"),
        F.coalesce(F.concat(F.lit("="), as_text), F.lit("~")).alias("_tw_key"), (epoch_micros(ts_col) if ntz else F.unix_micros(et)).alias("_tw_us"),
        F.col(id_col).cast("long").alias("_tw_id"), F.coalesce(F.col(failed_col), F.lit(False)).alias("_tw_failed"))
    names = (key, id_col, "_tw_us")
    out_schema = T.StructType([
        T.StructField(key, T.StringType()), T.StructField(id_col, T.LongType()),
        T.StructField("_tw_us", T.LongType()), T.StructField("run_len", T.LongType())])
    processor = type("RunAlerts", (_RunAlerts, StatefulProcessor), {})(names, threshold)
    found = marked.groupBy("_tw_bucket").transformWithStateInPandas(processor, out_schema, "Append", "EventTime")
    at = ntz_from_micros(F.col("_tw_us")) if ntz else F.timestamp_micros("_tw_us")
    text = F.substr(F.col(key), F.lit(2))
    value = text.cast(kind) if plain else F.from_json(text, T.StructType([T.StructField("k", kind)]))["k"]
    return found.select(F.when(F.startswith(F.col(key), F.lit("=")), value).alias(key), id_col, at.alias(ts_col), "run_len")


def end_mark(spark: SparkSession, path: str, schema: T.StructType, ts_col: str, at: str) -> None:
    """Ends a finite stream: writes one row to ``path`` that has nothing but the time ``at``.

    It moves the watermark, so that all windows and waiting rows that are older by more
    than the delay become final.  Rows that arrive afterwards are late."""
    row = spark.range(1).select(*[
        (F.lit(at).cast(f.dataType) if f.name == ts_col else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    row.write.mode("append").parquet(path)


def write_arrivals(df: DataFrame, ts_col: str, path: str, n_slices: int, redeliver: Column | None = None,
                   late_us: Column | None = None) -> list[Callable[[], None]]:
    """Arrival schedule for replaying a table as a stream.

    Splits ``df`` into ``n_slices`` consecutive event-time slices and returns
    one writer per slice; calling writer i appends slice i (plus, when
    ``redeliver`` is given, the rows of slice i-1 matching it again, as an
    at-least-once producer would) to ``path``.  ``late_us`` are microseconds by which a
    row arrives after its time: slices are then cut by arrival.  The slice bounds come from one
    min/max aggregate; rows without a time arrive with the first slice.
    """
    import datetime as _dt

    us = epoch_micros(ts_col) if late_us is None else epoch_micros(ts_col) + late_us
    lo, hi = df.agg(F.min(us), F.max(us)).first()
    if lo is None:  # no rows, or none with a time: all arrive in the first slice
        lo = hi = 0
    width = (hi - lo) // n_slices + 1
    epoch = _dt.datetime(1970, 1, 1)

    def bound(k: int):
        # a timestamp_ntz literal (text, no time zone involved): the range
        # filter below is pushed into the Parquet scan
        t = epoch + _dt.timedelta(microseconds=lo + k * width)
        return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")

    def in_slice(i: int):
        if late_us is None:
            inside = (F.col(ts_col) >= bound(i)) & (F.col(ts_col) < bound(i + 1))
        else:
            inside = (us >= lo + i * width) & (us < lo + (i + 1) * width)
        return inside | F.col(ts_col).isNull() if i == 0 else inside

    def writer(i: int):
        def go():
            part = df.where(in_slice(i))
            if redeliver is not None and i > 0:
                part = part.unionByName(df.where(in_slice(i - 1) & redeliver))
            part.write.mode("append").parquet(path)
        return go

    return [writer(i) for i in range(n_slices)]
