"""Structured Streaming jobs over the article topic.

The topic is a directory of JSON-lines files by default; the format is an
argument, so a Kafka topic is a matter of settings (its connector is not
installed here). Files hold at most ROWS_PER_FILE messages, so a bound on the
files of a micro-batch bounds its messages. Each job:

* decodes messages with an explicit schema (PERMISSIVE; malformed lines go to
  a quarantine sink instead of stopping the stream),
* lands rows through Spark's parquet file sink, which counts every file once,
  or through ``foreachBatch`` writes that overwrite the folder of their batch id
  when a batch is replayed; progress is in ``checkpointLocation``,
* runs with ``trigger(availableNow=True)`` (drain and stop) by default, or a
  processing-time trigger for a long-running service, which may stop by itself
  once nothing has come for a while.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.timefmt import instant_to_utc_ntz, ntz_to_instant
from presslens.operators.dedup import latest_by_key
from presslens.schemas import MESSAGE

CORRUPT = "_corrupt"
#: messages in a file of the topic: some 30 MB, which Spark splits over the cores. A micro-batch has a fixed price
#: (offsets, commits, state), so one of a few thousand messages would spend nearly all of its time on that
ROWS_PER_FILE = 100_000
STATE_PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# microsecond timestamps survive the JSON round trip
JSON_OPTS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
             "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
MESSAGE_WITH_CORRUPT = T.StructType(MESSAGE.fields + [T.StructField("seq", T.LongType()),
                                                      T.StructField(CORRUPT, T.StringType())])


def publish(df: DataFrame, path: str, files: int | None = None, corrupt_when=None, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One JSON message per row (UTF-8, NULL fields omitted, so an absent
    published_at key is a valid message). Messages are range-partitioned by time
    so they arrive roughly in order, and files hold at most ``rows_per_file`` of
    them; ``files`` fixes the number of ranges, which otherwise follows the
    session's shuffle partitions. ``corrupt_when`` truncates matching messages
    (used to exercise the quarantine path)."""
    value = F.to_json(F.struct(*df.columns), JSON_OPTS)
    if corrupt_when is not None:
        value = F.when(corrupt_when, F.substring(value, 1, 25)).otherwise(value)
    ranged = df.repartitionByRange(*([files] if files else []), "extracted_at")
    ranged.select(value.alias("value")).write.mode("append").option("maxRecordsPerFile", rows_per_file).text(path)


def read_messages(spark: SparkSession, path: str | None = None, max_files: int | None = None, fmt: str = "text",
                  options: dict[str, str] | None = None) -> DataFrame:
    """Streaming read of a topic, one row per message in the column ``value``.

    ``max_files`` bounds a micro-batch of a directory. Any other source goes by
    its format and options, for instance ``fmt="kafka"`` with
    ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets=earliest`` and
    ``maxOffsetsPerTrigger=500``; the offsets are kept in the query's checkpoint.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(path) if path else reader.load()
    return raw.select(F.col("value").cast("string").alias("value"))


def decode(raw: DataFrame) -> DataFrame:
    """from_json with an explicit schema; rows that are not valid JSON keep the
    raw line in ``_corrupt`` (T10)."""
    parsed = raw.select(F.from_json("value", MESSAGE_WITH_CORRUPT,
                                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_OPTS}).alias("m"),
                        F.col("value"))
    return parsed.select("m.*", "value")


def run(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None,
        output_mode: str = "append", path: str | None = None, available_now: bool = True,
        processing_time: str | None = None, state_partitions: int | None = None,
        state_store: str | None = None, idle_seconds: float | None = None):
    """Start a query, drain what is available and stop (or run on an interval).

    ``idle_seconds`` (T02) stops a query that runs on an interval once something
    came and then nothing more for that long.

    ``state_partitions`` sizes the state store of a stateful query. Spark
    fixes it from ``spark.sql.shuffle.partitions`` when the query first starts
    (and keeps it in the checkpoint), so it is applied only around ``start``.
    ``state_store='rocksdb'`` keeps large keyed state (e.g. URLs inside a
    dedup watermark) off the JVM heap; also applied only around ``start``.
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format("parquet").option("path", path)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    spark = stream.sparkSession
    overrides = {}
    if state_partitions:
        overrides["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store == "rocksdb":
        overrides[STATE_PROVIDER_KEY] = ROCKSDB_PROVIDER
    previous = {k: spark.conf.get(k, None) for k in overrides}
    for k, v in overrides.items():
        spark.conf.set(k, v)
    try:
        q = w.start()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if available_now:
        q.awaitTermination()
    elif idle_seconds is not None:
        stop_when_idle(q, idle_seconds)
    return q


def stop_when_idle(query, idle_seconds: float, poll: float = 0.2) -> None:
    """Wait until ``query`` has read something and then nothing for ``idle_seconds``, and stop it."""
    last_batch, last_news = None, None
    while query.isActive:
        done = [p for p in query.recentProgress if p["numInputRows"] > 0]
        if done and done[-1]["batchId"] != last_batch:
            last_batch, last_news = done[-1]["batchId"], time.monotonic()
        busy = query.status["isDataAvailable"] or query.status["isTriggerActive"] and query.status["message"].startswith("Processing")
        if last_news is not None and not busy and time.monotonic() - last_news > idle_seconds:
            query.stop()
        else:
            query.awaitTermination(poll)
    if error := query.exception():
        raise error


def default_state_partitions(spark: SparkSession) -> int:
    """One state partition per core of the cluster."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def versioned_sink(base: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: each batch goes to ``base/batch=<id>`` with
    overwrite, so a replayed batch id replaces its own output (exactly-once
    effect with at-least-once execution)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch={batch_id:09d}")
    return sink


def read_newest(spark: SparkSession, path: str, key: list[str], order: list[str]) -> DataFrame:
    """Newest row per key (by the order columns, whatever the arrival order) of an append-only sink."""
    return latest_by_key(spark.read.parquet(path), key, order)


def read_updates(spark: SparkSession, base: str, key: list[str]) -> DataFrame:
    """Current value per key of an update-mode aggregate landed by
    ``versioned_sink``: the row of the latest batch that updated the key."""
    return latest_by_key(spark.read.parquet(base), key, ["batch"]).drop("batch")


def quarantine_sink(good_base: str, bad_base: str) -> Callable[[DataFrame, int], None]:
    """Valid messages to one sink, undecodable ones (raw text kept) to a quarantine sink."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        bad = batch.filter(F.col(CORRUPT).isNotNull())
        good = batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "value")
        good.write.mode("overwrite").parquet(f"{good_base}/batch={batch_id:09d}")
        bad.select("value").write.mode("overwrite").parquet(f"{bad_base}/batch={batch_id:09d}")
        batch.unpersist()
    return sink


def with_event_time(df: DataFrame, col: str = "extracted_at", delay: str = "1 hour") -> DataFrame:
    """Watermarks need TIMESTAMP (not NTZ): the UTC wall clock becomes an
    instant ``_et`` (session-zone independent); outputs convert back."""
    return df.withColumn("_et", ntz_to_instant(F.col(col))).withWatermark("_et", delay)


def counting_sink(inner: Callable[[DataFrame, int], None], progress_base: str,
                  key: str = "country_target") -> Callable[[DataFrame, int], None]:
    """Wrap a foreachBatch sink so every micro-batch also records its
    message counts per ``key`` (null: '?') and the seconds that it took to load
    (idempotent per batch id, like the data)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            started = time.monotonic()
            inner(batch, batch_id)
            counts = batch.groupBy(F.coalesce(key, F.lit("?")).alias(key)).agg(F.count(F.lit(1)).alias("messages"))
            seconds = F.lit(time.monotonic() - started)
            counts.select("*", F.lit(batch_id).cast("long").alias("batch_id"), seconds.alias("load_seconds")).write.mode(
                "overwrite").parquet(f"{progress_base}/batch={batch_id:09d}")
        finally:
            batch.unpersist()
    return sink


def second_counts_sink(base: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """Each batch lands its own counts per ``keys`` and second. Counts of
    batches add up whatever the order of messages, so no state is kept, and a
    replayed batch overwrites its own."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        timed = batch.withColumn("_et", ntz_to_instant(F.col("extracted_at")))
        counts = timed.groupBy(*keys, F.window("_et", "1 second").alias("w")).agg(
            F.count(F.lit(1)).alias("n"), F.max("extracted_at").alias("latest"))
        counts.select(*keys, instant_to_utc_ntz(F.col("w.start")).alias("sec"), "n", "latest").write.mode("overwrite").parquet(
            f"{base}/batch={batch_id:09d}")
    return sink


def read_second_counts(spark: SparkSession, base: str, keys: list[str]) -> DataFrame:
    """``keys``, sec, n, latest over all batches."""
    return spark.read.parquet(base).groupBy(*keys, "sec").agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))


def progress(counters: DataFrame, key: str = "country_target") -> DataFrame:
    """``key``, messages, total of all keys, and rate (messages per second of loading) over the recorded batches."""
    batches = counters.groupBy("batch_id").agg(F.sum("messages").alias("n"), F.max("load_seconds").alias("s"))
    total = batches.agg(F.sum("n")).scalar()
    rate = batches.agg(F.sum("n") / F.greatest(F.sum("s"), F.lit(1e-3))).scalar()
    return counters.groupBy(key).agg(F.sum("messages").alias("messages")).withColumn("total", total).withColumn("rate", rate)


class ProgressRecorder:
    """Collects per-batch progress (rows, rows/s) of the queries of a session
    through a StreamingQueryListener; one small record per micro-batch."""

    def __init__(self, spark: SparkSession):
        from pyspark.sql.streaming import StreamingQueryListener

        records = self.records = []

        class _Listener(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                records.append({"id": str(p.id), "batch_id": p.batchId, "rows": p.numInputRows,
                                "rows_per_second": p.processedRowsPerSecond})

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self._listener = _Listener()
        self._spark = spark
        spark.streams.addListener(self._listener)

    def close(self) -> None:
        self._spark.streams.removeListener(self._listener)
