"""Incremental forms: Structured Streaming over landed files, with the batch cleaners on each micro-batch.

A checkpointed file source remembers which files it has read, so a run with trigger(availableNow=True), once or twice a
day, takes up what is new and stops."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import scalars as S
from tidemark.functions.scalars import parse_ts
from tidemark.operators.clean import clean_messages
from tidemark.operators.reports import watermarks
from tidemark.operators.windows import incremental_windows
from tidemark.sources.sinks import is_dealt, read_buckets, upsert


def stream_files(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True).load(path)


def stream_chat(spark: SparkSession, path: str, schema: StructType | str, start: str | None = None, ts_raw: str = "ts_raw") -> DataFrame:
    """Message rows (JSON lines) as a stream, from a point in time on."""
    rows = stream_files(spark, path, schema, "json").withColumn("event_ts", parse_ts(F.col(ts_raw))["ts"])
    return rows if start is None else rows.where(F.col("event_ts") > F.lit(start).cast("timestamp"))


def stream_dedupe(df: DataFrame, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Repeats of a key within the delay are dropped; state is kept for that long. In a batch use clean.dedupe_first."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(df: DataFrame, ts: str, width: str, by: list[str], delay: str = "1 hour") -> DataFrame:
    """Counts by time window and key, of a stream (late rows up to the delay) or a batch."""
    rows = df.withWatermark(ts, delay) if df.isStreaming else df
    found = rows.groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.col("window.start").alias("start"), *by, "n")


def _append_new(spark: SparkSession, rows: DataFrame, path: str, batch_id: int) -> None:
    """A batch goes into its own folder, so that a batch that is run again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


#: Where the ids of a stream are kept between batches: on the disks of executors, with their changes in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _with_new_ids(df: DataFrame) -> DataFrame:
    """The rows of a stream (as `row`) and, in the same batch, the ids that no batch before had (as `new_id`). Ids are kept
    in the state store; those that aren't all digits are no ids."""
    ids = df.where(S.valid(F.col("message_id"), r"^\d+$")).select("message_id").dropDuplicates(["message_id"])
    rows = df.select(F.struct(*df.columns).alias("row"), F.lit(None).cast("string").alias("new_id"))
    return rows.unionByName(ids.select(F.col("message_id").alias("new_id")), allowMissingColumns=True)


def run_silver_stream(df: DataFrame, out: str, quarantine_out: str, checkpoint: str, audit: str | None = None, strict: bool = False) -> None:
    """Clean a stream of normalised messages into two tables, and keep the last time and key seen in `audit`.

    Every id is taken once: ids are kept as keyed state, for good, so a file that lands twice, however late, adds nothing,
    and no batch reads rows of earlier ones. Of the rows of an id the first batch's first (by file and place) counts, as in
    the batch cleaner, whether it is clean or not; rows whose id is no number are quarantined each time they come."""

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            new = batch.where("new_id IS NOT NULL").select("new_id")
            rows = batch.where("row IS NOT NULL").select("row.*")
            sound = S.valid(F.col("message_id"), r"^\d+$")
            fresh = rows.where(sound).join(new, F.col("message_id") == F.col("new_id"), "left_semi")
            clean, bad = clean_messages(fresh.unionByName(rows.where(~sound)), strict)
            _append_new(spark, clean, out, batch_id)
            _append_new(spark, bad, quarantine_out, batch_id)
        finally:
            batch.unpersist()
        if audit is not None:
            marks = watermarks({"messages": (spark.read.parquet(f"{out}/batch={batch_id}"), "ts", "message_id")}).where("last_ts IS NOT NULL")
            if is_dealt(spark, audit):
                both = marks.unionByName(read_buckets(spark, audit)).groupBy("stream").agg(F.max(F.struct("last_ts", "last_key")).alias("m"))
                marks = both.select("stream", "m.last_ts", "m.last_key")
            if not marks.isEmpty():
                upsert(spark, audit, marks, ["stream"], buckets=1)

    name = "spark.sql.streaming.stateStore.providerClass"
    before = df.sparkSession.conf.get(name)
    df.sparkSession.conf.set(name, STATE_STORE)
    try:
        started = _with_new_ids(df).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        df.sparkSession.conf.set(name, before)
    started.awaitTermination()


def run_ledger_stream(spark: SparkSession, path: str, ledger: str, checkpoint: str, stream: str) -> None:
    """Keep a ledger of landed files: (stream, path, sha256 of the content, bytes, modified), a row for each content, so
    a file that lands again under another name is known."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(path)
    rows = files.select(F.lit(stream).alias("stream"), "path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))

    def each(batch: DataFrame, batch_id: int) -> None:
        first = batch.groupBy("stream", "sha256").agg(F.min_by(F.struct("path", "bytes", "modified"), "path").alias("x")).select("stream", "x.path", "sha256", "x.bytes", "x.modified")
        upsert(batch.sparkSession, ledger, first, ["stream", "sha256"], ["modified"])

    rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def unseen_sources(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of sources that no earlier run has archived; for use on a micro-batch."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def touched_tickets(messages: DataFrame, delta: DataFrame) -> DataFrame:
    """Tickets named in messages after the watermark (one row, last_ts): what a scheduled run has to look at again."""
    fresh = messages.join(F.broadcast(delta.where("stream = 'messages'").select("last_ts")), F.lit(True)).where("ts > last_ts")
    return fresh.select(F.explode("mentions_ticket").alias("issue_key")).distinct()


_CHANGES = ("messages", "issues", "events", "pulls")


def run_windows_stream(home: str, checkpoint: str, messages: DataFrame, issues: DataFrame, events: DataFrame, pulls: DataFrame, use_done: bool = True) -> None:
    """The scheduled run: take up what is new in four streams of cleaned records since the last run, and bring the rule
    windows of the tickets that it touches up to date (windows.incremental_windows). A batch that is run again changes
    nothing."""
    streams = dict(zip(_CHANGES, (messages, issues, events, pulls), strict=True))
    packed = [df.select(F.struct(*df.columns).alias(name)) for name, df in streams.items()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), packed)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            incremental_windows(home, *[batch.where(F.col(name).isNotNull()).select(f"{name}.*") for name in _CHANGES], use_done=use_done)
        finally:
            batch.unpersist()

    both.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
