"""Streaming forms of the post, comment and run queries on Spark's own state store.

Posts and comments are streaming aggregates in update mode: the state holds one row per post or per
comment. A sink writes what a batch changed into that batch's folder, so a replayed batch writes the
same folder again, and readers take each key's row of the newest batch.

Posts from files also run without a state (``write_posts``): the latest row and the first place of a post are
those among what its batches hold, so batches are only put together when they are read (``merged_posts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructType

from clipstat import schemas
from clipstat.operators import comments as comment_ops
from clipstat.operators.ingest import require_key
from clipstat.session import settings
from clipstat.sources.readers import account_of

POST = ("account", "aweme_id")
COMMENT = (*POST, "_key")

_STORE = "spark.sql.streaming.stateStore"
#: State stands on an executor's disk with bounded memory, not as objects on its heap; a batch saves its changes only.
STATE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "500",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}


def stream_posts(spark: SparkSession, path: str, account: str | None = None, **options) -> DataFrame:
    """Arriving post records with their place in the input: file age, path and block, then content.

    Without ``account`` it is the folder after ``crawl_``.

    Records of one block have no row number in a stream; the content hash makes their order the same in
    every run.
    """
    reader = spark.readStream.schema(schemas.POSTS_RAW)
    for name, value in options.items():
        reader = reader.option(name, value)
    rows = reader.json(path)
    place = F.struct(
        F.col("_metadata.file_modification_time").alias("age"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), _content_hash(rows).alias("row"),
    )
    slug = F.lit(account) if account else account_of(F.col("_metadata.file_path"), "crawl_")
    return rows.select("*", place.alias("arrival"), slug.alias("account"))


def _content_hash(rows: DataFrame) -> Column:
    """Hash of a record. A column's number stands before its value, because hashes pass over nulls; nested values are hashed as text."""
    parts = []
    for i, field in enumerate(rows.schema.fields):
        nested = isinstance(field.dataType, (ArrayType, StructType))
        parts += [F.lit(i), F.to_json(field.name) if nested else F.col(field.name)]
    return F.xxhash64(*parts)


def _merged(rows: DataFrame, seq: str, others: Sequence[str], first: str) -> DataFrame:
    """Per post the row with the largest ``seq`` and the least ``first``. The place leads the record, so it is held once."""
    kept = rows.groupBy(*POST).agg(F.max(F.struct(seq, *others)).alias("_row"), F.min(first).alias("first_seq"))
    return kept.select(*POST, *[F.col(f"_row.{c}").alias(c) for c in (seq, *others)], "first_seq")


def write_posts(arriving: DataFrame, path: str, checkpoint: str, seq: str = "arrival") -> StreamingQuery:
    """ST1 without a state: start a query that writes each batch's own latest rows and first places to ``path/batch=<n>``.

    Nothing is looked up while a batch is read, so its cost does not grow with the posts that came before. The folders
    hold a row per post and batch it came in, as those of ``write_changes`` do. Records need columns that can be ordered.
    """

    def save(batch: DataFrame, number: int) -> None:
        rows = require_key(batch, "aweme_id")
        others = [c for c in rows.columns if c not in (*POST, seq)]
        _merged(rows, seq, others, seq).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return arriving.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merged_posts(spark: SparkSession, path: str, columns: Sequence[str] | None = None, seq: str = "arrival") -> DataFrame:
    """ST1: latest payload per post at its first position, from the batches of ``write_posts``; ``columns`` of it if given."""
    rows = spark.read.parquet(path)
    apart = (*POST, seq, "first_seq", "batch")
    others = [c for c in rows.columns if c not in apart] if columns is None else [c for c in columns if c not in apart]
    return _merged(rows, seq, others, "first_seq")


def posts_latest(arriving: DataFrame, seq: str = "seq") -> DataFrame:
    """ST1: latest payload per post at its first position."""
    rows = require_key(arriving, "aweme_id")
    merged = rows.groupBy(*POST).agg(F.max_by(F.struct(*rows.columns), F.col(seq)).alias("_row"), F.min(seq).alias("first_seq"))
    return merged.select(*[F.col(f"_row.{c}").alias(c) for c in rows.columns], "first_seq")


def comments_first(arriving: DataFrame, seq: str = "seq") -> DataFrame:
    """ST2: each comment's row with the smallest ``seq``, whatever the order of arrival."""
    rows = _with_key(comment_ops.clean_comments(arriving))
    first = rows.groupBy(*COMMENT).agg(F.min_by(F.struct(*rows.columns), F.col(seq)).alias("_row"))
    return first.select(*[F.col(f"_row.{c}").alias(c) for c in rows.columns])


def write_changes(changes: DataFrame, path: str, checkpoint: str, *, mode: str = "update") -> StreamingQuery:
    """Start a query that writes each batch's changed rows to ``path/batch=<n>`` and ends with the input."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = changes.writeStream.outputMode(mode).foreachBatch(save)
    with settings(changes.sparkSession, STATE):  # A query keeps the settings it was started with.
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """Each key's row as the newest batch that changed it has it."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c != "batch"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), F.col("batch")).alias("_row"))
    return newest.select(*[F.col(f"_row.{c}").alias(c) for c in names])


def top_comments(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """ST2: the best comments of each post so far."""
    return comment_ops.top_comments_per_post(current(spark, path, *COMMENT).drop("_key"), n)


def _with_key(comments: DataFrame) -> DataFrame:
    by_id = F.col("comment_id") != ""
    text = F.sha2(F.to_json(F.struct("content", "nickname")), 256)
    return comments.withColumn(
        "_key", F.when(by_id, F.concat(F.lit("id:"), F.col("comment_id"))).otherwise(F.concat(F.lit("txt:"), text))
    )


def stream_run_metrics(
    events: DataFrame, *, at: str = "updated_at", every: str = "1 hour", late: str = "2 hours"
) -> DataFrame:
    """ST3: stage metrics over tumbling windows; also runs on a static table."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    out = rows.groupBy(F.window(at, every).alias("w"), "stage").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("items").alias("items"),
        F.sum(F.col("duration_sec").cast("decimal(18,3)")).alias("_d"),
        F.count_if(F.col("returncode") != 0).alias("failed"),
    )
    seconds = F.col("_d").cast("double")
    rate = F.when(seconds > 0, F.bround(F.col("items") / seconds, 3)).otherwise(0.0)
    return out.select(
        F.col("w.start").alias("window_start"), "stage", "events", "items", "failed",
        seconds.alias("duration_sec"), rate.alias("throughput"),
    )


def closed_run_metrics(
    events: DataFrame, path: str, checkpoint: str, *, at: str = "updated_at", every: str = "1 hour",
    late: str = "2 hours",
) -> int:
    """ST3 in append mode: every window is written once, when the watermark has passed its end.

    Runs to the end of the input and returns the rows that arrived in this run, counted by ``observe`` as they pass.
    """
    seen = events.observe("arrived", F.count(F.lit(1)).alias("rows"))
    query = write_changes(stream_run_metrics(seen, at=at, every=every, late=late), path, checkpoint, mode="append")
    query.awaitTermination()
    progress = query.recentProgress
    if len(progress) >= int(events.sparkSession.conf.get("spark.sql.streaming.numRecentProgressUpdates")):
        raise RuntimeError("more batches than progress updates kept; raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(p["observedMetrics"]["arrived"]["rows"] for p in progress if "arrived" in p["observedMetrics"])


def late_rows(spark: SparkSession, path: str, checkpoint: str, arrived: int) -> int:
    """Rows that came too late for their window: all that arrived, less those in closed windows and in open ones.

    Open windows are read from the query's own state.
    """
    closed = spark.read.parquet(path).agg(F.sum("events")).first()[0] or 0
    state = spark.read.format("statestore").load(checkpoint)
    # The aggregate's buffers in the order of its functions, their names repeat; the first one counts rows.
    kinds = [f.dataType.simpleString() for f in state.schema["value"].dataType.fields]
    named = F.col("value").cast("struct<" + ", ".join(f"b{i}: {t}" for i, t in enumerate(kinds)) + ">")
    waiting = state.agg(F.sum(named.getField("b0"))).first()[0] or 0
    return arrived - closed - waiting
