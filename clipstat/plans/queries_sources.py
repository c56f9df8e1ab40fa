"""Readers of files and streams of files, over JSON that Spark writes from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.operators import comments as co
from clipstat.plans.queries_posts import KEPT_SQL, staged
from clipstat.plans.registry import query
from clipstat.session import stage
from clipstat.sources import readers, sinks
from clipstat.streaming import streams

#: Bytes of captured files a batch of a stream reads.
BATCH = str(1 << 30)
#: Ids that share a file: their documents are one JSON list.
IDS_PER_FILE = 4000


def written(v, rows: DataFrame, folder: str, wrap=lambda listed: listed) -> str:
    """Documents of ``rows(account, aweme_id, ...)`` in files below a folder per account, torn ones among them.

    ``wrap`` makes a file's content from the list of documents. A file of every account is cut off in the middle.
    """
    path = f"{staged(v, folder)}/{folder}"
    fields = [c for c in rows.columns if c != "account"]
    rows = stage(rows, "documents")
    # As many files as the account's documents fill; ranges of ids would leave most files nearly empty.
    sizes = rows.groupBy("account").agg(F.ceil(F.count("*") / IDS_PER_FILE).alias("parts"))
    part = F.expr("pmod(xxhash64(aweme_id), parts)").alias("part")
    files = rows.join(sizes, "account").groupBy("account", part).agg(F.collect_list(F.struct(*fields)).alias("listed"))
    files = files.select("account", "part", F.to_json(wrap(F.col("listed"))).alias("value"))
    torn = F.when(F.col("part") == 0, F.array("value", F.expr("substr(value, 1, 40)"))).otherwise(F.array("value"))
    files.select("account", F.explode(torn).alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("account").text(path)
    return path


def plain_account(rows: DataFrame) -> DataFrame:
    """The writer names folders ``account=a0``."""
    return rows.withColumn("account", F.regexp_replace("account", "^account=", ""))


@query("S6_read_transcripts", """
SELECT account, aweme_id, CAST(row_number() OVER (PARTITION BY account, aweme_id ORDER BY seq) - 1 AS INTEGER) AS place,
  start, "end", text, confidence, probability, language_probability, avg_logprob FROM segments""")
def _(v):
    told = ("start", "end", "text", "confidence", "probability", "language_probability", "avg_logprob")
    listed = v("segments").groupBy("account", "aweme_id").agg(F.sort_array(F.collect_list(F.struct("seq", F.struct(*told).alias("s")))).alias("l"))
    docs = listed.select("account", "aweme_id", F.lit("zh").alias("language"), F.transform("l", lambda x: x["s"]).alias("segments"))
    _, segments = readers.read_transcripts(v.spark, written(v, docs, "transcript"))
    return plain_account(segments).select("account", "aweme_id", F.col("seq").alias("place"), *told)


@query("S6_transcript_posts", "SELECT account, aweme_id, language, duration, transcript AS text FROM transcripts")
def _(v):
    docs = v("transcripts").select("account", "aweme_id", "language", "duration", F.col("transcript").alias("text"))
    posts, _ = readers.read_transcripts(v.spark, written(v, docs, "transcript"))
    return plain_account(posts).select("account", "aweme_id", "language", "duration", "text")


@query("S7_read_soundtrack", """
SELECT account, aweme_id, cache_version, source_kind, analysis_scope, analysis_status, source_status, bgm_level, mood, vocal,
  non_speech_seconds, non_speech_coverage, duration AS duration_seconds FROM soundtrack""")
def _(v):
    docs = v("soundtrack").withColumnRenamed("duration", "duration_seconds")
    found = plain_account(readers.read_soundtrack(v.spark, written(v, docs, "bgm")))
    return found.select(
        "account", "aweme_id", "cache_version", "source_kind", "analysis_scope", "analysis_status", "source_status", "bgm_level", "mood",
        "vocal", "non_speech_seconds", "non_speech_coverage", "duration_seconds",
    )


def summaries(v) -> DataFrame:
    """Visual summaries as they are captured: nested, some without an id."""
    return v("posts").select(
        "account", "aweme_id", (F.col("likes") % 10).cast("int").alias("frames_analyzed"),
        F.when(F.col("likes") % 2 == 0, "bright").otherwise("dark").alias("visual_style"),
        F.struct(F.when(F.col("shares") > 0, "warm").alias("temperature")).alias("color"),
        F.struct(F.lit("left").alias("dominant")).alias("composition"),
        F.struct(F.when(F.col("likes") % 3 == 0, "indoor").alias("dominant_candidate")).alias("scene"),
        F.struct((F.col("comments") / 10).alias("frame_ratio"), F.lit("bottom").alias("dominant_region")).alias("subtitles"),
        F.struct((F.col("collects") / 100).alias("candidate_frame_ratio")).alias("product_exposure"),
        F.lit("ok").alias("ocr_status"),
    )


VISUAL_SQL = """
SELECT account, aweme_id, CAST(likes % 10 AS INTEGER) AS frames_analyzed, CASE WHEN likes % 2 = 0 THEN 'bright' ELSE 'dark' END AS visual_style,
  CASE WHEN shares > 0 THEN 'warm' END AS temperature, 'left' AS composition, CASE WHEN likes % 3 = 0 THEN 'indoor' END AS scene,
  comments / 10 AS subtitle_ratio, 'bottom' AS subtitle_region, collects / 100 AS product_ratio, 'ok' AS ocr_status FROM posts"""


def _wrapped(name: str):
    def wrap(listed: Column) -> Column:
        return F.struct(listed.alias(name))

    return wrap


for _name, _wrap in (("videos", _wrapped("videos")), ("records", _wrapped("records")), ("list", lambda listed: listed)):

    @query(f"S9_read_visual_{_name}", VISUAL_SQL)
    def _(v, wrap=_wrap):
        return plain_account(readers.read_visual(v.spark, written(v, summaries(v), "video-analysis", wrap)))


@query("S10_read_creator_counts", "SELECT * FROM creator_counts")
def _(v):
    counts = v("creator_counts")
    path = f"{staged(v, 'counts')}/counts"
    text = counts.select(F.concat(F.lit("crawl_"), "account").alias("home"), F.to_json(F.struct(*[c for c in counts.columns if c != "account"])).alias("value"))
    text.write.partitionBy("home").text(path)
    return readers.read_creator_counts(v.spark, path).select(*counts.columns)


def laid_out(v, rows: DataFrame, root: str, name: str) -> None:
    """Files of ``rows(account, value)`` below ``root/crawl_<account>`` under ``name(account, number)``."""
    path = staged(v, "text")
    rows.write.partitionBy("account").text(path)
    hadoop = v.spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(v.spark.sparkContext._jsc.hadoopConfiguration())
    made = set()
    for number, found in enumerate(fs.globStatus(hadoop.Path(f"{path}/account=*/part-*"))):
        account = found.getPath().getParent().getName().split("=", 1)[1]
        target = f"{root}/crawl_{account}/{name(account, number)}"
        folder = target.rsplit("/", 1)[0]
        if folder not in made:
            fs.mkdirs(hadoop.Path(folder))
            made.add(folder)
        fs.rename(found.getPath(), hadoop.Path(target))


def as_json(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select("account", F.to_json(F.struct(*names)).alias("value"))


#: Accounts whose captured files were deduplicated before.
READY_SQL = "CAST(substr(account, 2) AS INTEGER) % 2 = 1"


@query("S3_prefer_source", f"""
SELECT account, aweme_id, liked_count, nickname FROM posts_raw WHERE NOT {READY_SQL} UNION ALL
SELECT account, aweme_id, liked_count, nickname FROM (SELECT *, row_number() OVER (PARTITION BY account, aweme_id ORDER BY seq DESC) AS i FROM posts_raw WHERE {READY_SQL}) WHERE i = 1""")
def _(v):
    """Captured files of all accounts, deduplicated ones of some; each account is read from its better source."""
    root, names = staged(v, "captured"), ("aweme_id", "liked_count", "nickname")
    raw = v("posts_raw").select("account", "seq", *names)
    laid_out(v, as_json(raw, *names), root, lambda account, n: f"r1/jsonl/search_contents_{n}.jsonl")
    ready = raw.filter(READY_SQL).groupBy("account", "aweme_id").agg(F.max_by(F.struct("liked_count", "nickname"), "seq").alias("r"))
    one_file = as_json(ready.select("account", "aweme_id", "r.*"), *names).repartition("account")
    laid_out(v, one_file, root, lambda account, n: f"{account}_dedup.jsonl")
    return readers.read_preferred_posts(v.spark, root).select("account", *names)


#: Every 50th comment is followed by a line that was cut off.
TORN = "seq % 50 = 0"


def captured_comments(v) -> str:
    root, names = staged(v, "captured"), ("aweme_id", "comment_id", "content", "nickname", "like_count", "create_time")
    rows = v("comments_raw").orderBy("seq")
    whole = F.to_json(F.struct(*names))
    lines = F.when(F.expr(TORN), F.concat(whole, F.lit("\n"), F.substring(whole, 1, 20))).otherwise(whole)
    laid_out(v, rows.select("account", lines.alias("value")), root, lambda account, n: f"r1/jsonl/detail_comments_{n:05d}.jsonl")
    return root


@query("S2_read_comments_torn", f"""
SELECT account, count(*) AS n, CAST(sum(length(content)) AS BIGINT) AS chars, count(*) FILTER ({TORN}) AS torn FROM comments_raw GROUP BY account""")
def _(v):
    """The reader over files named as captured, torn lines among them."""
    rows = readers.read_comments(v.spark, captured_comments(v))
    torn = F.col(readers.CORRUPT).isNotNull()
    return rows.groupBy("account").agg(
        F.count_if(~torn).alias("n"), F.sum(F.when(~torn, F.char_length("content"))).alias("chars"), F.count_if(torn).alias("torn"))


@query("K2_write_comments", f"""
WITH {KEPT_SQL}, u AS (SELECT account, count(*) AS total_comments, count(DISTINCT aweme_id) AS total_videos_with_comments FROM unique_comments GROUP BY 1),
t AS (SELECT account, count(*) AS corrupt_lines_skipped FROM comments_raw WHERE {TORN} GROUP BY 1),
k AS (SELECT account, CAST(sum(like_count) AS BIGINT) AS kept_likes, count(*) AS kept FROM kept WHERE pos <= 3 GROUP BY 1)
SELECT k.account, total_comments, total_videos_with_comments, coalesce(corrupt_lines_skipped, 0) AS corrupt_lines_skipped, kept, kept_likes
FROM k JOIN u ON u.account = k.account LEFT JOIN t ON t.account = k.account""")
def _(v):
    """Both tables of the sink, from files with torn lines to what is read back."""
    # The files are parsed once and the comments compared once, for the torn lines and both tables.
    found = stage(readers.read_comments(v.spark, captured_comments(v)).drop("source_file"), "read")
    good, torn = readers.split_corrupt(readers.flat_order(found))
    unique, path = stage(co.dedup_comments(co.clean_comments(good)), "unique"), staged(v, "comments")
    sinks.write_comments(co.top_comments_per_post(unique, 3), unique, path, 3, torn)
    nested = v.spark.read.parquet(f"{path}/by_post").select("account", F.explode("comments").alias("c"))
    kept = nested.groupBy("account").agg(F.count("*").alias("kept"), F.sum("c.like_count").alias("kept_likes"))
    return v.spark.read.parquet(f"{path}/summary").join(kept, "account")


@query("ST1_stream_posts_files", """
WITH r AS (SELECT account, aweme_id, liked_count, nickname, seq % 3 AS part, row_number() OVER (PARTITION BY account, aweme_id, seq % 3 ORDER BY seq DESC) AS i
  FROM posts_raw WHERE aweme_id <> '')
SELECT account, aweme_id, arg_max(liked_count, CASE part WHEN 1 THEN 3 ELSE part END) AS liked_count,
  arg_max(nickname, CASE part WHEN 1 THEN 3 ELSE part END) AS nickname, CAST(min(part) AS BIGINT) AS first_part FROM r WHERE i = 1 GROUP BY 1, 2""")
def _(v):
    """Captured files of parts 0, 1 and 2; the stream stops after part 0, then part 1 is captured once more.

    The newest files come first in the second run, so older ones are late and must change nothing but first places.
    """
    root, out, checkpoint = staged(v, "arrive"), staged(v, "latest"), staged(v, "stream")
    names = ("liked_count", "nickname")
    raw = v("posts_raw").withColumn("part", F.col("seq") % 3)
    rows = raw.groupBy("account", "aweme_id", "part").agg(F.max_by(F.struct(*names), "seq").alias("r"))
    value = F.to_json(F.struct("aweme_id", "r.*", "part")).alias("value")
    rows = stage(rows.select("part", F.concat(F.lit("crawl_"), "account").alias("home"), value), "captured")

    def capture(part: int, folder: int) -> None:
        rows.filter(F.col("part") == part).drop("part").hint("rebalance", "home").write.partitionBy("home").text(f"{root}/part={folder}")

    def follow() -> None:
        arriving = streams.stream_posts(v.spark, root, recursiveFileLookup="true", latestFirst="true", maxBytesPerTrigger=BATCH)
        streams.write_posts(arriving, out, checkpoint).awaitTermination()

    capture(0, 0)
    follow()
    capture(1, 1)
    capture(2, 2)
    capture(1, 3)
    follow()
    found = streams.merged_posts(v.spark, out, names)
    first = F.regexp_extract("first_seq.file", r"/part=(\d)/", 1).cast("bigint")
    return found.select(*streams.POST, *names, first.alias("first_part"))


#: Events arrive in three parts, by id and not by time; the second and third hold events whose windows are closed by then.
LATE_SQL = """
e AS (SELECT stage, items, returncode, updated_at, date_trunc('hour', updated_at) AS window_start,
  CASE WHEN seq % 10 = 0 THEN 3 WHEN updated_at < (SELECT min(updated_at) + (max(updated_at) - min(updated_at)) / 2 FROM stage_events) THEN 1 ELSE 2 END AS part FROM stage_events),
wm AS (SELECT part, max(max(updated_at)) OVER (ORDER BY part) - INTERVAL 2 HOUR AS mark FROM e GROUP BY part),
judged AS (SELECT e.*, coalesce(window_start + INTERVAL 1 HOUR > b.mark, true) AS in_time FROM e LEFT JOIN wm b ON b.part = e.part - 1)"""


def late_run(v) -> tuple[str, int]:
    """The closed windows' folder and the late rows, after three runs of one stream."""
    path, out, checkpoint = staged(v, "events"), staged(v, "closed"), staged(v, "stream")
    rows = v("stage_events").withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    ends = rows.agg(F.unix_micros(F.min("updated_at")).alias("a"), F.unix_micros(F.max("updated_at")).alias("b")).first()
    early = F.unix_micros("updated_at") < ends["a"] + (ends["b"] - ends["a"]) / 2
    part = F.when(F.col("seq") % 10 == 0, 3).when(early, 1).otherwise(2)
    arrived = 0
    for k in (1, 2, 3):
        rows.filter(part == k).drop("seq").write.mode("append").parquet(path)
        arriving = v.spark.readStream.schema(rows.drop("seq").schema).parquet(path)
        arrived += streams.closed_run_metrics(arriving, out, checkpoint)
    return out, streams.late_rows(v.spark, out, checkpoint, arrived)


@query("ST3_stream_run_metrics_closed", f"""
WITH {LATE_SQL} SELECT window_start, stage, count(*) AS events, CAST(sum(items) AS BIGINT) AS items, count(*) FILTER (returncode <> 0) AS failed,
  (SELECT count(*) FROM judged WHERE NOT in_time) AS late_rows FROM judged
WHERE in_time AND window_start + INTERVAL 1 HOUR <= (SELECT max(mark) FROM wm) GROUP BY 1, 2""")
def _(v):
    """Windows closed by the watermark, each written once, with the count of the rows that came too late."""
    out, late = late_run(v)
    found = v.spark.read.parquet(out)
    return found.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "stage", "events", "items", "failed",
        F.lit(late).cast("bigint").alias("late_rows"))
