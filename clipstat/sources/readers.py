"""Readers. Every row keeps its place in the input (``seq``), because later ties follow it."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clipstat import schemas
from clipstat.functions import columns as C

CORRUPT = "_corrupt_record"
#: File names that may hold posts, deduplicated or as captured.
POST_FILES = "{*_dedup,*contents*}.jsonl"


def add_ingest_seq(df: DataFrame, by: str = "time") -> DataFrame:
    """Input order as one sortable struct: file (by age or path), block, row.

    Rows of one block are read by one task in file order, so the row id decides inside a block and
    nothing has to be numbered globally.
    """
    file = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    age = [F.col("_metadata.file_modification_time").alias("age")] if by == "time" else []
    place = F.struct(*age, *file, F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias("seq"), F.col("_metadata.file_path").alias("source_file"))


def flat_order(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """``seq`` of ``add_ingest_seq`` as one number in the same order: the block's place among all blocks, then the row.

    The struct holds a path, which every sort and shuffle carries with each row, and is compared by sorting; numbers
    are aggregated in place. Blocks are as many as the tasks that read them. Their list is broadcast.
    """
    place = [f.name for f in rows.schema[seq].dataType.fields if f.name != "row"]
    blocks = rows.select(*[F.col(seq)[n].alias(f"_{n}") for n in place]).distinct()
    blocks = blocks.withColumn("_no", F.row_number().over(Window.orderBy(*[f"_{n}" for n in place])))
    known = [F.col(seq)[n] == F.col(f"_{n}") for n in place]
    joined = rows.join(F.broadcast(blocks), known, "left")
    # The lower 33 bits of Spark's id count the rows of a task, and a block is read by one task.
    number = F.shiftleft(F.col("_no").cast("bigint"), 33).bitwiseOR(F.col(seq)["row"].bitwiseAND(F.lit((1 << 33) - 1)))
    return joined.select(*[number.alias(seq) if c == seq else F.col(c) for c in rows.columns])


def account_of(path: Column, prefix: str) -> Column:
    """The account slug is the folder after ``prefix``."""
    return F.regexp_extract(path, prefix + r"([^/]+)", 1)


def _jsonl(
    spark: SparkSession, path: str | Sequence[str], schema: str, by: str, account: str | None, prefix: str, **options
) -> DataFrame:
    reader = spark.read.schema(f"{schema}, {CORRUPT} string").option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", CORRUPT
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    rows = add_ingest_seq(reader.json(path if isinstance(path, str) else list(path)), by)
    slug = F.lit(account) if account else account_of(F.col("source_file"), prefix)
    return rows.withColumn("account", slug)


def read_posts(spark: SparkSession, path: str | Sequence[str], account: str | None = None) -> DataFrame:
    """Captured posts as JSON lines; torn lines stay visible in the corrupt column."""
    return _jsonl(spark, path, schemas.POSTS_RAW, "time", account, "crawl_")


def read_comments(spark: SparkSession, path: str | Sequence[str], account: str | None = None) -> DataFrame:
    """Captured comments from all matching files below a folder, in path order."""
    return _jsonl(
        spark, path, schemas.COMMENTS_RAW, "path", account, "crawl_",
        recursiveFileLookup="true", pathGlobFilter="*_comments_*.jsonl",
    )


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the count of torn lines per account."""
    # Spark refuses to read the corrupt column alone; a condition that always holds names another one.
    read = F.length(F.concat_ws("", F.col(rows.columns[0]).cast("string"))) >= 0
    bad = rows.filter(F.col(CORRUPT).isNotNull() & read).groupBy("account").agg(
        F.count(F.lit(1)).alias("corrupt_lines_skipped")
    )
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def prefer_source(spark: SparkSession, root: str) -> list[str]:
    """S3: per account the deduplicated file when there is one, else all its captured post files."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def found(pattern: str) -> list[str]:
        hits = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{pattern}"))
        return [h.getPath().toString() for h in hits or [] if h.isFile()]

    def slug(path: str) -> str:
        return path.split("crawl_", 1)[1].split("/", 1)[0]

    ready = {slug(p): p for p in found("crawl_*/*_dedup.jsonl") if p.endswith(f"/{slug(p)}_dedup.jsonl")}
    raw = [p for p in found("crawl_*/*/jsonl/*contents*.jsonl") if slug(p) not in ready]
    return sorted(ready.values()) + sorted(raw)


def post_files(spark: SparkSession, root: str) -> DataFrame:
    """S3 as a table of account and path: the choice of ``prefer_source``, made from a listing without contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", POST_FILES
    ).load(f"{root}/crawl_*")
    path = F.col("_metadata.file_path")
    ready = F.nullif(F.regexp_extract(path, r"/crawl_([^/]+)/\1_dedup\.jsonl$", 1), F.lit(""))
    captured = F.nullif(F.regexp_extract(path, r"/crawl_([^/]+)/[^/]+/jsonl/[^/]*contents[^/]*\.jsonl$", 1), F.lit(""))
    named = files.select(F.coalesce(ready, captured).alias("account"), path.alias("path"), ready.isNotNull().alias("_ready"))
    named = named.filter(F.col("account").isNotNull())
    best = named.groupBy("account").agg(F.max("_ready").alias("_best"))
    return named.join(best, "account").filter(F.col("_ready") == F.col("_best")).select("account", "path")


def read_preferred_posts(spark: SparkSession, root: str) -> DataFrame:
    """S1 over the files of S3: a join on the file's path, so no list of paths passes the driver's code.

    Spark broadcasts the paths only where they are below its own threshold.
    """
    rows = _jsonl(
        spark, f"{root}/crawl_*", schemas.POSTS_RAW, "time", None, "crawl_",
        recursiveFileLookup="true", pathGlobFilter=POST_FILES,
    )
    chosen = post_files(spark, root).select(F.col("path").alias("source_file"))
    return rows.join(chosen, "source_file", "left_semi").select(*rows.columns)


def _documents(spark: SparkSession, path: str, schema: str, account: str | None, prefix: str) -> DataFrame:
    rows = spark.read.schema(f"{schema}, {CORRUPT} string").option("multiLine", "true").option(
        "columnNameOfCorruptRecord", CORRUPT
    ).option("recursiveFileLookup", "true").json(path)
    rows = add_ingest_seq(rows, "path")
    slug = F.lit(account) if account else account_of(F.col("source_file"), prefix)
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT).withColumn("account", slug)


def read_transcripts(spark: SparkSession, path: str, account: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Transcripts and their timed segments; unreadable files drop out."""
    posts = _documents(spark, path, schemas.TRANSCRIPTS, account, "transcript/")
    segments = posts.select("account", "aweme_id", F.posexplode_outer("segments").alias("seq", "s")).select(
        "account", "aweme_id", "seq", "s.*"
    )
    return posts.drop("segments"), segments.filter("seq is not null")


def read_soundtrack(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """One record per post; Spark skips files whose name starts with an underscore."""
    return _documents(spark, path, schemas.SOUNDTRACK, account, "bgm/")


def read_frames(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """One row per frame, ``idx`` is its place in the list; the post id is the folder name."""
    docs = _documents(spark, path, schemas.FRAMES, account, "video-analysis/")
    post = F.regexp_extract("source_file", r"([^/]+)/[^/]+$", 1)
    return docs.select(
        "account", post.alias("aweme_id"), "completed", "source_type",
        F.coalesce(C.filled("backend"), C.filled("render_backend"), C.filled("scan_backend")).alias("backend"),
        F.posexplode("frames").alias("idx", "f"),
    ).select("account", "aweme_id", "completed", "source_type", "backend", "idx", "f.*")


def read_visual(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """Summaries from a bare list or from a ``videos`` or ``records`` wrapper; rows need an id."""
    docs = _documents(spark, path, schemas.VISUAL, account, "video-analysis/")
    names = [f.name for f in docs.schema["videos"].dataType.elementType.fields]
    bare = F.array(F.struct(*names))
    wrapped = F.coalesce(
        F.when(F.size("videos") > 0, F.col("videos")), F.when(F.size("records") > 0, F.col("records")), bare
    )
    rows = docs.select("account", F.explode(wrapped).alias("v")).select("account", "v.*")
    flat = rows.select(
        "account", F.col("aweme_id").cast("string").alias("aweme_id"), "frames_analyzed", "visual_style",
        F.col("color.temperature").alias("temperature"), F.col("composition.dominant").alias("composition"),
        F.col("scene.dominant_candidate").alias("scene"), F.col("subtitles.frame_ratio").alias("subtitle_ratio"),
        F.col("subtitles.dominant_region").alias("subtitle_region"),
        F.col("product_exposure.candidate_frame_ratio").alias("product_ratio"), "ocr_status",
    )
    return flat.filter(C.filled("aweme_id").isNotNull())


def read_creator_counts(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """S10."""
    return _documents(spark, path, schemas.CREATOR_COUNTS, account, "crawl_")


def read_images(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """Decoded images (BGR bytes) below a folder, one folder per post."""
    rows = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(path)
    origin = F.col("image.origin")
    return rows.select(
        (F.lit(account) if account else account_of(origin, "video-analysis/")).alias("account"),
        F.regexp_extract(origin, r"([^/]+)/[^/]+$", 1).alias("aweme_id"),
        F.regexp_extract(origin, r"([^/]+)$", 1).alias("file"),
        F.col("image.height").alias("height"), F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"),
    )


def list_images(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """S11 without pixels: the image files of each post."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return rows.select(
        (F.lit(account) if account else account_of(F.col("path"), "video-analysis/")).alias("account"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("aweme_id"), name.alias("file"),
    ).filter(F.lower("file").rlike(r"\.(jpg|jpeg|png|webp)$"))


def read_rules(path: str | None, default):
    """Rules from a JSON file; an unreadable file is reported and the default used."""
    if not path:
        return default
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except (OSError, ValueError) as error:
        print(f"[rules] {path} ignored: {error}")
        return default
    return [tuple(kv) for kv in found.items()] if isinstance(found, dict) else [tuple(r) for r in found]


def read_log(spark: SparkSession, path: str, account: str | None = None) -> DataFrame:
    """Crawl log lines for A30."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return rows.select((F.lit(account) if account else account_of(F.col("source_file"), "crawl_")).alias("account"), "value")
