"""Files in, tables, files out."""

import time
import json
import struct
import zlib

from pyspark.sql import functions as F

from clipstat.operators import comments, ingest
from clipstat.plans import rules
from clipstat.sources import readers, sinks
from clipstat.streaming import streams


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines), encoding="utf-8")


def test_posts_with_torn_and_blank_lines(spark, tmp_path):
    write(tmp_path / "crawl_acc/x/jsonl/1_contents.jsonl", {"aweme_id": "1", "statistics": {"digg_count": 5}, "liked_count": "1"}, "", '{"aweme_id": "2", "li', {"aweme_id": "3", "liked_count": 4})
    good, bad = readers.split_corrupt(readers.read_posts(spark, str(tmp_path / "crawl_acc/x/jsonl/1_contents.jsonl")).cache())
    assert bad.collect() == [("acc", 1)] or [tuple(r) for r in bad.collect()] == [("acc", 1)]
    out = ingest.normalize_counts(ingest.flatten_post(good)).orderBy("seq")
    assert [(r["aweme_id"], r["likes"]) for r in out.collect()] == [("1", 5), ("3", 4)]


def test_dedup_file_is_preferred(spark, tmp_path):
    write(tmp_path / "crawl_a/x/jsonl/1_contents.jsonl", {"aweme_id": "1"})
    write(tmp_path / "crawl_a/a_dedup.jsonl", {"aweme_id": "2"})
    write(tmp_path / "crawl_b/x/jsonl/1_contents.jsonl", {"aweme_id": "3"})
    write(tmp_path / "crawl_b/x/jsonl/1_comments.jsonl", {"aweme_id": "4"})
    found = [p.split(str(tmp_path))[1] for p in readers.prefer_source(spark, str(tmp_path))]
    assert found == ["/crawl_a/a_dedup.jsonl", "/crawl_b/x/jsonl/1_contents.jsonl"]
    assert {tuple(r) for r in readers.read_posts(spark, readers.prefer_source(spark, str(tmp_path))).select("account", "aweme_id").collect()} == {("a", "2"), ("b", "3")}


def test_comment_files_below_a_folder(spark, tmp_path):
    write(tmp_path / "crawl_a/d/creator_comments_1.jsonl", {"aweme_id": "1", "comment_id": "c", "content": "x", "like_count": 1}, "{torn")
    write(tmp_path / "crawl_a/e/f/creator_comments_2.jsonl", {"aweme_id": "1", "comment_id": "c", "content": "y", "like_count": 9})
    write(tmp_path / "crawl_a/e/contents.jsonl", {"aweme_id": "1", "content": "no"})
    good, bad = readers.split_corrupt(readers.read_comments(spark, str(tmp_path)).cache())
    assert [tuple(r) for r in bad.collect()] == [("a", 1)]
    kept = comments.build_comments(good)
    assert [(r["content"], r["like_count"]) for r in kept.collect()] == [("x", 1)]


def test_documents(spark, tmp_path):
    write(tmp_path / "transcript/a/1.json", {"aweme_id": "1", "duration": 4.5, "segments": [{"start": 0, "end": 1, "text": " hi "}, {"start": 1, "end": 2, "text": "you"}]})
    write(tmp_path / "transcript/a/2.json", {"aweme_id": "2"})
    write(tmp_path / "transcript/a/3.json", "{broken")
    posts, segments = readers.read_transcripts(spark, str(tmp_path / "transcript"))
    assert {r["aweme_id"] for r in posts.collect()} == {"1", "2"} and segments.count() == 2
    write(tmp_path / "bgm/a/1.json", {"aweme_id": "1", "bgm_level": "none"})
    write(tmp_path / "bgm/a/_cross.json", {"aweme_id": "9"})
    assert [r["aweme_id"] for r in readers.read_soundtrack(spark, str(tmp_path / "bgm")).collect()] == ["1"]
    write(tmp_path / "video-analysis/a/frames/7/frames.json", {"completed": True, "render_backend": "cpu", "frames": [{"file": "1.jpg", "timestamp": 0.0}, {"file": "2.jpg", "timestamp": None}]})
    frames = readers.read_frames(spark, str(tmp_path / "video-analysis"))
    assert [(r["account"], r["aweme_id"], r["idx"], r["backend"]) for r in frames.orderBy("idx").collect()] == [("a", "7", 0, "cpu"), ("a", "7", 1, "cpu")]
    write(tmp_path / "counts/crawl_a/creator_profile.json", {"aweme_count": 5})
    assert readers.read_creator_counts(spark, str(tmp_path / "counts")).first()["aweme_count"] == 5


def test_visual_wrappers(spark, tmp_path):
    row = {"aweme_id": "1", "visual_style": "low_key", "color": {"temperature": "warm"}}
    write(tmp_path / "l/v.json", json.dumps([row, {"visual_style": "x"}]))
    write(tmp_path / "v/v.json", {"videos": [row, {**row, "aweme_id": ""}]})
    write(tmp_path / "r/v.json", {"videos": [], "records": [{**row, "aweme_id": 5}]})
    for folder, ids in (("l", ["1"]), ("v", ["1"]), ("r", ["5"])):
        out = readers.read_visual(spark, str(tmp_path / folder), "a").collect()
        assert [(r["aweme_id"], r["temperature"]) for r in out] == [(i, "warm") for i in ids]


def png(path, width, height, rgb):
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    line = b"\x00" + bytes(rgb) * width
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(line * height)) + chunk(b"IEND", b""))


def test_images(spark, tmp_path):
    from clipstat.operators.frames import image_features, visual_labels

    png(tmp_path / "video-analysis/a/frames/7/0001.png", 8, 6, (250, 10, 10))
    (tmp_path / "video-analysis/a/frames/7/note.txt").write_text("x")
    files = readers.list_images(spark, str(tmp_path / "video-analysis"))
    assert [tuple(r) for r in files.collect()] == [("a", "7", "0001.png")]
    pictures = readers.read_images(spark, str(tmp_path / "video-analysis"))
    out = visual_labels(image_features(pictures, keep=("account", "aweme_id", "file"))).first()
    assert (out["mean_v"], out["mean_h"], out["temperature"], out["visual_style"]) == (250.0, 0.0, "warm", "high_key_vivid")


def test_rules_file(tmp_path):
    write(tmp_path / "good.json", {"wrong": "right"})
    write(tmp_path / "bad.json", "{")
    assert readers.read_rules(str(tmp_path / "good.json"), ()) == [("wrong", "right")]
    assert readers.read_rules(str(tmp_path / "bad.json"), rules.COMMENT_PATTERNS) == rules.COMMENT_PATTERNS
    assert readers.read_rules(None, 3) == 3


def test_rerun_replaces_only_its_accounts(spark, tmp_path):
    path = str(tmp_path / "posts")
    sinks.write_posts(spark.createDataFrame([("a", "1"), ("b", "2")], "account string, aweme_id string"), path)
    sinks.write_posts(spark.createDataFrame([("b", "3")], "account string, aweme_id string"), path)
    assert {tuple(r) for r in spark.read.parquet(path).select("account", "aweme_id").collect()} == {("a", "1"), ("b", "3")}


def arrive(spark, tmp_path, make, batches, schema):
    """Each batch as a file of its own, in order, through a streaming query; started twice."""
    files = tmp_path / "in"
    for data in batches:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(files))
        time.sleep(1.1)  # a later file is a later batch
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(files))
        streams.write_changes(make(live), out, state).awaitTermination()
    return out


def test_comments_keep_the_first_capture_in_any_order_of_arrival(spark, tmp_path):
    schema = "account string, aweme_id string, comment_id string, content string, nickname string, like_count string, create_time bigint, seq int"
    late = [("a", "1", c, f"t{c}", "n", str(likes), 0, seq) for c, likes, seq in (("z", 99, 4), ("w", 7, 5))]
    early = [("a", "1", c, f"t{c}", "n", str(likes), 0, seq) for c, likes, seq in (("x", 9, 1), ("y", 5, 2), ("z", 1, 3))]
    out = arrive(spark, tmp_path, streams.comments_first, [late, early], schema)
    top = streams.top_comments(spark, out, 2).collect()
    assert [(r["comment_id"], r["pos"]) for r in sorted(top, key=lambda r: r["pos"])] == [("x", 1), ("w", 2)]
    # A replayed batch writes the same folder again.
    first = spark.read.parquet(f"{out}/batch=0").collect()
    spark.createDataFrame(first).write.mode("overwrite").parquet(f"{out}/batch=0")
    assert sorted(r["comment_id"] for r in streams.top_comments(spark, out, 2).collect()) == ["w", "x"]


def test_posts_keep_the_latest_payload_at_the_first_place(spark, tmp_path):
    schema = "account string, aweme_id string, seq int, desc string"
    batches = [[("a", "1", 5, "new"), ("a", "2", 6, "x")], [("a", "1", 2, "old"), ("a", "", 9, "no")], [("a", "1", 8, "newest")]]
    out = arrive(spark, tmp_path, streams.posts_latest, batches, schema)
    got = streams.current(spark, out, *streams.POST).orderBy("aweme_id").collect()
    assert [(r["aweme_id"], r["desc"], r["first_seq"]) for r in got] == [("1", "newest", 2), ("2", "x", 6)]


def test_arriving_posts_carry_a_place(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"aweme_id": "1", "title": "a"}\n{"aweme_id": "1", "title": "b"}\n')
    live = streams.stream_posts(spark, str(tmp_path), "acc")
    query = live.select("account", "aweme_id", "arrival").writeStream.format("memory").queryName("places").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    rows = spark.table("places").collect()
    assert len({r["arrival"] for r in rows}) == 2 and {r["account"] for r in rows} == {"acc"}


def test_window_metrics_of_a_stream(spark, tmp_path):
    rows = spark.range(20).select(
        F.timestamp_seconds(F.col("id") * 600).alias("updated_at"), F.lit("s").alias("stage"), F.col("id").alias("items"),
        F.lit(1.5).alias("duration_sec"), F.lit(0).alias("returncode"))
    rows.repartition(1).write.parquet(str(tmp_path / "events"))
    live = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "events"))
    query = (
        streams.stream_run_metrics(live).writeStream.format("memory").queryName("run_metrics").outputMode("update")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {(r["window_start"], r["items"], r["throughput"]) for r in spark.table("run_metrics").collect()}
    assert got == {(r["window_start"], r["items"], r["throughput"]) for r in streams.stream_run_metrics(rows).collect()}


def test_preferred_files_by_a_join_equal_the_listed_ones(spark, tmp_path):
    for name in ("crawl_a/a_dedup.jsonl", "crawl_a/r1/jsonl/x_contents_1.jsonl", "crawl_b/r1/jsonl/x_contents_1.jsonl",
                 "crawl_b/r2/jsonl/y_contents_2.jsonl", "crawl_b/r2/jsonl/y_comments_2.jsonl", "crawl_c/a_dedup.jsonl"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps({"aweme_id": name}) + "\n")
    listed = readers.read_posts(spark, readers.prefer_source(spark, str(tmp_path)))
    joined = readers.read_preferred_posts(spark, str(tmp_path))
    names = {(r["account"], r["aweme_id"]) for r in joined.collect()}
    assert names == {(r["account"], r["aweme_id"]) for r in listed.collect()} and len(names) == 3


def test_summary_counts_torn_lines(spark):
    unique = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2")], "account string, aweme_id string")
    torn = spark.createDataFrame([("b", 4)], "account string, corrupt_lines_skipped bigint")
    found = {r["account"]: tuple(r)[1:] for r in comments.comment_summary(unique, torn).collect()}
    assert found == {"a": (3, 2, 0), "b": (0, 0, 4)}


def test_state_of_a_stream_is_on_disk(spark, tmp_path):
    schema = "account string, aweme_id string, seq bigint"
    spark.createDataFrame([("a", "1", 1), ("a", "1", 2)], schema).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    streams.write_changes(streams.posts_latest(live), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    kinds = {f.suffix for f in (tmp_path / "state/state").rglob("*.*") if not f.name.startswith(".")}
    assert kinds & {".changelog", ".zip"} and ".delta" not in kinds
    assert [(r["seq"], r["first_seq"]) for r in streams.current(spark, str(tmp_path / "out"), *streams.POST).collect()] == [(2, 1)]


def test_arrivals_are_not_written_by_one_task_each(spark, tmp_path, monkeypatch):
    """ST1 wrote a third of the posts in one task and read it as one file."""
    from clipstat.plans import queries_report
    from clipstat.plans.registry import QUERIES
    from clipstat.plans.standins import Views

    monkeypatch.setattr(queries_report, "staged", lambda v, name: f"{tmp_path}/{name}")
    QUERIES["ST1_stream_posts_latest"](Views(spark, "/root/testdata/sf0.001"))
    assert len(list((tmp_path / "arrive").glob("part-*.json"))) >= 3 * spark.sparkContext.defaultParallelism


def test_documents_fill_files_whatever_their_ids(spark, tmp_path, monkeypatch):
    """A file held the documents of 4,000 ids, so sparse ids made a file each."""
    from clipstat.plans import queries_sources
    from clipstat.plans.standins import Views

    monkeypatch.setattr(queries_sources, "staged", lambda v, name: str(tmp_path))
    rows = spark.range(200).selectExpr("concat('a', id % 2) account", "cast(id * 4000 as string) aweme_id", "'ok' analysis_status")
    path = queries_sources.written(Views(spark, "/root/testdata/sf0.001"), rows, "bgm")
    assert len(list(tmp_path.rglob("part-*.txt"))) == 4
    found = queries_sources.plain_account(readers.read_soundtrack(spark, path)).select("account", "aweme_id")
    assert sorted(map(tuple, found.collect())) == sorted((f"a{i % 2}", str(i * 4000)) for i in range(200))


def test_captured_posts_are_written_compressed(spark, tmp_path, monkeypatch):
    from clipstat.plans import queries_posts
    from clipstat.plans.registry import QUERIES
    from clipstat.plans.standins import Views

    monkeypatch.setattr(queries_posts, "staged", lambda v, name: f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert QUERIES["S1_read_posts"](Views(spark, "/root/testdata/sf0.001")).agg(F.sum("torn")).first()[0] == 0
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = list((tmp_path / "posts").rglob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)


def test_places_as_one_number_follow_the_input_order(spark, tmp_path):
    for name in ("b", "a"):
        write(tmp_path / f"{name}.jsonl", *[{"n": i, "of": name} for i in range(3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = readers.add_ingest_seq(spark.read.schema("n int, of string").json(str(tmp_path)), "path")
        assert rows.select("seq.file", "seq.block").distinct().count() > 4
        found = [(r["of"], r["n"]) for r in readers.flat_order(rows).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(name, i) for name in ("a", "b") for i in range(3000)]
