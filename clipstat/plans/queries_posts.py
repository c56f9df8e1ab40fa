"""Ingest, comments, ranking and reconciliation over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators import comments as co
from clipstat.operators import incremental as inc
from clipstat.operators import ingest, ranking, reconcile
from clipstat.plans.registry import query
from clipstat.session import settings, shared_folder
from clipstat.sources import readers, sinks

COUNT_SQL = "coalesce(try_cast(trim({0}) AS BIGINT), 0)"
LATEST_SQL = """
SELECT r.*, f.first_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY account, aweme_id ORDER BY seq DESC) AS rn FROM posts_raw WHERE aweme_id <> '') r
JOIN (SELECT account, aweme_id, min(seq) AS first_seq FROM posts_raw GROUP BY 1, 2) f
  ON r.account = f.account AND r.aweme_id = f.aweme_id
WHERE r.rn = 1"""
KEPT_SQL = """
unique_comments AS (
  SELECT account, aweme_id, comment_id, trim(content) AS content, nickname,
    coalesce(try_cast(trim(like_count) AS BIGINT), 0) AS like_count, create_time, seq
  FROM (SELECT *, row_number() OVER (PARTITION BY account, aweme_id,
      CASE WHEN comment_id <> '' THEN concat('id ', comment_id) ELSE concat('txt ', trim(content), '/', nickname) END
      ORDER BY seq) AS rn FROM comments_raw WHERE trim(content) <> '' AND aweme_id <> '') WHERE rn = 1),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY account, aweme_id ORDER BY like_count DESC, seq) AS pos FROM unique_comments)
"""


def staged(v, name: str) -> str:
    return f"{shared_folder(v.spark)}/clipstat-{name}-{uuid.uuid4().hex}"


@query("S1_read_posts", "SELECT account, aweme_id, liked_count, nickname, 0 AS torn FROM posts_raw WHERE aweme_id <> ''")
def _(v):
    path = staged(v, "posts")
    rows = v("posts_raw").withColumn("home", F.concat(F.lit("crawl_"), "account"))
    # Captured text is written compressed, and straight to the accounts' files instead of sorted by them.
    with settings(v.spark, {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
        rows.drop("seq", "account").withColumnRenamed("home", "h").write.partitionBy("h").option("compression", "gzip").option("maxRecordsPerFile", 200_000).json(path)
    found = readers.read_posts(v.spark, path).withColumn("account", readers.account_of(F.col("source_file"), "h=crawl_"))
    kept = ingest.require_key(found, "aweme_id")
    return kept.select("account", "aweme_id", "liked_count", "nickname", F.col("_corrupt_record").isNotNull().cast("int").alias("torn"))


@query("S2_read_comments", """
SELECT account, count(*) AS n, CAST(sum(length(content)) AS BIGINT) AS chars FROM comments_raw GROUP BY account""")
def _(v):
    path = staged(v, "comments")
    rows = v("comments_raw").select(
        "aweme_id", "comment_id", "content", "nickname", "like_count", "create_time", "account")
    rows.write.partitionBy("account").json(path)
    found = v.spark.read.option("recursiveFileLookup", "true").schema(readers.schemas.COMMENTS_RAW).json(path)
    seq = readers.add_ingest_seq(found, "path").withColumn("account", readers.account_of(F.col("source_file"), "account="))
    return seq.groupBy("account").agg(F.count("*").alias("n"), F.sum(F.char_length("content")).alias("chars"))


@query("S4_ingest_order", "SELECT aweme_id, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq FROM posts_raw GROUP BY aweme_id")
def _(v):
    """Order written to files is the order read back: first and last row per post agree with seq."""
    path = staged(v, "ordered")
    v("posts_raw").select("aweme_id", F.col("seq").alias("was")).orderBy("was").write.parquet(path)
    rows = readers.flat_order(readers.add_ingest_seq(v.spark.read.parquet(path), "path"))
    return rows.groupBy("aweme_id").agg(
        F.count("*").alias("n"), F.min_by("was", "seq").alias("first_seq"), F.max_by("was", "seq").alias("last_seq"))


@query("S5_flatten_post", """
SELECT account, aweme_id, seq, CASE WHEN collected_count = '3' THEN liked_count ELSE coalesce(nullif(share_count, ''), liked_count) END AS liked_count
FROM posts_raw""")
def _(v):
    stats = F.when(F.col("collected_count") == "3", None).otherwise(F.struct(F.col("share_count").alias("digg_count")))
    rows = v("posts_raw").withColumn("statistics", stats)
    return ingest.flatten_post(rows).select("account", "aweme_id", "seq", "liked_count")


@query("F1_normalize_counts", f"""
SELECT account, aweme_id, seq, {COUNT_SQL.format('liked_count')} AS likes, {COUNT_SQL.format('comment_count')} AS comments,
  {COUNT_SQL.format('collected_count')} AS collects, {COUNT_SQL.format('share_count')} AS shares,
  coalesce(trim(liked_count) <> '' AND try_cast(trim(liked_count) AS BIGINT) IS NULL, false) AS bad_count
FROM posts_raw""")
def _(v):
    cols = ("account", "aweme_id", "seq", "likes", "comments", "collects", "shares", "bad_count")
    return ingest.normalize_counts(v("posts_raw")).select(*cols)


@query("F2_strict_int", r"""
SELECT account, seq, CASE WHEN regexp_full_match(trim(liked_count), '[+-]?[0-9]+') THEN try_cast(trim(liked_count) AS BIGINT) END AS n
FROM posts_raw""")
def _(v):
    return v("posts_raw").select("account", "seq", C.strict_int("liked_count").alias("n"))


@query("F3_require_key", "SELECT account, aweme_id, seq FROM posts_raw WHERE aweme_id <> ''")
def _(v):
    return ingest.require_key(v("posts_raw"), "aweme_id").select("account", "aweme_id", "seq")


@query("F4_keyword_filter", """
SELECT account, aweme_id, seq FROM posts_raw
WHERE contains(concat(coalesce("desc", ''), '|', coalesce(nickname, ''), '|', coalesce(author_word, '')), '|sup1')""")
def _(v):
    return ingest.keyword_filter(v("posts_raw"), "|sup1").select("account", "aweme_id", "seq")


@query("F5_split_media_type", """
SELECT account, coalesce(try_cast(aweme_type AS INTEGER), 0) = 68 AS is_note, count(*) AS n FROM posts_raw GROUP BY 1, 2""")
def _(v):
    return ingest.split_media_type(v("posts_raw")).groupBy("account", "is_note").agg(F.count("*").alias("n"))


@query("F6_resolve_title", """
SELECT account, seq, coalesce(nullif("desc", ''), nullif(title, ''), '') AS title FROM posts_raw""")
def _(v):
    return v("posts_raw").select("account", "seq", ingest.resolve_title().alias("title"))


@query("F7_resolve_audio", """
WITH a AS (SELECT account, seq, coalesce(nullif(music_download_url, ''), nullif(music_url, ''), '') AS music_url,
  coalesce(video_download_url, '') AS video_url FROM posts_raw)
SELECT account, seq, music_url, CASE WHEN music_url = '' THEN '' ELSE substr(sha256(music_url), 1, 24) END AS music_key,
  CASE WHEN music_url = '' THEN 'missing' ELSE 'mixed_track' END AS published_audio_kind,
  CASE WHEN video_url = '' THEN 'missing' ELSE 'local_video_then_remote_video' END AS speech_source,
  CASE WHEN music_url <> '' THEN music_url ELSE video_url END AS audio_url,
  CASE WHEN music_url <> '' THEN 'music_download_url' WHEN video_url <> '' THEN 'video_download_url' ELSE 'missing' END AS audio_source
FROM a""")
def _(v):
    out = ingest.resolve_audio(v("posts_raw"))
    return out.select("account", "seq", "music_url", "music_key", "published_audio_kind", "speech_source", "audio_url", "audio_source")


AUDIO_SQL = """
a AS (SELECT account, aweme_id, seq, aweme_type, coalesce(nullif(music_download_url, ''), nullif(music_url, ''), '') AS music_url,
  coalesce(video_download_url, '') AS video_url FROM posts_raw
  WHERE aweme_id <> '' AND coalesce(try_cast(aweme_type AS INTEGER), 0) <> 68)"""


@query("F8_speech_source_rows", f"""
WITH {AUDIO_SQL}
SELECT account, aweme_id, video_url AS speech_url,
  CASE WHEN video_url = '' THEN 'missing' ELSE 'local_video_then_remote_video' END AS speech_source, music_url AS published_url,
  CASE WHEN music_url = '' THEN '' ELSE substr(sha256(music_url), 1, 24) END AS published_key FROM a""")
def _(v):
    return ingest.speech_source_rows(ingest.resolve_audio(v("posts_raw")))


@query("F9_music_rows", f"""
WITH {AUDIO_SQL}
SELECT account, aweme_id, music_url, CASE WHEN music_url = '' THEN '' ELSE substr(sha256(music_url), 1, 24) END AS music_key FROM a""")
def _(v):
    return ingest.music_rows(ingest.resolve_audio(v("posts_raw")))


@query("F10_completeness_gate", """
SELECT account, seq, aweme_id <> '' AND create_time <> '' AND comment_count IS NOT NULL AND liked_count <> ''
  AND aweme_type <> 'x' AND (video_download_url <> '' OR aweme_type = '68' AND note_download_url IS NOT NULL)
  AND (cover_url <> '' OR aweme_type = '68') AS complete
FROM posts_raw""")
def _(v):
    rows = v("posts_raw")
    return rows.select("account", "seq", ingest.completeness_gate(rows).alias("complete"))


@query("D1_dedup_first", """
SELECT account, aweme_id, seq, liked_count, nickname FROM (
  SELECT *, row_number() OVER (PARTITION BY account, aweme_id ORDER BY seq) AS rn FROM posts_raw) WHERE rn = 1""")
def _(v):
    rows = v("posts_raw").select("account", "aweme_id", "seq", "liked_count", "nickname")
    return ingest.dedup_first(rows, ["account", "aweme_id"])


@query("D2_dedup_latest", f"SELECT account, aweme_id, seq, first_seq, liked_count, nickname FROM ({LATEST_SQL})")
def _(v):
    rows = v("posts_raw").select("account", "aweme_id", "seq", "liked_count", "nickname")
    return ingest.dedup_latest(ingest.require_key(rows, "aweme_id"), ["account", "aweme_id"])


@query("D3_dedup_comments", f"WITH {KEPT_SQL} SELECT account, aweme_id, comment_id, content, nickname, like_count, seq FROM unique_comments")
def _(v):
    out = co.dedup_comments(co.clean_comments(v("comments_raw")))
    return out.select("account", "aweme_id", "comment_id", "content", "nickname", "like_count", "seq")


@query("T1_hard_limit", f"""
WITH u AS ({LATEST_SQL})
SELECT account, aweme_id, first_seq FROM (
  SELECT account, aweme_id, first_seq, row_number() OVER (PARTITION BY account ORDER BY first_seq) AS n FROM u) WHERE n <= 20""")
def _(v):
    unique = ingest.dedup_latest(ingest.require_key(v("posts_raw"), "aweme_id"), ["account", "aweme_id"])
    return ingest.hard_limit(unique, 20).select("account", "aweme_id", "first_seq")


@query("U1_union_runs", "SELECT account, aweme_id, seq, author_word FROM posts_raw")
def _(v):
    cols = ["account", "aweme_id", "seq", "author_word"]
    raw = v("posts_raw")
    return ingest.union_runs(*[raw.filter(F.col("run_id") == f"r{k}").select(*cols) for k in range(10)])


@query("J5_order_by_targets", """
SELECT p.account, p.aweme_id, min(a.pos) AS pos, any_value(p.likes) AS likes FROM posts p JOIN targets a ON p.account = a.account AND p.aweme_id = a.aweme_id GROUP BY 1, 2""")
def _(v):
    return ingest.order_by_targets(v("posts"), v("targets")).select("account", "aweme_id", "pos", "likes")


@query("J13_completed_runs_only", """
SELECT account, aweme_id, seq, run_id FROM posts_raw WHERE run_id IN (SELECT run_id FROM run_state WHERE status = 'completed')""")
def _(v):
    return ingest.completed_runs_only(v("posts_raw"), v("run_state")).select("account", "aweme_id", "seq", "run_id")


@query("A29_ingest_counters", """
WITH r AS (SELECT *, contains(concat(coalesce("desc", ''), '|', coalesce(nickname, ''), '|', coalesce(author_word, '')), 'A') AS hit FROM posts_raw)
SELECT account, count(*) AS total, count(*) FILTER (hit) AS matched,
  count(DISTINCT CASE WHEN hit AND aweme_id <> '' THEN aweme_id END) AS unique_before_limit,
  least(count(DISTINCT CASE WHEN hit AND aweme_id <> '' THEN aweme_id END), 25) AS unique_kept
FROM r GROUP BY account""")
def _(v):
    return ingest.ingest_counters(v("posts_raw"), keyword="A", limit=25)


@query("K1_build_and_write_posts", f"""
WITH u AS ({LATEST_SQL}), p AS (SELECT account, aweme_id, {COUNT_SQL.format('liked_count')} AS likes, first_seq,
  coalesce(nullif("desc", ''), nullif(title, ''), '') AS title,
  array_to_string(list_filter(list_transform(string_split(coalesce(note_download_url, ''), ','), lambda x: trim(x)), lambda x: x <> ''), ' ') AS notes FROM u)
SELECT account, aweme_id, likes, title, notes, CAST(row_number() OVER (PARTITION BY account ORDER BY likes DESC, first_seq) AS INTEGER) AS rank FROM p""")
def _(v):
    path = staged(v, "manifest")
    sinks.write_posts(ingest.build_posts(v("posts_raw")), path)
    rows = v.spark.read.parquet(path)
    return rows.select("account", "aweme_id", "likes", "title", F.array_join("note_urls", " ").alias("notes"), "rank")


@query("J2_comments_of_known_posts", """
SELECT c.account, c.aweme_id, c.seq FROM comments_raw c WHERE EXISTS (
  SELECT 1 FROM captured p WHERE p.account = c.account AND p.aweme_id = c.aweme_id)""")
def _(v):
    return co.comments_of_known_posts(v("comments_raw"), v("captured")).select("account", "aweme_id", "seq")


@query("W4_top_comments_per_post", f"""
WITH {KEPT_SQL} SELECT account, aweme_id, CAST(pos AS INTEGER) AS pos, comment_id, content, like_count FROM kept WHERE pos <= 3""")
def _(v):
    return co.build_comments(v("comments_raw"), n=3).select("account", "aweme_id", "pos", "comment_id", "content", "like_count")


@query("A27_nest_comments", f"""
WITH {KEPT_SQL} SELECT account, aweme_id, CAST(count(*) AS INTEGER) AS n, 3 AS max,
  string_agg(concat(content, ':', CAST(like_count AS VARCHAR)), '|' ORDER BY pos) AS packed FROM kept WHERE pos <= 3 GROUP BY account, aweme_id""")
def _(v):
    nested = co.nest_comments(co.build_comments(v("comments_raw"), n=3), 3)
    text = F.transform("comments", lambda c: F.concat(c["content"], F.lit(":"), c["like_count"].cast("string")))
    return nested.select("account", "aweme_id", "n", "max", F.array_join(text, "|").alias("packed"))


@query("K2_comment_summary", f"""
WITH {KEPT_SQL} SELECT account, count(*) AS total_comments, count(DISTINCT aweme_id) AS total_videos_with_comments
FROM unique_comments GROUP BY account""")
def _(v):
    return co.comment_summary(co.dedup_comments(co.clean_comments(v("comments_raw"))))


@query("U3_covered_ids", f"WITH {KEPT_SQL} SELECT DISTINCT account, aweme_id FROM unique_comments")
def _(v):
    return co.covered_ids(co.clean_comments(v("comments_raw")))


@query("J9_comment_with_title", """
SELECT c.account, c.aweme_id, c.seq, coalesce(p.title, '') AS title FROM comments_raw c LEFT JOIN captured p
  ON p.account = c.account AND p.aweme_id = c.aweme_id""")
def _(v):
    return co.comment_with_title(v("comments_raw"), v("captured")).select("account", "aweme_id", "seq", "title")


TOP_COMMENTS_SQL = """
WITH {kept} SELECT account, CAST(place AS INTEGER) AS place, aweme_id, like_count, content, title FROM (
  SELECT k.account, k.aweme_id, k.like_count, substr(k.content, 1, {chars}) AS content, substr(p.title, 1, {title}) AS title,
    row_number() OVER (PARTITION BY k.account ORDER BY k.like_count DESC, p.likes DESC, p.seq, k.pos) AS place
  FROM kept k JOIN posts p ON p.account = k.account AND p.aweme_id = k.aweme_id WHERE k.pos <= 3) WHERE place <= {k}"""


@query("T4_top_comments", TOP_COMMENTS_SQL.format(kept=KEPT_SQL, chars=48, title=18, k=20))
def _(v):
    out = co.top_comments(co.build_comments(v("comments_raw"), n=3), v("posts"))
    return out.select("account", "place", "aweme_id", "like_count", "content", "title")


@query("T6_top_comment_cards", TOP_COMMENTS_SQL.format(kept=KEPT_SQL, chars=80, title=20, k=6))
def _(v):
    out = co.top_comments(co.build_comments(v("comments_raw"), n=3), v("posts"), 6, content_chars=80, title_chars=20)
    return out.select("account", "place", "aweme_id", "like_count", "content", "title")


@query("W1_rank_posts", """
SELECT account, aweme_id, likes, CAST(row_number() OVER (PARTITION BY account ORDER BY likes DESC, seq) AS INTEGER) AS rank FROM posts""")
def _(v):
    return ingest.rank_posts(v("posts"), seq="seq").select("account", "aweme_id", "likes", "rank")


RANKS_SQL = """
ranked AS (SELECT *,
  CAST(row_number() OVER (PARTITION BY account ORDER BY likes DESC, seq) AS INTEGER) AS likes_rank,
  CAST(row_number() OVER (PARTITION BY account ORDER BY collects DESC, likes DESC, seq) AS INTEGER) AS collects_rank,
  CAST(row_number() OVER (PARTITION BY account ORDER BY shares DESC, likes DESC, seq) AS INTEGER) AS shares_rank,
  CAST(row_number() OVER (PARTITION BY account ORDER BY comments DESC, likes DESC, seq) AS INTEGER) AS comments_rank
FROM posts)"""
NZMED_SQL = """
medians AS (SELECT account, coalesce(median(collects) FILTER (collects > 0), 0) AS collects_nzmed,
  coalesce(median(shares) FILTER (shares > 0), 0) AS shares_nzmed,
  coalesce(median(comments) FILTER (comments > 0), 0) AS comments_nzmed FROM posts GROUP BY account)"""


@query("W2_metric_ranks", f"WITH {RANKS_SQL} SELECT account, aweme_id, likes_rank, collects_rank, shares_rank, comments_rank FROM ranked")
def _(v):
    return ranking.metric_ranks(v("posts")).select("account", "aweme_id", "likes_rank", "collects_rank", "shares_rank", "comments_rank")


@query("W3_prominence", f"""
WITH {RANKS_SQL} SELECT account, aweme_id, likes_rank::DOUBLE / collects_rank AS collects_prominence,
  likes_rank::DOUBLE / shares_rank AS shares_prominence, likes_rank::DOUBLE / comments_rank AS comments_prominence FROM ranked""")
def _(v):
    out = ranking.prominence(ranking.metric_ranks(v("posts")))
    return out.select("account", "aweme_id", "collects_prominence", "shares_prominence", "comments_prominence")


@query("A5_nonzero_median", f"WITH {NZMED_SQL} SELECT * FROM medians")
def _(v):
    return ranking.nonzero_median(v("posts"))


ARCHETYPE_SQL = f"""
WITH {RANKS_SQL}, {NZMED_SQL},
long AS (
  SELECT r.*, 'collects' AS archetype, collects AS val, likes_rank::DOUBLE / collects_rank AS prom, collects_nzmed::DOUBLE AS med, 1.3::DOUBLE AS thr FROM ranked r JOIN medians m ON r.account = m.account
  UNION ALL SELECT r.*, 'shares', shares, likes_rank::DOUBLE / shares_rank, shares_nzmed::DOUBLE, 1.3::DOUBLE FROM ranked r JOIN medians m ON r.account = m.account
  UNION ALL SELECT r.*, 'comments', comments, likes_rank::DOUBLE / comments_rank, comments_nzmed::DOUBLE, 1.4::DOUBLE FROM ranked r JOIN medians m ON r.account = m.account),
placed AS (SELECT *, prom * val / (med + 1) AS score, row_number() OVER (PARTITION BY account, archetype ORDER BY prom * val / (med + 1) DESC, likes_rank) AS place
  FROM long WHERE val >= med AND prom > thr AND val > 0)
SELECT account, archetype, CAST(place AS INTEGER) AS place, aweme_id, likes, collects, shares, comments, likes_rank, score, substr(title, 1, 26) AS title
FROM placed WHERE place <= 5"""


@query("T2_archetype_top5", ARCHETYPE_SQL)
def _(v):
    return ranking.archetype_top5(v("posts"))


def _top_sql(k: int, chars: int, extra: str = "") -> str:
    return f"""
SELECT account, CAST(place AS INTEGER) AS place, aweme_id, likes, collects, shares, comments, {extra}substr(title, 1, {chars}) AS title FROM (
  SELECT *, row_number() OVER (PARTITION BY account ORDER BY likes DESC, seq) AS place FROM posts) WHERE place <= {k}"""


@query("T3_viral_top5", _top_sql(5, 26))
def _(v):
    return ranking.viral_top5(v("posts"))


@query("T5_top_posts", _top_sql(10, 38, "coalesce(strftime(make_timestamp(create_time * 1000000), '%Y-%m-%d'), '-') AS day, "))
def _(v):
    return ranking.top_posts(v("posts"))


@query("T10_viral_key_frames", """
WITH one AS (SELECT account, aweme_id, min(file) AS file FROM frame_rows GROUP BY 1, 2)
SELECT account, CAST(place AS INTEGER) AS place, aweme_id, likes, file FROM (
  SELECT p.account, p.aweme_id, p.likes, o.file, row_number() OVER (PARTITION BY p.account ORDER BY p.likes DESC, p.seq) AS place
  FROM posts p JOIN one o ON p.account = o.account AND p.aweme_id = o.aweme_id) WHERE place <= 8""")
def _(v):
    one = v("frame_rows").groupBy("account", "aweme_id").agg(F.min("file").alias("file"))
    return ranking.viral_key_frames(v("posts"), one).select("account", "place", "aweme_id", "likes", "file")


@query("J3_missing_artifacts", """
SELECT account, aweme_id FROM posts p WHERE aweme_type <> 68 AND NOT EXISTS (
  SELECT 1 FROM soundtrack s WHERE s.account = p.account AND s.aweme_id = p.aweme_id)""")
def _(v):
    return reconcile.missing_artifacts(v("posts"), v("soundtrack"))


@query("U2_missing_ids", """
WITH gone AS (SELECT account, aweme_id FROM posts EXCEPT SELECT account, aweme_id FROM soundtrack),
n AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY aweme_id) AS i FROM gone)
SELECT account, count(*) AS missing, string_agg(aweme_id, ',' ORDER BY aweme_id) FILTER (i <= 10) AS preview FROM n GROUP BY account""")
def _(v):
    return reconcile.missing_ids(v("posts"), v("soundtrack"))


@query("J4_reconcile_counts", """
WITH g AS (SELECT account, count(*) AS captured FROM posts GROUP BY account)
SELECT g.account, captured, aweme_count, CASE WHEN aweme_count IS NULL OR aweme_count <= 0 THEN 'unknown'
  WHEN captured >= aweme_count THEN 'ok' WHEN captured >= 300 THEN 'capped' ELSE 'incomplete' END AS status,
  CASE WHEN aweme_count > 0 THEN greatest(aweme_count - captured, 0) END AS missing
FROM g LEFT JOIN creator_counts c ON c.account = g.account""")
def _(v):
    return reconcile.reconcile_counts(v("posts"), v("creator_counts"), 300)


@query("J12_identity_guard", """
SELECT account, count(DISTINCT sec_uid) AS creators, min(sec_uid) AS first_creator, true AS slug_ok FROM posts_raw
GROUP BY account HAVING count(DISTINCT sec_uid) > 1""")
def _(v):
    return reconcile.identity_guard(v("posts_raw"))


@query("U4_explicit_zero_coverage", """
SELECT account, bool_and(skipped AND coalesce(try_cast(nullif(trim(comment_count), '') AS BIGINT) = 0, false)) AS zero_ok, count(*) AS targets
FROM zero_posts GROUP BY account""")
def _(v):
    rows = v("zero_posts")
    return reconcile.explicit_zero_coverage(rows, rows.filter("skipped"))


@query("A30_skip_counters", """
SELECT account, count(*) FILTER (contains(value, 'saved_detail_requests')) AS saved_detail_requests,
  count(*) FILTER (contains(value, 'skipped_zero_comments')) AS skipped_comment_requests,
  count(*) FILTER (contains(value, 'skipped_zero_comments')) AS skipped_zero_comments,
  count(DISTINCT nullif(regexp_extract(value, 'aweme_id:([^ ]+)', 1), '')) AS skipped_ids
FROM crawl_log WHERE contains(value, 'saved_detail_requests') OR contains(value, 'skipped_zero_comments') GROUP BY account""")
def _(v):
    return reconcile.skip_counters(v("crawl_log"))


@query("A31_stage_metrics", """
WITH s AS (SELECT run_id, stage, CAST(sum(CAST(duration_sec AS DECIMAL(18,3))) AS DOUBLE) AS duration_sec, CAST(sum(items) AS BIGINT) AS items,
  CASE WHEN max(returncode) = 0 THEN 'completed' ELSE 'failed' END AS status FROM stage_events GROUP BY 1, 2),
b AS (SELECT run_id, stage, backend FROM (SELECT run_id, stage, backend, row_number() OVER (PARTITION BY run_id, stage ORDER BY count(*) DESC, min(seq)) AS i
  FROM stage_events WHERE backend <> '' GROUP BY 1, 2, 3) WHERE i = 1)
SELECT s.run_id, s.stage, duration_sec, items, CAST(round_even(items / duration_sec, 3) AS DOUBLE) AS throughput, backend, status
FROM s LEFT JOIN b ON b.run_id = s.run_id AND b.stage = s.stage""")
def _(v):
    return reconcile.stage_metrics(v("stage_events"))


@query("F12_artifact_validity", """
SELECT aweme_id, account, version, current_sha256, audio_sha256, coalesce(config_hash = 'A' AND requested_device = 'cpu' AND actual_device = 'cpu'
  AND actual_compute <> '' AND audio_sha256 <> '' AND audio_sha256 = current_sha256, false) AS valid FROM artifacts""")
def _(v):
    ok = inc.artifact_validity({"config_hash": "A", "requested_device": "cpu"})
    return v("artifacts").select("aweme_id", "account", "version", "current_sha256", "audio_sha256", ok.alias("valid"))


@query("J11_pending_work", """
SELECT aweme_id, account, config_hash, content_hash, version FROM artifacts a WHERE NOT EXISTS (SELECT 1 FROM artifacts d
  WHERE d.actual_device = 'cuda' AND d.aweme_id = a.aweme_id AND d.account = a.account AND d.config_hash = a.config_hash
  AND d.content_hash = a.content_hash AND d.version = a.version)""")
def _(v):
    rows = v("artifacts")
    return inc.pending_work(rows, rows.filter("actual_device = 'cuda'")).select("aweme_id", "account", "config_hash", "content_hash", "version")


@query("F13_low_confidence_flag", """
SELECT account, aweme_id, seq, coalesce(language_probability, 0) < 0.8 OR coalesce(avg_logprob < -0.8, false) OR seq % 9 = 0 AS low FROM segments""")
def _(v):
    rows = v("segments").withColumn("n_segments", F.col("seq") % 9)
    return rows.select("account", "aweme_id", "seq", inc.low_confidence_flag().alias("low"))


@query("A25_avg_logprob", """
SELECT account, aweme_id, count(*) AS n_segments,
  CAST(round_even(CAST(sum(CAST(avg_logprob AS DECIMAL(24,6))) AS DOUBLE) / count(avg_logprob), 3) AS DOUBLE) AS avg_logprob FROM segments GROUP BY 1, 2""")
def _(v):
    return inc.avg_logprob(v("segments"))


@query("X1_shared_work_by_url", """
WITH l AS (SELECT account, aweme_id, regexp_replace(url, '[?#].*', '') AS u FROM links)
SELECT substr(sha256(u), 1, 24) AS url_key, u AS url, count(*) AS items FROM l WHERE u <> '' GROUP BY 1, 2""")
def _(v):
    links = v("links").withColumn("url", F.regexp_replace("url", "[?#].*", ""))
    return inc.compute_once_per_url(links, "url")[0]
