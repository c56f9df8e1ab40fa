"""The given star-schema tables read as posts, comments, segments, soundtracks and frames.

Each view is one SELECT over the given tables, written once and rendered for Spark or for DuckDB,
so a query and its SQL check start from the same rows. Account ``a0`` owns a third of all posts.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
FACTS = "orders lineitem events documents embeddings pages conversations".split()


def _account(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN 'a0' ELSE concat('a', CAST({key} % 50 AS STRING)) END"


_SPARK = {
    "days": "CAST(datediff(CAST({0} AS DATE), DATE'1970-01-01') AS BIGINT)",
    "millis": "(CAST(datediff(CAST({0} AS DATE), DATE'2024-01-01') AS BIGINT) * 86400000 + hour({0}) * 3600000 + "
    "minute({0}) * 60000 + CAST(floor(extract(SECOND FROM {0}) * 1000) AS BIGINT))",
    "digits": "regexp_extract({0}, '([0-9]+)', 1)",
    "doubles": "CAST({0} AS ARRAY<DOUBLE>)",
    "octets": "octet_length({0})",
    "upto": "explode(sequence(0, CAST({0} AS INT)))",
}
_DUCK = {
    "days": "CAST(date_diff('day', DATE '1970-01-01', CAST({0} AS DATE)) AS BIGINT)",
    "millis": "((epoch_us({0}) - epoch_us(TIMESTAMP '2024-01-01')) // 1000)",
    "digits": "regexp_extract({0}, '([0-9]+)', 1)",
    "doubles": "CAST({0} AS DOUBLE[])",
    "octets": "octet_length(encode({0}))",
    "upto": "unnest(range(0, CAST({0} AS INT) + 1))",
}

VIEWS = {
    "posts": f"""
SELECT {_account('o_orderkey')} AS account, CAST(o_orderkey AS STRING) AS aweme_id, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'P' THEN 68 ELSE 0 END AS aweme_type,
  concat(o_orderpriority, ' #', o_orderstatus, ' x#t', CAST(o_custkey % 7 AS STRING), '.y') AS title,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE @days(o_orderdate) * 86400 + (o_orderkey * 37 % 1440) * 60 END
    AS create_time,
  CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 WHEN o_orderkey % 4 = 0 THEN floor(o_totalprice / 1000)
    ELSE floor(o_totalprice) END AS BIGINT) AS likes,
  coalesce(c.comments, 0) AS comments, coalesce(c.collects, 0) AS collects, coalesce(c.shares, 0) AS shares
FROM $orders LEFT JOIN (
  SELECT l_orderkey, count(*) AS comments, CAST(sum(l_quantity) AS BIGINT) AS collects,
    count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS shares
  FROM $lineitem GROUP BY l_orderkey) c ON l_orderkey = o_orderkey""",
    "captured": f"""
SELECT {_account('o_orderkey')} AS account, CAST(o_orderkey AS STRING) AS aweme_id,
  concat(o_orderpriority, ' #', o_orderstatus) AS title
FROM $orders WHERE o_orderkey % 29 <> 0""",
    "posts_raw": f"""
SELECT {_account('l_orderkey')} AS account, CASE WHEN l_orderkey % 89 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END AS aweme_id,
  @days(l_shipdate) * 10000000000000 + l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber AS seq,
  CASE WHEN l_orderkey % 5 = 0 THEN '68' WHEN l_orderkey % 7 = 0 THEN 'x' ELSE '0' END AS aweme_type,
  CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE concat('line ', l_returnflag, CAST(l_partkey % 13 AS STRING)) END AS "desc",
  CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE concat('title ', l_linestatus) END AS title,
  concat('sup', CAST(l_suppkey AS STRING)) AS nickname,
  CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS author_word,
  CASE WHEN l_orderkey % 31 = 0 THEN '' ELSE CAST(@days(l_shipdate) * 86400 AS STRING) END AS create_time,
  CASE WHEN l_linenumber = 7 THEN '1.2w' WHEN l_linenumber = 6 THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END
    AS liked_count,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE concat(' ', CAST(l_linenumber AS STRING)) END AS comment_count,
  CAST(l_partkey % 10 AS STRING) AS collected_count, CAST(l_suppkey % 10 AS STRING) AS share_count,
  CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE concat('http://v/', CAST(l_partkey AS STRING)) END AS video_download_url,
  CASE WHEN l_linenumber = 3 THEN '' ELSE concat('http://c/', CAST(l_partkey AS STRING)) END AS cover_url,
  CASE WHEN l_linenumber % 3 = 0 THEN concat('http://m/', CAST(l_suppkey AS STRING)) ELSE '' END AS music_download_url,
  CASE WHEN l_linenumber % 3 = 1 THEN concat('http://n/', CAST(l_suppkey AS STRING)) ELSE NULL END AS music_url,
  CASE WHEN l_orderkey % 5 = 0 THEN concat('http://i/', CAST(l_partkey AS STRING), ' , ,http://j') ELSE NULL END
    AS note_download_url,
  concat('u', CAST(CASE WHEN l_orderkey % 50 = 7 THEN l_linenumber % 2 ELSE 0 END AS STRING)) AS sec_uid,
  concat('r', CAST(l_suppkey % 10 AS STRING)) AS run_id
FROM $lineitem""",
    "comments_raw": f"""
SELECT {_account('l_orderkey')} AS account, CAST(l_orderkey AS STRING) AS aweme_id,
  CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(l_linenumber AS STRING) END AS comment_id,
  CASE WHEN l_tax = 0.08 THEN '  ' ELSE concat(l_returnflag, l_linestatus, ' part ', CAST(l_partkey % 100 AS STRING)) END AS content,
  concat('sup', CAST(l_suppkey % 4 AS STRING)) AS nickname,
  CASE WHEN l_quantity = 50 THEN '' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS like_count,
  @days(l_shipdate) * 86400 AS create_time,
  @days(l_shipdate) * 10000000000000 + l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber AS seq
FROM $lineitem""",
    "talk": f"""
SELECT {_account('conv_id')} AS account, CAST(conv_id AS STRING) AS aweme_id, CAST(turn AS STRING) AS comment_id,
  text AS content, role AS nickname, (length(text) * 7 + turn) % 101 AS like_count, conv_id * 1000 + turn AS create_time,
  conv_id * 1000 + turn AS seq
FROM $conversations""",
    "transcripts": f"""
SELECT {_account('doc_id')} AS account, CAST(doc_id AS STRING) AS aweme_id, text AS transcript, lang AS language,
  CAST(n_chars AS DOUBLE) / 10 AS duration, doc_id AS seq
FROM $documents""",
    "labelled": f"""
SELECT {_account('doc_id')} AS account, CAST(doc_id AS STRING) AS aweme_id, quality, toxic FROM $labels""",
    "segments": f"""
SELECT {_account('user_id')} AS account, CAST(user_id AS STRING) AS aweme_id, event_id AS seq,
  @millis(ts) / CAST(1000 AS DOUBLE) AS start, @millis(ts) / CAST(1000 AS DOUBLE) + value * 500 AS "end",
  concat(' ', event_type, CAST(event_id % 10 AS STRING), ' ') AS text,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE -value / 20 END AS avg_logprob,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 100 END AS confidence,
  CAST(NULL AS DOUBLE) AS probability,
  CASE WHEN event_id % 7 = 0 THEN 0.5E0 END AS language_probability
FROM $events""",
    "durations": f"""
SELECT {_account('user_id')} AS account, CAST(user_id AS STRING) AS aweme_id,
  CAST(floor(max(@millis(ts)) / 1000) AS BIGINT) + CAST(user_id % 20 AS DOUBLE) * 300 AS duration
FROM $events GROUP BY user_id""",
    "soundtrack": f"""
SELECT {_account('o_orderkey')} AS account, CAST(o_orderkey AS STRING) AS aweme_id,
  CASE WHEN o_custkey % 61 = 0 THEN 'old' ELSE 'published-mixed-track-bgm-v3' END AS cache_version,
  'mixed_track' AS source_kind, CASE WHEN o_custkey % 67 = 0 THEN 'all' ELSE 'non_speech_windows' END AS analysis_scope,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'insufficient_evidence' ELSE 'ok' END AS analysis_status,
  CASE WHEN o_orderkey % 22 = 0 THEN 'error' WHEN o_orderkey % 11 = 0 THEN '' ELSE 'ok' END AS source_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'full' WHEN '5-LOW' THEN 'light' WHEN '2-HIGH' THEN 'unknown' ELSE 'none' END AS bgm_level,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE concat('mood', CAST(o_custkey % 4 AS STRING)) END AS mood, 'unknown' AS vocal,
  CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE concat('track ', CAST(o_custkey % 13 AS STRING)) END AS bgm_text,
  CAST(o_orderkey % 100 AS DOUBLE) / 10 AS non_speech_seconds, CAST(o_custkey % 40 AS DOUBLE) / 100 AS non_speech_coverage,
  CAST(o_orderkey % 100 AS DOUBLE) AS duration
FROM $orders WHERE o_orderkey % 53 <> 0""",
    "frame_rows": f"""
SELECT {_account('l_orderkey')} AS account, CAST(l_orderkey AS STRING) AS aweme_id,
  l_linenumber * 100000000000000 + l_partkey * 1000000000 + l_suppkey * 10000 + @days(l_shipdate) % 10000 AS seq,
  CAST(l_linenumber AS DOUBLE) AS timestamp,
  CASE l_returnflag WHEN 'A' THEN 'balanced' WHEN 'N' THEN 'low_key' ELSE 'high_key_muted' END AS visual_style,
  CASE l_linestatus WHEN 'O' THEN 'warm' ELSE 'cool' END AS temperature,
  CASE l_suppkey % 3 WHEN 0 THEN 'centered' WHEN 1 THEN 'rule_of_thirds' ELSE 'asymmetric' END AS composition,
  CASE l_partkey % 2 WHEN 0 THEN 'outdoor_candidate' ELSE 'indoor_or_closeup_candidate' END AS scene,
  l_quantity AS mean_h, l_discount * 1000 AS mean_s, l_tax * 1000 AS mean_v,
  l_linestatus = 'O' AND l_quantity > 20 AS subtitle_present,
  CASE WHEN l_partkey % 3 = 0 THEN 'top' WHEN l_partkey % 3 = 1 THEN 'bottom' ELSE 'middle' END AS region,
  l_discount >= 0.08E0 AS product_candidate,
  CASE WHEN l_orderkey % 2 = 0 THEN 'ok' ELSE 'unavailable' END AS ocr_status,
  concat('f', CAST(l_linenumber AS STRING), '_', CAST(l_partkey AS STRING), '_', CAST(l_suppkey AS STRING), '.jpg') AS file
FROM $lineitem""",
    "boxes": f"""
SELECT {_account('l_orderkey')} AS account, CAST(l_orderkey AS STRING) AS aweme_id, l_linenumber AS frame,
  @days(l_shipdate) * 10000000000000 + l_partkey * 100000000 + l_suppkey * 1000 + l_linenumber AS box_no,
  concat(' ', l_returnflag, ' ') AS text, l_quantity AS conf, l_partkey % 700 AS x, l_partkey % 1000 AS y,
  l_linenumber * 10 AS w, l_suppkey % 50 + 1 AS h
FROM $lineitem""",
    "box_frames": f"""
SELECT DISTINCT {_account('l_orderkey')} AS account, CAST(l_orderkey AS STRING) AS aweme_id, l_linenumber AS frame,
  1080 AS height, 720 AS width
FROM $lineitem""",
    "shots": f"""
SELECT {_account('user_id')} AS account, CAST(user_id AS STRING) AS aweme_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS BIGINT) AS idx,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS DOUBLE) / 12 AS timestamp,
  12 AS rate, count(*) OVER (PARTITION BY user_id) AS frames, value / 100 AS scene_score
FROM $events""",
    "reviews": f"""
SELECT DISTINCT {_account('user_id')} AS account, CAST(user_id AS STRING) AS aweme_id,
  1.0E0 + CAST(user_id % 5 AS DOUBLE) / 4 AS start, 2.5E0 + CAST(user_id % 5 AS DOUBLE) / 4 AS "end"
FROM $events""",
    "hist_frames": f"""
SELECT {_account('label')} AS account, CAST(label AS STRING) AS aweme_id, vec_id AS idx, @doubles(embedding) AS hist
FROM $embeddings""",
    "targets": f"""
SELECT {_account('o_orderkey')} AS account, CAST(o_orderkey AS STRING) AS aweme_id,
  CAST(floor(o_totalprice) AS BIGINT) * 2 + m AS pos
FROM $orders CROSS JOIN (SELECT 0 AS m UNION ALL SELECT 1 AS m) WHERE o_custkey % 10 = m""",
    "creator_counts": f"""
SELECT {_account('o_orderkey')} AS account, CASE WHEN min(o_orderkey) % 5 = 4 THEN NULL ELSE
  count(*) + CAST(min(o_orderkey) % 3 AS BIGINT) - 1 END AS aweme_count
FROM $orders GROUP BY {_account('o_orderkey')}""",
    "zero_posts": f"""
SELECT {_account('o_orderkey')} AS account, CAST(o_orderkey AS STRING) AS aweme_id,
  CASE WHEN o_orderkey % 50 = 7 THEN '3' WHEN o_orderkey % 50 = 8 THEN '' ELSE ' 0' END AS comment_count,
  o_orderkey % 50 <> 11 AS skipped
FROM $orders WHERE NOT EXISTS (SELECT 1 FROM $lineitem WHERE l_orderkey = o_orderkey)""",
    "stage_events": """
SELECT concat('r', CAST(user_id % 10 AS STRING)) AS run_id, event_type AS stage, event_id AS seq,
  value AS duration_sec, CAST(@digits(props) AS BIGINT) AS items,
  CASE user_id % 3 WHEN 0 THEN 'cuda' WHEN 1 THEN 'cpu' ELSE '' END AS backend,
  CASE WHEN event_id % 499 = 0 THEN 1 ELSE 0 END AS returncode, ts AS updated_at
FROM $events""",
    "crawl_log": f"""
SELECT {_account('user_id')} AS account, CASE event_type WHEN 'error' THEN
  concat('[opt] skipped_zero_comments aweme_id:', CAST(user_id AS STRING), ' x') WHEN 'click' THEN
  '[opt] saved_detail_requests' ELSE concat('line ', event_type) END AS value
FROM $events""",
    "run_state": """
SELECT concat('r', CAST(s_suppkey % 10 AS STRING)) AS run_id,
  CASE WHEN max(s_nationkey) > 20 THEN 'completed' ELSE 'failed' END AS status
FROM $supplier GROUP BY s_suppkey % 10""",
    "tagged": f"""
SELECT {_account('p_partkey')} AS account, CAST(p_partkey AS STRING) AS aweme_id, p_partkey AS seq,
  concat(p_name, ' ', p_brand) AS title, p_type AS track, p_brand AS hook, split_part(p_name, ' ', 2) AS proof,
  CAST(p_size AS BIGINT) AS likes, CAST(floor(p_retailprice) AS BIGINT) % 100 AS comments,
  CAST(p_partkey % 37 AS BIGINT) AS collects, CAST(p_partkey % 5 AS BIGINT) AS shares
FROM $part""",
    "links": f"""
SELECT {_account('page_id')} AS account, CAST(page_id AS STRING) AS aweme_id, url,
  concat(url, ',', ' ', url, ' ,,x') AS urls, html AS body
FROM $pages""",
    "doc_audio": f"""
SELECT {_account('doc_id')} AS account, CAST(doc_id AS STRING) AS aweme_id,
  CAST(floor(@octets(text) / 2) AS DOUBLE) / 16000 AS duration, CAST(floor(@octets(text) / 2) AS BIGINT) AS samples
FROM $documents""",
    "doc_segments": f"""
SELECT account, aweme_id, CAST(j AS BIGINT) AS seq, 0.06E0 * j + 0.01E0 AS start,
  0.06E0 * j + 0.03E0 + CAST(doc_id % 3 AS DOUBLE) / 100 AS "end"
FROM (SELECT {_account('doc_id')} AS account, CAST(doc_id AS STRING) AS aweme_id, doc_id,
  @upto(floor(@octets(text) / 1920)) AS j FROM $documents) d""",
    "artifacts": """
SELECT CAST(l_orderkey AS STRING) AS aweme_id, CAST(l_orderkey % 50 AS STRING) AS account, l_returnflag AS config_hash,
  l_linestatus AS content_hash, CAST(l_linenumber AS STRING) AS version, CAST(l_suppkey % 5 AS STRING) AS current_sha256,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CAST(l_partkey % 5 AS STRING) END AS audio_sha256,
  CASE l_linenumber % 3 WHEN 0 THEN 'cuda' ELSE 'cpu' END AS requested_device,
  CASE l_linenumber % 4 WHEN 0 THEN 'cuda' ELSE 'cpu' END AS actual_device,
  CASE WHEN l_quantity < 5 THEN '' ELSE 'int8' END AS actual_compute, 'local' AS runner, l_shipdate AS made
FROM $lineitem""",
}


def render(name: str, dialect: dict[str, str]) -> str:
    def call(match: re.Match) -> str:
        depth, args, start = 1, [], match.end()
        i = start
        while depth:
            c = text[i]
            depth += (c == "(") - (c == ")")
            if (c == "," and depth == 1) or depth == 0:
                args.append(text[start:i].strip())
                start = i + 1
            i += 1
        spans.append(i)
        return dialect[match.group(1)].format(*args)

    text = VIEWS[name]
    while True:
        spans: list[int] = []
        match = re.search(r"@(\w+)\(", text)
        if not match:
            return text
        done = call(match)
        text = text[: match.start()] + done + text[spans[0] :]


def duck_view(name: str) -> str:
    return render(name, _DUCK).replace("$", "")


class Views:
    """Spark side: given tables and the views above, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """A given table. The test files hold one row group each, which one task would read and
        process alone; a fact table with fewer splits than cores is spread over them by its key."""
        rows = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        if name in FACTS and rows.rdd.getNumPartitions() < cores:
            return rows.repartition(cores, rows.columns[0])
        return rows

    def __call__(self, name: str) -> DataFrame:
        text = re.sub(r'"(\w+)"', r"`\1`", render(name, _SPARK))
        used = set(re.findall(r"\$(\w+)", text))
        return self.spark.sql(re.sub(r"\$(\w+)", r"{\1}", text), **{t: self.table(t) for t in used})

    # Binary content cut from the given texts; DuckDB works on the text's bytes instead.

    def proxies(self, hop: int = 256, size: int = 64 * 36) -> DataFrame:
        """Grey 64x36 proxies: a window sliding over each page's bytes."""
        raw = self.table("pages").selectExpr(
            f"{_account('page_id')} AS account", "CAST(page_id AS STRING) AS aweme_id",
            "encode(html, 'UTF-8') AS b",
        ).withColumn("idx", F.explode(F.expr(f"sequence(0L, CAST((octet_length(b) - 1) DIV {hop} AS BIGINT))")))
        grey = F.expr(f"rpad(substring(b, CAST(idx * {hop} + 1 AS INT), {size}), {size}, X'00')")
        return raw.select(
            "account", "aweme_id", "idx", (F.col("idx") / F.lit(4.0)).alias("timestamp"), grey.alias("grey")
        )

    def images(self, side: int = 24) -> DataFrame:
        """BGR images: consecutive pieces of each page's bytes, the last one padded."""
        size = side * side * 3
        raw = self.table("pages").selectExpr(
            f"{_account('page_id')} AS account", "CAST(page_id AS STRING) AS aweme_id",
            "encode(html, 'UTF-8') AS b",
        ).withColumn("idx", F.explode(F.expr(f"sequence(0L, CAST((octet_length(b) - 1) DIV {size} AS BIGINT))")))
        data = F.expr(f"rpad(substring(b, CAST(idx * {size} + 1 AS INT), {size}), {size}, X'00')")
        return raw.select(
            "account", "aweme_id", "idx", F.lit(side).alias("height"), F.lit(side).alias("width"), data.alias("data")
        )

    def audio(self, samples: int = 4096) -> DataFrame:
        """16-bit audio blocks: each document's bytes read as samples."""
        raw = self.table("documents").selectExpr(
            f"{_account('doc_id')} AS account", "CAST(doc_id AS STRING) AS aweme_id", "encode(text, 'UTF-8') AS b"
        ).withColumn("n", F.expr("octet_length(b) DIV 2")).filter("n > 0")
        blocks = raw.withColumn("block_no", F.explode(F.expr(f"sequence(0L, CAST((n - 1) DIV {samples} AS BIGINT))")))
        return blocks.select(
            "account", "aweme_id", "block_no",
            F.expr(f"least({samples}, n - block_no * {samples})").cast("bigint").alias("samples"),
            F.expr(f"substring(b, CAST(block_no * {2 * samples} + 1 AS INT), CAST(least({samples}, n - block_no * {samples}) * 2 AS INT))").alias("pcm"),
        )
