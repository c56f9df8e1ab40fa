"""Intervals, soundtracks, frames and visual summaries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipstat.operators import frames as fr
from clipstat.operators import intervals as iv
from clipstat.operators import soundtrack
from clipstat.operators import visual as vi
from clipstat.plans.registry import query
from clipstat.session import stage

GROUP = ["account", "aweme_id"]


def islands_sql(source: str, start: str, end: str, tol: str, name: str) -> str:
    return f"""
{name}_r AS (SELECT account, aweme_id, s, e, max(e) OVER (PARTITION BY account, aweme_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM (SELECT account, aweme_id, {start} AS s, greatest({end}, {start}) AS e FROM {source})),
{name}_b AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {tol} THEN 1 ELSE 0 END) OVER (PARTITION BY account, aweme_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM {name}_r),
{name} AS (SELECT account, aweme_id, CAST(island AS INTEGER) AS island, min(s) AS start, max(e) AS "end", count(*) AS segments FROM {name}_b GROUP BY 1, 2, 3)"""


def windows_sql(name: str, islands: str, durations: str) -> str:
    return f"""
{name} AS (SELECT account, aweme_id, CAST(round_even(a, 3) AS DOUBLE) AS start, CAST(round_even(b, 3) AS DOUBLE) AS "end" FROM (
  SELECT account, aweme_id, coalesce(lag("end") OVER (PARTITION BY account, aweme_id ORDER BY start), 0) AS a, start AS b FROM {islands}
  UNION ALL SELECT i.account, i.aweme_id, max(i."end"), any_value(d.duration) FROM {islands} i JOIN {durations} d ON d.account = i.account AND d.aweme_id = i.aweme_id GROUP BY 1, 2)
  WHERE b - a > 0.02)"""


def clipped_sql(segments: str, durations: str) -> str:
    return f"""
clipped AS (SELECT account, aweme_id, duration, s, e FROM (SELECT g.account, g.aweme_id, d.duration, greatest(g.start, 0) AS s, least(g."end", d.duration) AS e
  FROM {segments} g JOIN {durations} d ON d.account = g.account AND d.aweme_id = g.aweme_id) WHERE e > s)"""


SPEECH_SQL = clipped_sql("segments", "durations") + "," + islands_sql(
    "clipped", "greatest(s - 0.15::DOUBLE, 0)", "least(e + 0.15::DOUBLE, duration)", "0", "islands")
WINDOWS_SQL = SPEECH_SQL + "," + windows_sql("windows", "islands", "durations")


@query("W7_merge_intervals", "WITH " + islands_sql("segments", "start", '"end"', "30::DOUBLE", "islands") + " SELECT * FROM islands")
def _(v):
    return iv.merge_intervals(v("segments"), 30.0)


LOW_SQL = """coalesce(CASE WHEN confidence IS NOT NULL THEN confidence < 0.8 WHEN language_probability IS NOT NULL THEN language_probability < 0.8
  ELSE avg_logprob < -0.8 END, false)"""


@query("F14_low_segment", f"SELECT account, aweme_id, seq, {LOW_SQL} AS low FROM segments")
def _(v):
    return v("segments").select(*GROUP, "seq", iv.low_segment().alias("low"))


@query("W7_review_intervals", f"""
WITH low AS (SELECT * FROM segments WHERE {LOW_SQL}),
{islands_sql('low', 'greatest(start - 0.35::DOUBLE, 0)', '"end" + 0.35::DOUBLE', '0.25::DOUBLE', 'islands')}
SELECT account, aweme_id, island, CAST(round_even(start, 3) AS DOUBLE) AS start, CAST(round_even("end", 3) AS DOUBLE) AS "end", segments FROM islands""")
def _(v):
    return iv.review_intervals(v("segments"))


@query("W7_speech_islands", f"WITH {SPEECH_SQL} SELECT * FROM islands")
def _(v):
    return iv.speech_islands(v("segments"), v("durations"))


@query("W8_complement_intervals", f"WITH {WINDOWS_SQL} SELECT * FROM windows")
def _(v):
    return iv.non_speech_windows(v("segments"), v("durations"))


@query("J6_frames_in_intervals", f"""
WITH {SPEECH_SQL} SELECT p.account, p.aweme_id, p.seq, p.start AS t FROM segments p WHERE EXISTS (SELECT 1 FROM islands i
  WHERE i.account = p.account AND i.aweme_id = p.aweme_id AND i.start <= p.start + 20 AND p.start + 20 <= i."end")""")
def _(v):
    points = v("segments").select(*GROUP, "seq", F.col("start").alias("t"), (F.col("start") + 20).alias("timestamp"))
    islands = iv.speech_islands(v("segments"), v("durations"))
    return iv.frames_in_intervals(points, islands).select(*GROUP, "seq", "t")


# ---- soundtrack -------------------------------------------------------------------------------

GATED_SQL = """
gated AS (SELECT s.*, p.likes, p.collects, p.shares, p.seq, coalesce(nullif(analysis_status, ''), nullif(source_status, ''), 'unknown') AS status,
  coalesce(coalesce(nullif(analysis_status, ''), nullif(source_status, ''), 'unknown') = 'ok' AND analysis_scope = 'non_speech_windows'
  AND non_speech_seconds >= 3 AND non_speech_coverage >= 0.1::DOUBLE AND bgm_level IN ('none', 'light', 'full') AND p.aweme_id IS NOT NULL, false) AS evidence
  FROM soundtrack s LEFT JOIN (SELECT * FROM posts WHERE aweme_type <> 68) p ON p.account = s.account AND p.aweme_id = s.aweme_id)"""
GROUPS_SQL = GATED_SQL + """,
long AS (SELECT account, 'by_level' AS dimension, coalesce(bgm_level, 'unknown') AS value, likes, collects, shares FROM gated WHERE evidence
  UNION ALL SELECT account, 'by_mood', coalesce(mood, 'unknown'), likes, collects, shares FROM gated WHERE evidence
  UNION ALL SELECT account, 'by_vocal', coalesce(vocal, 'unknown'), likes, collects, shares FROM gated WHERE evidence),
groups AS (SELECT account, dimension, value, count(*) AS n,
  CAST(round_even((count(*) * 100)::DOUBLE / sum(count(*)) OVER (PARTITION BY account, dimension)::DOUBLE, 1) AS DOUBLE) AS pct,
  sum(likes)::DOUBLE / count(*) AS exact_likes, sum(collects)::DOUBLE / count(*) AS exact_collects, sum(shares)::DOUBLE / count(*) AS exact_shares,
  CAST(round_even(sum(likes)::DOUBLE / count(*), 1) AS DOUBLE) AS avg_likes, CAST(round_even(sum(collects)::DOUBLE / count(*), 1) AS DOUBLE) AS avg_collects,
  CAST(round_even(sum(shares)::DOUBLE / count(*), 1) AS DOUBLE) AS avg_shares FROM long GROUP BY 1, 2, 3)"""


def gated(v):
    return soundtrack.evidence_gate(v("soundtrack"), v("posts"))


@query("F15_contract_check", """
SELECT account, aweme_id, cache_version = 'published-mixed-track-bgm-v3' AND analysis_scope = 'non_speech_windows' AS contract_ok FROM soundtrack""")
def _(v):
    return soundtrack.contract_check(v("soundtrack")).select(*GROUP, "contract_ok")


@query("F11_evidence_gate", f"WITH {GATED_SQL} SELECT account, aweme_id, evidence FROM gated")
def _(v):
    return gated(v).select(*GROUP, "evidence")


@query("J8_evidence_with_engagement", f"WITH {GATED_SQL} SELECT account, aweme_id, likes, collects, shares FROM gated WHERE evidence")
def _(v):
    return soundtrack.evidence_with_engagement(gated(v)).select(*GROUP, "likes", "collects", "shares")


@query("A20_status_counts", f"WITH {GATED_SQL} SELECT account, status, count(*) AS n, count(*) FILTER (NOT evidence) AS excluded FROM gated GROUP BY 1, 2")
def _(v):
    return soundtrack.status_counts(gated(v))


@query("A18_group_engagement", f"""
WITH {GROUPS_SQL} SELECT *, CASE WHEN dimension <> 'by_level' THEN value WHEN value = 'none' THEN 'no clear background music'
  WHEN value = 'light' THEN 'light background music' ELSE 'strong background music' END AS label FROM groups""")
def _(v):
    return soundtrack.group_engagement(gated(v))


def _mult(metric: str, kind: str, suffix: str) -> str:
    return f"""CAST(round_even(CASE WHEN n.{kind}_{metric}s <> 0 THEN l.{kind}_{metric}s / n.{kind}_{metric}s END, 3) AS DOUBLE) AS {metric}_mult{suffix}"""


MULTIPLIERS = ", ".join(_mult(m, k, s) for m in ("like", "collect", "share") for k, s in (("avg", ""), ("exact", "_exact")))


@query("A19_group_multipliers", f"""
WITH {GROUPS_SQL} SELECT n.account, {MULTIPLIERS}
FROM groups n JOIN groups l ON l.account = n.account AND l.dimension = 'by_level' AND l.value = 'light' WHERE n.dimension = 'by_level' AND n.value = 'none'""")
def _(v):
    return soundtrack.group_multipliers(soundtrack.group_engagement(gated(v)))


@query("A34_mood_leader", f"""
WITH {GROUPS_SQL} SELECT account, CAST(row_number() OVER (PARTITION BY account ORDER BY avg_likes DESC, value) AS INTEGER) AS place, value AS mood, avg_likes, n
FROM groups WHERE dimension = 'by_mood'""")
def _(v):
    return soundtrack.mood_leader(soundtrack.group_engagement(gated(v)))


@query("T8_top_soundtrack_posts", f"""
WITH {GATED_SQL} SELECT account, CAST(place AS INTEGER) AS place, aweme_id, likes, bgm_level, coalesce(mood, 'unknown') AS mood, vocal, non_speech_seconds
FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY likes DESC, seq) AS place FROM gated WHERE evidence) WHERE place <= 10""")
def _(v):
    return soundtrack.top_soundtrack_posts(gated(v))


@query("V9_soundtrack_record", f"""
WITH {WINDOWS_SQL}, f AS (SELECT account, aweme_id, CAST(sum(CAST("end" - start AS DECIMAL(18,3))) AS DOUBLE) AS free, count(*) AS n_windows FROM windows GROUP BY 1, 2),
u AS (SELECT DISTINCT account, aweme_id FROM clipped), j AS (
SELECT d.account, d.aweme_id, d.duration, coalesce(f.free, 0) AS secs, coalesce(f.n_windows, 0) AS n_windows, u.aweme_id IS NOT NULL AS mask
FROM durations d LEFT JOIN f ON f.account = d.account AND f.aweme_id = d.aweme_id LEFT JOIN u ON u.account = d.account AND u.aweme_id = d.aweme_id)
SELECT account, aweme_id, CASE WHEN mask THEN 'segment_mask' ELSE 'missing_segments' END AS transcript_status, secs AS non_speech_seconds, n_windows,
  CAST(round_even(CASE WHEN duration > 0 THEN secs / duration ELSE 0 END, 4) AS DOUBLE) AS non_speech_coverage,
  CASE WHEN mask AND secs >= 3 AND CASE WHEN duration > 0 THEN secs / duration ELSE 0 END >= 0.1::DOUBLE THEN 'ok' ELSE 'insufficient_evidence' END AS analysis_status FROM j""")
def _(v):
    out = soundtrack.soundtrack_record(v("durations"), v("segments"))
    return out.select(*GROUP, "transcript_status", "non_speech_seconds", "n_windows", "non_speech_coverage", "analysis_status")


DOC_WINDOWS_SQL = clipped_sql("doc_segments", "doc_audio") + "," + islands_sql(
    "clipped", "greatest(s - 0.001::DOUBLE, 0)", "least(e + 0.001::DOUBLE, duration)", "0", "islands"
) + "," + windows_sql("windows", "islands", "doc_audio")


def doc_windows(v):
    return iv.non_speech_windows(v("doc_segments"), v("doc_audio"), 0.001)


@query("J7_samples_in_windows", f"""
WITH {DOC_WINDOWS_SQL}, w AS (SELECT w.account, w.aweme_id, CAST(round_even(start * 16000, 0) AS BIGINT) AS lo, least(CAST(round_even("end" * 16000, 0) AS BIGINT), d.samples) AS hi
  FROM windows w JOIN doc_audio d ON d.account = w.account AND d.aweme_id = w.aweme_id)
SELECT account, aweme_id, CAST(sum(hi - lo) AS BIGINT) AS samples, CAST(sum(hi - lo) AS BIGINT) AS reach FROM w WHERE hi > lo GROUP BY 1, 2""")
def _(v):
    pieces = soundtrack.window_pieces(v.audio(), doc_windows(v), block_samples=4096)
    n = F.octet_length("pcm") / 2
    return pieces.groupBy(*GROUP).agg(F.sum(n).cast("bigint").alias("samples"), F.max(F.col("at") + n).cast("bigint").alias("reach"))


def whole_audio(v):
    """All samples of each document as one window from the start."""
    return v("doc_audio").select(*GROUP, F.lit(0.0).alias("start"), F.col("duration").alias("end"))


def audio_sums(v, windows):
    pieces = soundtrack.window_pieces(v.audio(), windows, block_samples=4096)
    return soundtrack.audio_block_sums(soundtrack.reblock(pieces))


@query("V6_audio_energy", """
WITH b AS (SELECT doc_id, regexp_extract_all(hex(encode(text)), '....') AS h FROM documents),
s AS (SELECT doc_id, unnest(h) AS x, generate_subscripts(h, 1) - 1 AS pos, len(h) AS n FROM b),
i AS (SELECT doc_id, pos, n, CAST(concat('0x', substr(x, 3, 2), substr(x, 1, 2)) AS BIGINT) AS u FROM s),
q AS (SELECT doc_id, pos, n, (CASE WHEN u >= 32768 THEN u - 65536 ELSE u END) * (CASE WHEN u >= 32768 THEN u - 65536 ELSE u END) AS sq FROM i),
f AS (SELECT doc_id, pos, n, CAST(sum(sq) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 399 FOLLOWING) AS BIGINT) AS power FROM q),
r AS (SELECT doc_id, power::DOUBLE / 400 / 1073741824 AS m FROM f WHERE pos % 160 = 0 AND pos + 400 <= n)
SELECT CAST(doc_id AS VARCHAR) AS aweme_id, count(*) AS frames, CAST(round_even(avg(sqrt(m)), 4) AS DOUBLE) AS energy,
  CAST(round_even(sqrt(greatest(avg(m) - avg(sqrt(m)) * avg(sqrt(m)), 0)), 4) AS DOUBLE) AS energy_var,
  CAST(round_even(count(*) FILTER (sqrt(m) < 0.01)::DOUBLE / count(*), 3) AS DOUBLE) AS silence FROM r GROUP BY doc_id""")
def _(v):
    sums = stage(audio_sums(v, whole_audio(v)), "audio")
    out = soundtrack.audio_features(sums).join(sums.groupBy(*GROUP).agg(F.sum("frames").alias("frames")), GROUP)
    return out.filter("frames > 0").select(
        "aweme_id", "frames", F.bround("energy", 4).alias("energy"), F.bround("energy_var", 4).alias("energy_var"),
        F.bround("silence", 3).alias("silence"))


@query("V7_low_freq_ratio")
def _(v):
    return soundtrack.audio_features(audio_sums(v, doc_windows(v))).select(*GROUP, F.bround("lfe_ratio", 3).alias("lfe_ratio"))


@query("V8_classify_soundtrack", """
WITH f AS (SELECT event_id, value / 250 AS e, (event_id % 40)::DOUBLE / 200 AS v, (event_id % 71)::DOUBLE / 100 AS l FROM events)
SELECT event_id, CASE WHEN l >= 0.55::DOUBLE THEN CASE WHEN e >= 0.18::DOUBLE THEN 'full' ELSE 'light' END
  WHEN l >= 0.35::DOUBLE THEN CASE WHEN e < 0.25::DOUBLE THEN 'light' ELSE 'full' END
  WHEN e >= 0.12::DOUBLE AND v < 0.15::DOUBLE THEN 'light' ELSE 'none' END AS bgm_level,
  CASE WHEN e >= 0.32::DOUBLE THEN CASE WHEN v < 0.12::DOUBLE THEN '强节奏/重鼓点' ELSE '明快节奏' END WHEN e <= 0.1::DOUBLE THEN '平静铺垫'
  WHEN v >= 0.1::DOUBLE THEN '叙事起伏' ELSE '明快节奏' END AS mood FROM f""")
def _(v):
    f = v.table("events").select(
        "event_id", (F.col("value") / 250).alias("energy"), ((F.col("event_id") % 40).cast("double") / 200).alias("energy_var"),
        F.lit(0.0).alias("silence"), ((F.col("event_id") % 71).cast("double") / 100).alias("lfe_ratio"))
    return soundtrack.classify_soundtrack(f).select("event_id", "bgm_level", "mood")


@query("V9_soundtrack_from_audio")
def _(v):
    sums = stage(audio_sums(v, doc_windows(v)), "audio")
    features = soundtrack.classify_soundtrack(soundtrack.audio_features(sums))
    out = soundtrack.soundtrack_record(v("doc_audio").drop("samples"), v("doc_segments"), features, min_seconds=0.3, pad=0.001)
    return out.select(*GROUP, "non_speech_seconds", "analysis_status", "bgm_level", "mood", "energy", "lfe_ratio")


# ---- frames -----------------------------------------------------------------------------------


@query("V1_image_features")
def _(v):
    return fr.image_features(v.images(), keep=("account", "aweme_id", "idx"))


@query("V2_visual_labels", """
WITH f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, (l_partkey % 100)::DOUBLE / 100 AS x, (l_suppkey % 97)::DOUBLE / 97 AS y, l_quantity * 5 AS mv, (l_partkey % 251)::DOUBLE AS ms,
  (l_suppkey % 13)::DOUBLE + 100 AS r, l_quantity + 80 AS b, l_tax * 1000 AS c, l_discount * 3 AS blue FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
  CASE WHEN abs(x - 0.5::DOUBLE) < 0.12::DOUBLE AND abs(y - 0.5::DOUBLE) < 0.12::DOUBLE THEN 'centered'
    WHEN least(abs(x - 1::DOUBLE / 3), abs(x - 2::DOUBLE / 3), abs(y - 1::DOUBLE / 3), abs(y - 2::DOUBLE / 3)) < 0.1::DOUBLE THEN 'rule_of_thirds' ELSE 'asymmetric' END AS composition,
  CASE WHEN r > b * 1.08::DOUBLE THEN 'warm' WHEN b > r * 1.08::DOUBLE THEN 'cool' ELSE 'neutral' END AS temperature,
  concat(CASE WHEN mv > 175 AND c < 65 THEN 'high_key' WHEN mv < 90 THEN 'low_key' ELSE 'balanced' END, CASE WHEN ms > 125 THEN '_vivid' WHEN ms < 55 THEN '_muted' ELSE '' END) AS visual_style,
  CASE WHEN blue > 0.16::DOUBLE AND mv > 105 THEN 'outdoor_candidate' ELSE 'indoor_or_closeup_candidate' END AS scene FROM f""")
def _(v):
    li = v.table("lineitem")
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    f = li.select(
        *keys, ((F.col("l_partkey") % 100).cast("double") / 100).alias("center_x"), ((F.col("l_suppkey") % 97).cast("double") / 97).alias("center_y"),
        (F.col("l_quantity") * 5).alias("mean_v"), (F.col("l_partkey") % 251).cast("double").alias("mean_s"),
        ((F.col("l_suppkey") % 13).cast("double") + 100).alias("mean_r"), (F.col("l_quantity") + 80).alias("mean_b"),
        (F.col("l_tax") * 1000).alias("contrast"), (F.col("l_discount") * 3).alias("blue_top"))
    return fr.visual_labels(f).select(*keys, "composition", "temperature", "visual_style", "scene")


@query("V2_image_labels")
def _(v):
    found = fr.visual_labels(fr.image_features(v.images(), keep=("account", "aweme_id", "idx")))
    return found.select("account", "aweme_id", "idx", "composition", "temperature", "visual_style", "scene", "scene_confidence")


@query("V3_subtitle_features", """
WITH g AS (SELECT account, aweme_id, frame, count(*) AS n, CAST(sum(y * 2 + h) AS BIGINT) AS y2, CAST(sum(w * h) AS BIGINT) AS area, string_agg(trim(text), ' ' ORDER BY box_no) AS ocr_text
  FROM boxes WHERE conf >= 20 GROUP BY 1, 2, 3)
SELECT f.account, f.aweme_id, f.frame, n IS NOT NULL AS present, CASE WHEN n IS NULL THEN 'unknown' WHEN y2::DOUBLE / 2 / n / height < 0.35::DOUBLE THEN 'top'
  WHEN y2::DOUBLE / 2 / n / height > 0.65::DOUBLE THEN 'bottom' ELSE 'middle' END AS region,
  CAST(round_even(coalesce(area::DOUBLE / (width * height), 0), 3) AS DOUBLE) AS coverage, coalesce(ocr_text, '') AS ocr_text
FROM box_frames f LEFT JOIN g ON g.account = f.account AND g.aweme_id = f.aweme_id AND g.frame = f.frame""")
def _(v):
    return fr.subtitle_features(v("boxes"), v("box_frames"), keys=("account", "aweme_id", "frame"))


@query("V4_product_candidate", """
SELECT page_id, (page_id % 25)::DOUBLE / 100 > 0.12::DOUBLE OR contains(lower(html), '¥') OR contains(lower(html), '元') OR contains(lower(html), 'ml')
  OR contains(lower(html), 'kg') AS candidate FROM (SELECT page_id, regexp_replace(html, '[hH][tT][mM][lL]', '', 'g') AS html FROM pages)""")
def _(v):
    rows = v.table("pages").select(
        "page_id", ((F.col("page_id") % 25).cast("double") / 100).alias("center_saliency"),
        F.regexp_replace("html", "[hH][tT][mM][lL]", "").alias("ocr_text"))
    return rows.select("page_id", fr.product_candidate().alias("candidate"))


PROXY = ("account", "aweme_id", "idx", "timestamp")


@query("V5_frame_proxy_features", """
WITH b AS (SELECT page_id, regexp_extract_all(hex(encode(html)), '..') AS h FROM pages),
s AS (SELECT page_id, CAST(concat('0x', unnest(h)) AS INTEGER) AS x, generate_subscripts(h, 1) - 1 AS pos FROM b),
n AS (SELECT page_id, x, pos, coalesce(lead(x) OVER (PARTITION BY page_id ORDER BY pos), 0) AS nx FROM s),
e AS (SELECT page_id, x, nx, pos, unnest(range(greatest(0, pos - 2303 + 255) // 256, pos // 256 + 1)) AS idx FROM n),
p AS (SELECT page_id, idx, x, nx, (pos - 256 * idx) // 64 AS r, (pos - 256 * idx) % 64 AS c FROM e WHERE pos - 256 * idx < 2304 AND pos >= 256 * idx),
g AS (SELECT page_id, idx, sum(x)::DOUBLE / 2304 AS bright, sum(CASE WHEN c < 63 THEN nx - x ELSE 0 END)::DOUBLE / 2268 AS d1,
  sum(CASE WHEN c < 63 THEN (nx - x) * (nx - x) ELSE 0 END)::DOUBLE / 2268 AS d2, count(*) FILTER (x // 8 = 12) AS bin12, 2304 - count(*) + count(*) FILTER (x < 8) AS bin0,
  sum(CASE WHEN r % 5 = 0 AND c % 9 = 0 THEN x ELSE 0 END) AS sm FROM p GROUP BY 1, 2),
k AS (SELECT p.page_id, p.idx, count(*) FILTER (r % 5 = 0 AND c % 9 = 0 AND x * 64 >= sm) AS bits FROM p JOIN g ON g.page_id = p.page_id AND g.idx = p.idx GROUP BY 1, 2)
SELECT CAST(g.page_id AS VARCHAR) AS aweme_id, g.idx, CAST(round_even(bright, 2) AS DOUBLE) AS brightness, CAST(round_even(d2 - d1 * d1, 2) AS DOUBLE) AS sharpness,
  bin0, bin12, CAST(bits AS INTEGER) AS bits FROM g JOIN k ON k.page_id = g.page_id AND k.idx = g.idx""")
def _(v):
    out = fr.frame_proxy_features(v.proxies(), keep=PROXY)
    count = lambda i: F.round(F.col("hist")[i] * 18432).cast("bigint")
    return out.select("aweme_id", "idx", "brightness", "sharpness", count(0).alias("bin0"), count(12).alias("bin12"), F.bit_count("phash").alias("bits"))


@query("W6_scene_score", """
WITH l AS (SELECT account, aweme_id, idx, hist, lag(hist) OVER (PARTITION BY account, aweme_id ORDER BY idx) AS prev FROM hist_frames)
SELECT account, aweme_id, idx, CAST(round_even(coalesce(list_sum(list_transform(list_zip(hist, prev), lambda p: abs(p[1] - p[2]))) / 2, 0), 4) AS DOUBLE) AS scene_score FROM l""")
def _(v):
    return fr.scene_score(v("hist_frames")).select(*GROUP, "idx", F.bround("scene_score", 4).alias("scene_score"))


REASONS_SQL = """
marks AS (SELECT s.*, idx % least(12, greatest(frames // 12, 1)) = 0 AS base, timestamp < 3 AND idx % 4 = 0 AS intro,
  EXISTS (SELECT 1 FROM reviews r WHERE r.account = s.account AND r.aweme_id = s.aweme_id AND r.start <= s.timestamp AND s.timestamp <= r."end") AND idx % 2 = 0 AS review,
  scene_score >= 0.7::DOUBLE AS scene FROM shots s),
reasons AS (SELECT account, aweme_id, idx, CAST(round_even(timestamp, 3) AS DOUBLE) AS timestamp, CAST(round_even(scene_score, 4) AS DOUBLE) AS scene_score,
  CASE WHEN scene AND NOT (base OR intro OR review) THEN 'scene' WHEN review THEN 'review' WHEN intro AND NOT base THEN 'intro' ELSE 'base' END AS reason
  FROM marks WHERE base OR intro OR review OR scene)"""


@query("W9_sampling_reasons", f"WITH {REASONS_SQL} SELECT * FROM reasons")
def _(v):
    out = fr.sampling_reasons(v("shots"), v("reviews"), scene_min=0.7)
    return out.select(*GROUP, "idx", "timestamp", "scene_score", "reason")


@query("W11_cap_frames", f"""
WITH {REASONS_SQL}, a AS (SELECT *, count(*) OVER g AS total, row_number() OVER (PARTITION BY account, aweme_id, reason ORDER BY scene_score DESC, idx) AS sr FROM reasons WINDOW g AS (PARTITION BY account, aweme_id)),
c AS (SELECT *, reason = 'intro' OR (reason = 'scene' AND sr <= 5) AS chosen FROM a),
n AS (SELECT *, count(*) FILTER (NOT chosen) OVER g AS m, least(20 - count(*) FILTER (chosen) OVER g, count(*) FILTER (NOT chosen) OVER g) AS k,
  row_number() OVER (PARTITION BY account, aweme_id, chosen ORDER BY idx) - 1 AS i FROM c WINDOW g AS (PARTITION BY account, aweme_id)),
p AS (SELECT account, aweme_id, CASE WHEN j = k - 1 AND k > 1 THEN m - 1 ELSE CAST(floor(j * ((m - 1)::DOUBLE / greatest(k - 1, 1))) AS BIGINT) END AS i FROM (SELECT DISTINCT account, aweme_id, m, k, unnest(range(0, greatest(k, 0))) AS j FROM n)),
kept AS (SELECT n.* FROM n WHERE total <= 20 OR chosen OR EXISTS (SELECT 1 FROM p WHERE p.account = n.account AND p.aweme_id = n.aweme_id AND p.i = n.i))
SELECT account, aweme_id, idx, reason FROM (SELECT *, row_number() OVER (PARTITION BY account, aweme_id ORDER BY idx) AS z FROM kept) WHERE z <= 20""")
def _(v):
    picked = fr.sampling_reasons(v("shots"), v("reviews"), scene_min=0.7)
    return fr.cap_frames(picked, 20).select(*GROUP, "idx", "reason")


@query("D5_dedup_frames")
def _(v):
    """Proxies of the pages, scored, sampled and deduplicated."""
    features = stage(fr.frame_proxy_features(v.proxies(), keep=PROXY), "features")
    scored = fr.scene_score(features)
    counts = features.groupBy(*GROUP).agg((F.max("idx") + 1).alias("frames"))
    sampled = fr.sampling_reasons(scored.join(counts, GROUP).withColumn("rate", F.lit(4)), scene_min=0.05)
    return fr.dedup_frames(sampled.drop("brightness", "sharpness")).select(*GROUP, "idx", "timestamp", "reason", "scene_score")


FILES_SQL = "files AS (SELECT account, aweme_id, file, row_number() OVER (PARTITION BY account, aweme_id ORDER BY file) - 1 AS i, count(*) OVER (PARTITION BY account, aweme_id) AS n FROM frame_rows)"


@query("W12_key_frames", f"""
WITH {FILES_SQL} SELECT account, aweme_id, file, CAST(i AS INTEGER) AS pos FROM files WHERE i < 5 OR i = n // 3 OR i = n * 2 // 3 OR i = n - 1""")
def _(v):
    return fr.key_frames(v("frame_rows").select(*GROUP, "file"))


@query("W13_median_frame", f"WITH {FILES_SQL} SELECT account, aweme_id, file FROM files WHERE i = n // 2")
def _(v):
    return fr.median_frame(v("frame_rows").select(*GROUP, "file"))


@query("V10_import_note_images", f"""
WITH {FILES_SQL} SELECT account, aweme_id, i AS idx, concat(lpad(CAST(i + 1 AS VARCHAR), 4, '0'), '.jpg') AS file, 'note_image' AS reason FROM files
UNION ALL SELECT account, aweme_id, idx, NULL, 'base' FROM shots""")
def _(v):
    other = v("shots").select(*GROUP, "idx", F.lit("base").alias("reason"))
    out = fr.import_note_images(v("frame_rows").select(*GROUP, "file"), other)
    return out.select(*GROUP, F.col("idx").cast("bigint").alias("idx"), "file", "reason")


# ---- visual -----------------------------------------------------------------------------------


def _mode_sql(column: str, where: str = "true") -> str:
    return f"""SELECT account, aweme_id, {column} AS v FROM (SELECT account, aweme_id, {column}, row_number() OVER (PARTITION BY account, aweme_id ORDER BY count(*) DESC, min(seq)) AS i
  FROM frame_rows WHERE {where} GROUP BY account, aweme_id, {column}) WHERE i = 1"""


SUMMARY_SQL = f"""
m1 AS ({_mode_sql('visual_style')}), m2 AS ({_mode_sql('temperature')}), m3 AS ({_mode_sql('composition')}), m4 AS ({_mode_sql('scene')}), m5 AS ({_mode_sql('region', 'subtitle_present')}),
summary AS (SELECT b.*, m1.v AS visual_style, m2.v AS temperature, m3.v AS composition, m4.v AS scene, coalesce(m5.v, 'unknown') AS subtitle_region FROM (
  SELECT account, aweme_id, count(*) AS frames_analyzed, CAST(round_even(avg(mean_h), 3) AS DOUBLE) AS mean_h, CAST(round_even(avg(mean_s), 3) AS DOUBLE) AS mean_s, CAST(round_even(avg(mean_v), 3) AS DOUBLE) AS mean_v,
    CAST(round_even(count(*) FILTER (subtitle_present)::DOUBLE / count(*), 3) AS DOUBLE) AS subtitle_ratio, CAST(round_even(count(*) FILTER (product_candidate)::DOUBLE / count(*), 3) AS DOUBLE) AS product_ratio,
    coalesce(string_agg(CAST(CAST(timestamp AS BIGINT) AS VARCHAR), ',' ORDER BY seq) FILTER (product_candidate), '') AS candidates FROM frame_rows GROUP BY 1, 2) b
  JOIN m1 ON m1.account = b.account AND m1.aweme_id = b.aweme_id JOIN m2 ON m2.account = b.account AND m2.aweme_id = b.aweme_id
  JOIN m3 ON m3.account = b.account AND m3.aweme_id = b.aweme_id JOIN m4 ON m4.account = b.account AND m4.aweme_id = b.aweme_id
  LEFT JOIN m5 ON m5.account = b.account AND m5.aweme_id = b.aweme_id)"""
MATCHED_SQL = SUMMARY_SQL + """,
matched AS (SELECT s.*, p.likes, p.seq AS post_seq FROM summary s JOIN posts p ON p.account = s.account AND p.aweme_id = s.aweme_id)"""
TIERS_SQL = MATCHED_SQL + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY likes DESC, post_seq) AS place, count(*) OVER (PARTITION BY account) AS n FROM matched),
tiered AS (SELECT *, CASE WHEN place <= greatest(5, ceil(n * 0.2::DOUBLE)) THEN 'top' ELSE 'rest' END AS tier FROM ranked WHERE n - greatest(5, ceil(n * 0.2::DOUBLE)) >= 5)"""


def matched(v):
    return vi.visual_with_posts(vi.visual_summary(v("frame_rows")), v("posts"))


@query("A22_visual_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def _(v):
    out = vi.visual_summary(v("frame_rows"))
    candidates = F.array_join(F.transform("candidate_timestamps", lambda t: t.cast("bigint").cast("string")), ",")
    return out.select(
        *GROUP, "frames_analyzed", "mean_h", "mean_s", "mean_v", "subtitle_ratio", "product_ratio", candidates.alias("candidates"),
        "visual_style", "temperature", "composition", "scene", "subtitle_region")


@query("J10_visual_with_posts", f"WITH {MATCHED_SQL} SELECT account, aweme_id, visual_style, likes FROM matched")
def _(v):
    return matched(v).select(*GROUP, "visual_style", "likes")


@query("J10_visual_match_counts", """
SELECT p.account, count(f.aweme_id) AS matched, count(*) FILTER (f.aweme_id IS NULL) AS unmatched FROM posts p
LEFT JOIN (SELECT DISTINCT account, aweme_id FROM frame_rows) f ON f.account = p.account AND f.aweme_id = p.aweme_id GROUP BY 1""")
def _(v):
    return vi.visual_match_counts(v("frame_rows").select(*GROUP).distinct(), v("posts"))


@query("U5_visual_intersection", "SELECT account, aweme_id FROM labelled INTERSECT SELECT account, aweme_id FROM posts")
def _(v):
    return vi.visual_intersection(v("labelled"), v("posts"))


@query("A23_visual_distribution", f"""
WITH {MATCHED_SQL}, l AS (SELECT account, 'visual_style' AS dimension, visual_style AS value FROM matched UNION ALL SELECT account, 'temperature', temperature FROM matched
  UNION ALL SELECT account, 'composition', composition FROM matched UNION ALL SELECT account, 'scene', scene FROM matched)
SELECT account, dimension, value, count(*) AS n, (count(*) * 100)::DOUBLE / sum(count(*)) OVER (PARTITION BY account, dimension)::DOUBLE AS share_pct,
  CASE WHEN dimension = 'temperature' AND value = 'warm' THEN 'warm tones' ELSE value END AS label FROM l GROUP BY 1, 2, 3""")
def _(v):
    return vi.visual_distribution(matched(v), {"temperature": {"warm": "warm tones"}})


PRODUCTS_SQL = f"""
WITH {MATCHED_SQL} SELECT account, count(*) AS n, count(*) FILTER (product_ratio > 0) AS with_candidate,
  CAST(sum(CAST(product_ratio AS DECIMAL(20,6))) AS DOUBLE) / count(*) AS mean_candidate_ratio FROM matched GROUP BY 1"""


@query("A23_product_exposure", PRODUCTS_SQL)
def _(v):
    return vi.product_exposure(matched(v))


TOP_LOOKS_SQL = f"""
WITH {TIERS_SQL}, l AS (SELECT account, tier, place, 'visual_style' AS dimension, visual_style AS value FROM tiered UNION ALL SELECT account, tier, place, 'temperature', temperature FROM tiered
  UNION ALL SELECT account, tier, place, 'composition', composition FROM tiered UNION ALL SELECT account, tier, place, 'scene', scene FROM tiered),
c AS (SELECT account, tier, dimension, value, count(*) AS k, CAST(sum(count(*)) OVER (PARTITION BY account, tier, dimension) AS BIGINT) AS n,
  row_number() OVER (PARTITION BY account, tier, dimension ORDER BY count(*) DESC, min(place)) AS i FROM l GROUP BY 1, 2, 3, 4)
SELECT account, tier, dimension, value, n, CAST(round_even((k * 100)::DOUBLE / n, 1) AS DOUBLE) AS share_pct FROM c WHERE i = 1"""


@query("A24_top_vs_rest_visual", TOP_LOOKS_SQL)
def _(v):
    return vi.top_vs_rest_visual(matched(v))


TOP_PRODUCTS_SQL = f"""
WITH {TIERS_SQL} SELECT account, tier, count(*) AS n, CAST(round_even((count(*) FILTER (product_ratio > 0) * 100)::DOUBLE / count(*), 1) AS DOUBLE) AS with_candidate_pct,
  CAST(round_even(CAST(sum(CAST(product_ratio AS DECIMAL(20,6))) AS DOUBLE) * 100 / count(*), 1) AS DOUBLE) AS mean_candidate_pct FROM tiered GROUP BY 1, 2"""


@query("A24_top_vs_rest_product", TOP_PRODUCTS_SQL)
def _(v):
    return vi.top_vs_rest_product(matched(v))


