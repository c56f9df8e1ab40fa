"""Account statistics, cadence, topics, text functions and tags over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators import cadence, stats, tags, topics
from clipstat.plans.registry import query
from clipstat.skew import exact_quantiles, middle, mode_of

TITLE_RULES = (("urgent", ("1-URGENT",)), ("low", ("LOW", "MEDIUM")), ("tagged", ("#t1", "#t2")))
THEME_SQL = """CASE WHEN contains(title, '1-URGENT') THEN 'urgent' WHEN contains(title, 'LOW') OR contains(title, 'MEDIUM') THEN 'low'
  WHEN contains(title, '#t1') OR contains(title, '#t2') THEN 'tagged' ELSE 'other' END"""
TALK_RULES = (("tion", "tion"), ("la", " la "), ("ung", "ung"), ("zz", "zzzz"), ("the", "[Tt]he"))
TALK_SQL = """CASE WHEN contains(content, 'tion') THEN 'tion' WHEN contains(content, ' la ') THEN 'la' WHEN contains(content, 'ung') THEN 'ung'
  WHEN contains(content, 'zzzz') THEN 'zz' WHEN regexp_matches(content, '[Tt]he') THEN 'the' END"""

TOTALS_SQL = """
totals AS (SELECT account, count(*) AS n, CAST(sum(likes) AS BIGINT) AS sum_likes, CAST(sum(comments) AS BIGINT) AS sum_comments,
  CAST(sum(collects) AS BIGINT) AS sum_collects, CAST(sum(shares) AS BIGINT) AS sum_shares, max(likes) AS max_likes FROM posts GROUP BY account)"""


@query("A1_engagement_totals", f"""
WITH {TOTALS_SQL} SELECT *, sum_likes::DOUBLE / n AS mean_likes, sum_comments::DOUBLE / n AS mean_comments,
  sum_collects::DOUBLE / n AS mean_collects, sum_shares::DOUBLE / n AS mean_shares FROM totals""")
def _(v):
    return stats.engagement_totals(v("posts"))


RATES_SQL = """
rates AS (SELECT account, CASE WHEN sum_likes = 0 THEN 0 ELSE (sum_collects * 100)::DOUBLE / sum_likes END AS collect_rate,
  CASE WHEN sum_likes = 0 THEN 0 ELSE (sum_comments * 100)::DOUBLE / sum_likes END AS comment_rate FROM totals)"""


@query("A2_engagement_rates", f"""
WITH {TOTALS_SQL}, {RATES_SQL}
SELECT *, CASE WHEN collect_rate > comment_rate THEN 'collect_led' ELSE 'comment_led' END AS audience FROM rates""")
def _(v):
    out = stats.engagement_rates(stats.engagement_totals(v("posts")))
    return out.select("account", "collect_rate", "comment_rate", "audience")


PCT_SQL = """
pctrows AS (SELECT account, likes, row_number() OVER (PARTITION BY account ORDER BY likes, seq) - 1 AS i, count(*) OVER (PARTITION BY account) AS n FROM posts),
pct AS (SELECT account, max(likes) FILTER (i = CAST(round_even(50::DOUBLE / 100::DOUBLE * (n - 1), 0) AS BIGINT)) AS p50,
  max(likes) FILTER (i = CAST(round_even(90::DOUBLE / 100::DOUBLE * (n - 1), 0) AS BIGINT)) AS p90 FROM pctrows GROUP BY account)"""


@query("A3_nearest_rank_percentile", f"WITH {PCT_SQL} SELECT * FROM pct")
def _(v):
    return stats.nearest_rank_percentile(v("posts"))


@query("A4_median", "SELECT account, median(likes) AS median FROM posts GROUP BY account")
def _(v):
    return stats.medians(v("posts")).select("account", "median")


@query("A6_upper_median", f"WITH {PCT_SQL} SELECT account, max(likes) FILTER (i = n // 2) AS upper_median FROM pctrows GROUP BY account")
def _(v):
    return stats.medians(v("posts")).select("account", "upper_median")


RATIOS_SQL = """coalesce(CAST(round_even(median(collects::DOUBLE / likes) FILTER (likes > 0), 3) AS DOUBLE), 0) AS collects_per_like_median,
  coalesce(CAST(round_even(median(shares::DOUBLE / likes) FILTER (likes > 0), 3) AS DOUBLE), 0) AS shares_per_like_median,
  coalesce(CAST(round_even(median(comments::DOUBLE / likes) FILTER (likes > 0), 3) AS DOUBLE), 0) AS comments_per_like_median"""


@query("A7_ratio_medians", f"SELECT account, {RATIOS_SQL} FROM posts GROUP BY account")
def _(v):
    return stats.ratio_medians(v("posts"))


@query("A8_top_share", """
SELECT account, CASE WHEN sum(likes) = 0 THEN 0 ELSE CAST(round_even(max(likes)::DOUBLE / sum(likes)::DOUBLE * 100, 0) AS INTEGER) END AS top_share_pct
FROM posts GROUP BY account""")
def _(v):
    return stats.top_share(v("posts"))


@query("A13_likes_histogram", """
WITH b AS (SELECT * FROM (VALUES (0, '<100'), (1, '100-1k'), (2, '1k-10k'), (3, '10k-100k'), (4, '100k+')) t(bin, label)),
p AS (SELECT account, CASE WHEN likes - 1000 >= 100000 THEN 4 WHEN likes - 1000 >= 10000 THEN 3 WHEN likes - 1000 >= 1000 THEN 2 WHEN likes - 1000 >= 100 THEN 1 ELSE 0 END AS bin,
  likes - 1000 < 0 AS neg FROM posts)
SELECT a.account, b.bin, b.label, count(p.bin) AS n, count(*) FILTER (p.neg) AS n_negative
FROM (SELECT DISTINCT account FROM posts) a CROSS JOIN b LEFT JOIN p ON p.account = a.account AND p.bin = b.bin GROUP BY 1, 2, 3""")
def _(v):
    return stats.likes_histogram(v("posts").withColumn("likes", F.col("likes") - 1000))


DAYS_SQL = """
dated AS (SELECT account, aweme_id, seq, likes, make_timestamp(create_time * 1000000) AS t, CAST(make_timestamp(create_time * 1000000) AS DATE) AS day
  FROM posts WHERE create_time IS NOT NULL),
gaps AS (SELECT account, aweme_id, day, date_diff('day', lag(day) OVER (PARTITION BY account ORDER BY day, seq), day) AS gap FROM dated),
gapmid AS (SELECT account, max(gap) FILTER (i = n // 2) AS gap_median FROM (SELECT account, gap, row_number() OVER (PARTITION BY account ORDER BY gap) - 1 AS i,
  count(*) OVER (PARTITION BY account) AS n FROM gaps WHERE gap IS NOT NULL) GROUP BY account),
months AS (SELECT account, strftime(day, '%Y-%m') AS month, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes FROM dated GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, month) AS place FROM months)"""


@query("W5_publish_gaps", f"WITH {DAYS_SQL} SELECT account, aweme_id, day, CAST(gap AS INTEGER) AS gap_days FROM gaps")
def _(v):
    return cadence.publish_gaps(v("posts"))


@query("A6_upper_median_gap", f"WITH {DAYS_SQL} SELECT account, CAST(gap_median AS INTEGER) AS gap_median FROM gapmid")
def _(v):
    return cadence.upper_median_gap(v("posts"))


@query("T9_top_months", f"WITH {DAYS_SQL} SELECT account, month, n, CAST(place AS INTEGER) AS place FROM placed WHERE place <= 3")
def _(v):
    return cadence.top_months(v("posts"))


@query("A9_publish_cadence", f"""
WITH {DAYS_SQL}, base AS (SELECT account, min(day) AS first_day, max(day) AS last_day, count(*) AS n, count(DISTINCT strftime(day, '%Y-%m')) AS m FROM dated GROUP BY account),
tops AS (SELECT account, string_agg(concat(month, ':', CAST(n AS VARCHAR)), ',' ORDER BY place) AS top_months FROM placed WHERE place <= 3 GROUP BY account)
SELECT b.account, first_day, last_day, CAST(CASE WHEN n >= 2 THEN date_diff('day', first_day, last_day) + 1 ELSE 0 END AS INTEGER) AS span_days,
  CAST(round_even(n::DOUBLE / greatest(m, 1), 1) AS DOUBLE) AS monthly_avg, m AS active_months, top_months, CAST(gap_median AS INTEGER) AS gap_median
FROM base b LEFT JOIN tops t ON t.account = b.account LEFT JOIN gapmid g ON g.account = b.account""")
def _(v):
    return cadence.publish_cadence(v("posts"))


@query("A10_posts_by_unit", f"""
WITH {DAYS_SQL} SELECT account, 'year' AS unit, CAST(year(t) AS INTEGER) AS value, count(*) AS n FROM dated GROUP BY 1, 3
UNION ALL SELECT account, 'hour', CAST(hour(t) AS INTEGER) AS value, count(*) FROM dated GROUP BY account, value
UNION ALL SELECT account, 'weekday', CAST(isodow(t) - 1 AS INTEGER) AS value, count(*) FROM dated GROUP BY account, value""")
def _(v):
    return cadence.posts_by_unit(v("posts")).select("account", "unit", "value", "n")


PEAKS_SQL = f"""
WITH {DAYS_SQL}, h AS (SELECT account, CAST(hour(t) AS INTEGER) AS u, count(*) AS n, min(struct_pack(a := t, b := seq)) AS f FROM dated GROUP BY 1, 2),
w AS (SELECT account, CAST(isodow(t) - 1 AS INTEGER) AS u, count(*) AS n, min(struct_pack(a := t, b := seq)) AS f FROM dated GROUP BY 1, 2),
h1 AS (SELECT account, u, n, row_number() OVER (PARTITION BY account ORDER BY n DESC, f) AS i FROM h),
w1 AS (SELECT account, u, n, row_number() OVER (PARTITION BY account ORDER BY n DESC, f) AS i, row_number() OVER (PARTITION BY account ORDER BY n, f) AS j FROM w)
SELECT h1.account, h1.u AS peak_hour, a.u AS peak_weekday, b.u AS low_weekday, h1.n AS peak_hour_n, a.n AS peak_weekday_n, b.n AS low_weekday_n
FROM h1 JOIN w1 a ON a.account = h1.account AND a.i = 1 JOIN w1 b ON b.account = h1.account AND b.j = 1 WHERE h1.i = 1"""


@query("A11_peaks", PEAKS_SQL)
def _(v):
    return cadence.peaks(v("posts"))


@query("A12_month_trend", f"""
WITH {DAYS_SQL}, t AS (SELECT *, count(*) OVER (PARTITION BY account) AS ms, CAST(sum(likes) OVER (PARTITION BY account) AS BIGINT) AS all_likes FROM months)
SELECT account, month, n, likes::DOUBLE / n AS mean_likes,
  CASE WHEN all_likes = 0 THEN 0 ELSE least(likes::DOUBLE / n / (all_likes::DOUBLE / ms * 3), 1) END AS scaled FROM t WHERE ms >= 2""")
def _(v):
    return cadence.month_trend(v("posts"))


@query("A33_years_active", f"WITH {DAYS_SQL} SELECT account, floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365::DOUBLE AS years FROM dated GROUP BY account")
def _(v):
    return cadence.years_active(v("posts"))


@query("G6_idle_periods", f"""
WITH {DAYS_SQL}, d AS (SELECT account, day AS to_day, lag(day) OVER (PARTITION BY account ORDER BY day) AS from_day FROM (SELECT DISTINCT account, day FROM dated))
SELECT account, from_day, to_day, CAST(date_diff('day', from_day, to_day) AS INTEGER) AS days FROM d WHERE date_diff('day', from_day, to_day) >= 20""")
def _(v):
    return cadence.idle_periods(v("posts"), 20)


THEMES_SQL = f"""
t AS (SELECT account, {THEME_SQL} AS theme, count(*) AS n, CAST(sum(likes) AS BIGINT) AS l, CAST(sum(comments) AS BIGINT) AS c, CAST(sum(collects) AS BIGINT) AS k FROM posts GROUP BY 1, 2),
o AS (SELECT *, CAST(sum(n) OVER (PARTITION BY account) AS BIGINT) AS an, CAST(sum(l) OVER (PARTITION BY account) AS BIGINT) AS al FROM t)"""


@query("A14_theme_stats", f"""
WITH {THEMES_SQL} SELECT account, theme, n, (n * 100)::DOUBLE / an AS share_pct, l::DOUBLE / n AS mean_likes, c::DOUBLE / n AS mean_comments,
  k::DOUBLE / n AS mean_collects, l::DOUBLE / n > al::DOUBLE / an * 2 AS hot FROM o""")
def _(v):
    return topics.theme_stats(v("posts"), TITLE_RULES)


@query("X7_classify_theme", f"SELECT account, aweme_id, {THEME_SQL} AS theme FROM posts")
def _(v):
    return topics.classify_theme(v("posts"), TITLE_RULES).select("account", "aweme_id", "theme")


@query("W10_first_per_theme", f"""
SELECT account, theme, aweme_id, likes FROM (SELECT account, theme, aweme_id, likes, row_number() OVER (PARTITION BY account, theme ORDER BY likes DESC, seq) AS i
  FROM (SELECT p.*, {THEME_SQL} AS theme FROM posts p WHERE EXISTS (SELECT 1 FROM frame_rows f WHERE f.account = p.account AND f.aweme_id = p.aweme_id)))
WHERE i = 1""")
def _(v):
    return topics.first_per_theme(v("posts"), v("frame_rows"), TITLE_RULES)


TALK_COUNTS_SQL = f"""
rules AS (SELECT * FROM (VALUES (0, 'tion'), (1, 'la'), (2, 'ung'), (3, 'zz'), (4, 'the')) r(ord, theme)),
hits AS (SELECT account, {TALK_SQL} AS theme FROM talk),
total AS (SELECT account, count(*) AS total FROM talk GROUP BY account),
counts AS (SELECT t.account, r.ord, r.theme, count(h.theme) AS n, t.total FROM total t CROSS JOIN rules r
  LEFT JOIN hits h ON h.account = t.account AND h.theme = r.theme GROUP BY 1, 2, 3, 5)"""


@query("A15_comment_theme_counts", f"WITH {TALK_COUNTS_SQL} SELECT account, ord, theme, n, total, (n * 100)::DOUBLE / total AS share_pct FROM counts")
def _(v):
    return topics.comment_theme_counts(v("talk"), TALK_RULES)


@query("X8_classify_comment", f"SELECT account, seq, {TALK_SQL} AS theme FROM talk")
def _(v):
    return v("talk").select("account", "seq", C.first_pattern_rule("content", TALK_RULES).alias("theme"))


@query("A16_comment_coverage", f"""
WITH {TALK_COUNTS_SQL}, big AS (SELECT account, theme AS biggest_theme FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, ord) AS i FROM counts) WHERE i = 1),
c AS (SELECT account, count(*) AS n_comments, count(DISTINCT aweme_id) AS posts_covered, max(like_count) AS best_like_count FROM talk GROUP BY account),
p AS (SELECT account, count(*) AS n_posts FROM posts GROUP BY account)
SELECT c.account, n_comments, posts_covered, n_posts, best_like_count, biggest_theme, n_comments::DOUBLE / posts_covered AS per_post,
  (posts_covered * 100)::DOUBLE / n_posts AS coverage_pct FROM c JOIN p ON p.account = c.account JOIN big ON big.account = c.account""")
def _(v):
    return topics.comment_coverage(v("talk"), v("posts"), TALK_RULES)


@query("T7_friction_samples", """
WITH g AS (SELECT *, 'la' AS grp, 4 AS k FROM talk WHERE length(content) >= 8 AND regexp_matches(content, ' la ')
  UNION ALL SELECT *, 'the', 3 FROM talk WHERE length(content) >= 8 AND regexp_matches(content, '[Tt]he|tion')),
r AS (SELECT *, row_number() OVER (PARTITION BY account, grp ORDER BY like_count DESC, aweme_id, seq) AS place FROM g)
SELECT account, grp, CAST(place AS INTEGER) AS place, aweme_id, like_count, substr(content, 1, 66) AS content FROM r WHERE place <= k""")
def _(v):
    return topics.friction_samples(v("talk"), (("la", " la ", 4), ("the", "[Tt]he|tion", 3)))


@query("F16_long_and_matching", "SELECT account, seq FROM talk WHERE length(content) >= 300 AND regexp_matches(content, 'tion|ung')")
def _(v):
    return v("talk").filter(topics.long_and_matching("tion|ung", 300)).select("account", "seq")


@query("A17_hashtag_stats", r"""
WITH tags AS (SELECT account, likes, unnest(list_distinct(regexp_extract_all(concat(title, chr(10), hook), '#([^\s#.，。・·]+)', 1))) AS tag FROM tagged),
s AS (SELECT account, tag, count(*) AS n, CAST(sum(likes) AS BIGINT) AS l FROM tags GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, tag) AS place FROM s)
SELECT account, CAST(place AS INTEGER) AS place, tag, n, CAST(round_even(l::DOUBLE / n, 0) AS BIGINT) AS mean_likes FROM r WHERE place <= 15""")
def _(v):
    return topics.hashtag_stats(v("tagged"), body="hook")


@query("A17_hashtag_stats_fallback", r"""
WITH tags AS (SELECT account, likes, unnest(list_distinct(regexp_extract_all(concat(title, chr(10), CASE WHEN likes % 2 = 0 THEN concat('#', track) ELSE hook END), '#([^\s#.，。・·]+)', 1))) AS tag FROM tagged),
s AS (SELECT account, tag, count(*) AS n, CAST(sum(likes) AS BIGINT) AS l FROM tags GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, tag) AS place FROM s)
SELECT account, CAST(place AS INTEGER) AS place, tag, n, CAST(round_even(l::DOUBLE / n, 0) AS BIGINT) AS mean_likes FROM r WHERE place <= 15""")
def _(v):
    posts = v("tagged").withColumn("said", F.expr("if(likes % 2 = 0, '', hook)")).withColumn("about", F.concat(F.lit("#"), "track"))
    return topics.hashtag_stats(posts, body="said", fallback="about")


@query("A26_join_segments", """
SELECT account, aweme_id, string_agg(trim(text), '' ORDER BY seq) AS transcript FROM segments GROUP BY 1, 2""")
def _(v):
    return topics.join_segments(v("segments"))


@query("A26_join_segments_or_text", """
WITH s AS (SELECT account, aweme_id, string_agg(trim(text), '' ORDER BY seq) AS joined FROM segments GROUP BY 1, 2)
SELECT account, aweme_id, coalesce(nullif(s.joined, ''), trim(t.transcript, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), '') AS transcript
FROM s FULL JOIN transcripts t USING (account, aweme_id)""")
def _(v):
    return topics.join_segments(v("segments"), v("transcripts"), text="transcript")


@query("A21_mode_of", """
WITH s AS (SELECT account, aweme_id, visual_style AS val, row_number() OVER (PARTITION BY account, aweme_id ORDER BY count(*) DESC, min(seq)) AS i FROM frame_rows GROUP BY 1, 2, 3),
m AS (SELECT account, aweme_id, composition AS val, row_number() OVER (PARTITION BY account, aweme_id ORDER BY count(*) DESC, min(seq)) AS i FROM frame_rows GROUP BY 1, 2, 3)
SELECT s.account, s.aweme_id, s.val AS style, m.val AS comp FROM s JOIN m ON m.account = s.account AND m.aweme_id = s.aweme_id AND m.i = 1 WHERE s.i = 1""")
def _(v):
    return mode_of(v("frame_rows"), ["account", "aweme_id"], {"style": "visual_style", "comp": "composition"}, "seq")


# ---- scalar functions over whole columns -----------------------------------------------------


@query("X1_url_key", "SELECT aweme_id, CASE WHEN url = '' THEN '' ELSE substr(sha256(url), 1, 24) END AS k FROM links")
def _(v):
    return v("links").select("aweme_id", C.url_key("url").alias("k"))


@query("X2_content_hash", "SELECT aweme_id, sha256(body) AS h FROM links")
def _(v):
    return v("links").select("aweme_id", C.content_hash(F.encode("body", "UTF-8")).alias("h"))


@query("X4_comma_list", """
SELECT aweme_id, array_to_string(list_filter(list_transform(string_split(urls, ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM links""")
def _(v):
    return v("links").select("aweme_id", F.array_join(C.comma_list("urls"), "|").alias("parts"))


@query("X5_hashtags", r"""
SELECT aweme_id, array_to_string(list_sort(list_distinct(regexp_extract_all(body, '#([^\s#.，。・·]+)', 1))), '|') AS tags FROM links""")
def _(v):
    return v("links").select("aweme_id", F.array_join(F.array_sort(C.hashtags("body")), "|").alias("tags"))


@query("X6_long_ids", r"""
WITH runs AS (SELECT aweme_id, regexp_extract_all(concat(url, ' ', CAST(seqs AS VARCHAR)), '[0-9]+') AS r FROM (SELECT aweme_id, url, CAST(aweme_id AS BIGINT) * 123457 AS seqs FROM links))
SELECT aweme_id, array_to_string(list_filter(r, lambda x: length(x) >= 8), '|') AS ids FROM runs""")
def _(v):
    text = F.concat("url", F.lit(" "), (F.col("aweme_id").cast("bigint") * 123457).cast("string"))
    return v("links").select("aweme_id", F.array_join(C.long_ids(text), "|").alias("ids"))


@query("D4_dedup_ids_in_order", """
WITH runs AS (SELECT aweme_id, list_filter(regexp_extract_all(transcript, '[0-9]+'), lambda x: length(x) >= 8) AS r FROM transcripts),
e AS (SELECT aweme_id, unnest(r) AS id, generate_subscripts(r, 1) AS i FROM runs),
f AS (SELECT aweme_id, id, min(i) AS i FROM e GROUP BY 1, 2)
SELECT runs.aweme_id, coalesce(string_agg(id, '|' ORDER BY f.i), '') AS ids FROM runs LEFT JOIN f ON f.aweme_id = runs.aweme_id GROUP BY 1""")
def _(v):
    return v("transcripts").select("aweme_id", F.array_join(C.long_ids("transcript"), "|").alias("ids"))


@query("X9_correct_terms", "SELECT account, seq, replace(replace(content, 'tion', 'TION'), 'TIO', 'x') AS content FROM talk")
def _(v):
    fixed = C.correct_terms("content", (("tion", "TION"), ("la", "la"), ("TIO", "x")))
    return v("talk").select("account", "seq", fixed.alias("content"))


@query("X10_segment_line", """
SELECT seq, format('[{:06.2f} - {:06.2f}] {}', start, "end", trim(text)) AS line FROM
  (SELECT seq, (seq % 4000)::DOUBLE / 8 + 0.125 AS start, (seq % 4000)::DOUBLE / 8 + 1.25 AS "end", text FROM segments)""")
def _(v):
    start = (F.col("seq") % 4000).cast("double") / 8 + F.lit(0.125)
    return v("segments").select("seq", C.segment_line(start, start + F.lit(1.125), "text").alias("line"))


@query("X11_local_date", "SELECT aweme_id, CAST(make_timestamp(create_time * 1000000) AS DATE) AS day FROM posts")
def _(v):
    return v("posts").select("aweme_id", C.local_date("create_time").alias("day"))


@query("X12_time_parts", """
SELECT aweme_id, strftime(t, '%Y-%m') AS month, CAST(hour(t) AS INTEGER) AS hour, CAST(isodow(t) - 1 AS INTEGER) AS weekday, CAST(year(t) AS INTEGER) AS year
FROM (SELECT aweme_id, make_timestamp((create_time + 28800) * 1000000) AS t FROM posts)""")
def _(v):
    t = C.local_time("create_time", "Asia/Shanghai")
    return v("posts").select("aweme_id", C.month_key(t).alias("month"), F.hour(t).alias("hour"), F.weekday(t).alias("weekday"), F.year(t).alias("year"))


@query("X13_clip", "SELECT aweme_id, substr(transcript, 1, 48) AS t FROM transcripts")
def _(v):
    return v("transcripts").select("aweme_id", C.clip("transcript", 48).alias("t"))


@query("X14_nested_path", "SELECT seq, coalesce(region, 'none') AS region FROM (SELECT seq, CASE WHEN subtitle_present THEN region END AS region FROM frame_rows)")
def _(v):
    rows = v("frame_rows").withColumn("sub", F.when(F.col("subtitle_present"), F.struct("region")))
    return rows.select("seq", C.at_path("sub.region", "none").alias("region"))


@query("X15_label_of", "SELECT aweme_id, CASE bgm_level WHEN 'none' THEN 'N' WHEN 'light' THEN 'L' ELSE bgm_level END AS label FROM soundtrack")
def _(v):
    return v("soundtrack").select("aweme_id", C.label_of("bgm_level", {"none": "N", "light": "L"}).alias("label"))


@query("X16_hamming", """
SELECT p_partkey, CAST(bit_count(xor(p_partkey * 2654435761, CAST(p_size AS BIGINT) * 40503)) AS INTEGER) AS bits FROM part""")
def _(v):
    a, b = F.col("p_partkey") * F.lit(2654435761), F.col("p_size").cast("bigint") * 40503
    return v.table("part").select("p_partkey", C.hamming(a, b).alias("bits"))


@query("X17_l1_distance", """
SELECT idx, CAST(round_even(list_sum(list_transform(list_zip(hist, list_reverse(hist)), lambda p: abs(p[1] - p[2]))), 6) AS DOUBLE) AS d FROM hist_frames""")
def _(v):
    return v("hist_frames").select("idx", F.bround(C.l1_distance("hist", F.reverse("hist")), 6).alias("d"))


@query("X18_duration", """
SELECT t.aweme_id, CAST(round_even(coalesce(nullif(s.duration, 0), nullif(t.duration, 0), 0), 1) AS DOUBLE) AS d
FROM transcripts t LEFT JOIN soundtrack s ON s.account = t.account AND s.aweme_id = t.aweme_id""")
def _(v):
    s = v("soundtrack").select("account", "aweme_id", F.col("duration").alias("s"))
    return v("transcripts").join(s, ["account", "aweme_id"], "left").select("aweme_id", C.duration_seconds("s", "duration").alias("d"))


@query("X19_valid_slug", "SELECT s_name, regexp_full_match(s_name, '[A-Za-z0-9][A-Za-z0-9._-]{0,79}') AS ok FROM (SELECT s_name FROM supplier UNION ALL SELECT substr(s_name, 10) FROM supplier)")
def _(v):
    names = v.table("supplier").select("s_name")
    both = names.unionAll(names.select(F.substring("s_name", 10, 1000)))
    return both.select("s_name", C.valid_slug("s_name").alias("ok"))


# ---- tags ------------------------------------------------------------------------------------


@query("G1_performance_tiers", """
SELECT account, aweme_id, CASE ntile(3) OVER (PARTITION BY account ORDER BY likes DESC, seq) WHEN 1 THEN 'head' WHEN 2 THEN 'middle' ELSE 'tail' END AS tier FROM posts""")
def _(v):
    return tags.performance_tiers(v("posts")).select("account", "aweme_id", "tier")


TIER_SQL = "tiered AS (SELECT *, ntile(3) OVER (PARTITION BY account ORDER BY likes DESC, seq) AS tier FROM tagged)"


@query("G2_tag_crosstab", f"""
WITH {TIER_SQL}, l AS (SELECT account, 'track' AS field, track AS value, tier, collects FROM tiered UNION ALL SELECT account, 'proof', proof, tier, collects FROM tiered),
c AS (SELECT account, field, value, count(*) AS n_all, count(*) FILTER (tier = 1) AS n_viral, count(*) FILTER (tier > 1) AS n_normal, count(*) FILTER (collects >= 20) AS n_saved FROM l WHERE value IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT *, sum(n_all) OVER w AS sa, sum(n_viral) OVER w AS sv, sum(n_normal) OVER w AS sn, sum(n_saved) OVER w AS sh FROM c WINDOW w AS (PARTITION BY account, field))
SELECT account, field, value, n_all, n_viral, n_normal, n_saved, CASE WHEN sa = 0 THEN 0 ELSE (n_all * 100)::DOUBLE / sa::DOUBLE END AS share_all, CASE WHEN sv = 0 THEN 0 ELSE (n_viral * 100)::DOUBLE / sv::DOUBLE END AS share_viral,
  CASE WHEN sn = 0 THEN 0 ELSE (n_normal * 100)::DOUBLE / sn::DOUBLE END AS share_normal, CASE WHEN sh = 0 THEN 0 ELSE (n_saved * 100)::DOUBLE / sh::DOUBLE END AS share_saved FROM s""")
def _(v):
    tiered = tags.performance_tiers(v("tagged"))
    segments = {"all": F.lit(True), "viral": F.col("tier") == "head", "normal": F.col("tier") != "head", "saved": F.col("collects") >= 20}
    return tags.tag_crosstab(tiered, ["track", "proof"], segments)


@query("G3_tag_lift", f"""
WITH {TIER_SQL}, c AS (SELECT account, track AS value, count(*) FILTER (tier = 1) AS n_head, count(*) FILTER (tier > 1) AS n_rest FROM tiered GROUP BY 1, 2),
s AS (SELECT *, (n_head * 100)::DOUBLE / sum(n_head) OVER w::DOUBLE AS share_head, CASE WHEN sum(n_rest) OVER w = 0 THEN 0 ELSE (n_rest * 100)::DOUBLE / sum(n_rest) OVER w::DOUBLE END AS share_rest FROM c WINDOW w AS (PARTITION BY account))
SELECT account, 'track' AS field, value, n_head, n_rest, share_head, share_rest, CASE WHEN share_rest <> 0 THEN share_head / share_rest END AS lift FROM s WHERE n_head >= 2""")
def _(v):
    return tags.tag_lift(tags.performance_tiers(v("tagged")), ["track"])


@query("G4_structure_engagement", """
SELECT account, 'hook' AS field, hook AS value, count(*) AS n, sum(likes)::DOUBLE / count(*) AS mean_likes, sum(comments)::DOUBLE / count(*) AS mean_comments,
  sum(collects)::DOUBLE / count(*) AS mean_collects, sum(shares)::DOUBLE / count(*) AS mean_shares FROM tagged GROUP BY 1, 3""")
def _(v):
    return tags.structure_engagement(v("tagged"), ["hook"])


@query("G5_need_top10", f"""
WITH {TALK_COUNTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY n DESC, ord) AS place FROM counts WHERE n > 0)
SELECT account, CAST(place AS INTEGER) AS place, theme, n, (n * 100)::DOUBLE / total AS share_pct FROM r WHERE place <= 10""")
def _(v):
    return tags.need_top10(v("talk"), TALK_RULES)


@query("A4_value_medians", "SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS median FROM lineitem GROUP BY 1, 2")
def _(v):
    return exact_quantiles(v.table("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"median": middle})
