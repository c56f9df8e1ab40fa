"""Edge cases with results worked out by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators import cadence, comments, ingest, intervals, ranking, reconcile, soundtrack, stats, topics, visual
from clipstat.plans import report


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expr).first()[0]


POSTS = "account string, aweme_id string, seq int, likes bigint, comments bigint, collects bigint, shares bigint, create_time bigint, title string, aweme_type int"


def posts(spark, *data):
    return spark.createDataFrame(data, POSTS)


RAW = "account string, aweme_id string, seq int, aweme_type string, desc string, title string, nickname string, author_word string, create_time string, liked_count string, comment_count string, collected_count string, share_count string, video_download_url string, cover_url string, music_download_url string, music_url string, note_download_url string"


def raw(spark, *records):
    names = [f.split()[0] for f in RAW.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], RAW)


def test_counts(spark):
    assert one(spark, C.count_value("x"), x="1.2万") == 0
    assert one(spark, C.count_is_bad("x"), x="1.2万") is True
    assert one(spark, C.count_value("x"), x=" 12　") == 12
    assert one(spark, C.count_is_bad("x"), x="") is False
    assert [one(spark, C.strict_int("x"), x=v) for v in ("0", "", "true", "+7", "-3", "1.0")] == [0, None, None, 7, -3, None]


def test_latest_payload_keeps_first_place(spark):
    df = raw(
        spark,
        dict(account="a", aweme_id="1", seq=1, liked_count="5", desc="old", video_download_url="v"),
        dict(account="a", aweme_id="2", seq=2, liked_count="9", desc="two", note_download_url=" u1, ,u2 ", aweme_type="68"),
        dict(account="a", aweme_id="1", seq=3, liked_count="9", desc="", title="new", music_url="m"),
        dict(account="a", aweme_id="", seq=4, liked_count="99"),
    )
    out = ingest.build_posts(df)
    assert rows(out, "rank", "aweme_id", "likes", "title", "audio_source") == [
        (1, "1", 9, "new", "music_download_url"), (2, "2", 9, "two", "missing")]
    assert out.filter("aweme_id = '2'").first()["note_urls"] == ["u1", "u2"]
    first = ingest.build_posts(df, policy="first")
    assert rows(first, "aweme_id", "likes", "title") == [("1", 5, "old"), ("2", 9, "two")]
    assert rows(ingest.build_posts(df, max_posts=1), "aweme_id") == [("1",)]


def test_completeness_gate(spark):
    url = "struct<url_list: array<string>>"
    schema = f"aweme_id string, desc string, create_time string, aweme_type string, statistics struct<digg_count: string, collect_count: string, comment_count: string, share_count: string>, video struct<play_addr: {url}, play_addr_h264: {url}, raw_cover: {url}, origin_cover: {url}>, images array<struct<origin_url: {url}>>, note_download_url string"
    stat, two, empty = ("1", "1", "0", "1"), (["a", "b"],), ([],)
    data = [
        ("1", "d", "5", "0", stat, (two, empty, two, None), None, None),
        ("2", "d", "5", "0", stat, ((["a", ""],), None, two, None), None, None),
        ("3", "d", "5", "68", stat, None, [((["i"],),)], None),
        ("4", "d", "5", "68", stat, None, [(empty,)], None),
        ("5", "d", "5", "68", stat, None, None, " , "),
        ("6", "d", "5", "0", ("1", "", "0", "1"), (two, two, two, None), None, None),
        ("7", None, "5", "0", stat, (two, two, two, None), None, None),
        ("8", "d", "", "0", stat, (two, two, two, None), None, None),
        ("9", "d", "5", "x", stat, (two, two, two, None), None, None),
        ("10", "d", "5", "0", stat, (two, None, empty, two), None, None),
    ]
    df = spark.createDataFrame(data, schema)
    good = {r[0] for r in df.filter(ingest.completeness_gate(df)).select("aweme_id").collect()}
    assert good == {"1", "3"}


def test_comment_keys_do_not_collide(spark):
    schema = "account string, aweme_id string, comment_id string, content string, nickname string, like_count string, create_time bigint, seq int"
    df = spark.createDataFrame(
        [
            ("a", "1", "c", "hi", "n", "1", 0, 1), ("a", "1", "c", "other", "m", "9", 0, 2),
            ("a", "1", "", "hi", "n", "2", 0, 3), ("a", "1", "", "hi", "n", "7", 0, 4), ("a", "1", None, "hi", "p", "2", 0, 5),
            ("a", "1", "d", " 　 ", "n", "1", 0, 6), ("a", None, "d", "x", "n", "1", 0, 7), ("a", "2", "c", "hi", "n", "", 0, 8),
        ],
        schema,
    )
    kept = comments.build_comments(df, n=2)
    assert rows(kept, "aweme_id", "pos", "like_count", "nickname") == [("1", 1, 2, "n"), ("1", 2, 2, "p"), ("2", 1, 0, "n")]
    nested = comments.nest_comments(kept, 2).filter("aweme_id = '1'").first()
    assert (nested["n"], nested["max"], [c["content"] for c in nested["comments"]]) == (2, 2, ["hi", "hi"])
    assert nested["comments"][0]["nickname"] != "n"
    known = spark.createDataFrame([("a", "2")], "account string, aweme_id string")
    assert rows(comments.build_comments(df, known, 2), "aweme_id") == [("2",)]


def test_zero_and_edge_likes(spark):
    df = posts(spark, *[("a", str(i), i, v, 0, 0, 0, None, "", 0) for i, v in enumerate([0, 99, 100, 999, 1000, 10000, 99999, 100000, 2000000, -5])])
    hist = dict(rows(stats.likes_histogram(df), "label", "n"))
    assert hist == {"<100": 3, "100-1k": 2, "1k-10k": 1, "10k-100k": 2, "100k+": 2}
    assert stats.likes_histogram(df).agg(F.sum("n_negative")).first()[0] == 1
    zero = posts(spark, ("z", "1", 1, 0, 0, 0, 0, None, "", 0), ("z", "2", 2, 0, 0, 0, 0, None, "", 0))
    assert rows(stats.top_share(zero), "top_share_pct") == [(0,)]
    rates = stats.engagement_rates(stats.engagement_totals(zero)).first()
    assert (rates["collect_rate"], rates["comment_rate"], rates["audience"]) == (0.0, 0.0, "comment_led")
    assert rows(stats.ratio_medians(zero), "collects_per_like_median") == [(0.0,)]
    assert ranking.archetype_top5(zero).count() == 0
    assert ranking.archetype_top5(zero, require_positive=False).count() == 0
    assert rows(cadence.years_active(zero), "years") == [(0.0,)]
    assert rows(cadence.publish_cadence(zero), "span_days", "gap_median", "top_months") == [(0, None, "")]


def test_three_medians(spark):
    df = posts(spark, *[("a", str(i), i, v, 0, 0, 0, None, "", 0) for i, v in enumerate([1, 2, 4, 9])])
    assert rows(stats.medians(df), "median", "upper_median") == [(3.0, 4)]
    # position round(0.5 * 3) = round(1.5) = 2 (half-even)
    assert rows(stats.nearest_rank_percentile(df, (50, 90)), "p50", "p90") == [(4, 9)]
    five = posts(spark, *[("a", str(i), i, v, 0, 0, 0, None, "", 0) for i, v in enumerate([1, 2, 3, 4, 5, 6])])
    assert rows(stats.nearest_rank_percentile(five, (50,)), "p50") == [(3,)]


def test_publish_rhythm(spark):
    day = 86400
    df = posts(spark, *[("a", str(i), i, 1, 0, 0, 0, t, "", 0) for i, t in enumerate([0, 10, 3 * day, 40 * day, None, 10**15])])
    assert rows(cadence.publish_gaps(df), "aweme_id", "gap_days") == [("0", None), ("1", 0), ("2", 3), ("3", 37)]
    out = cadence.publish_cadence(df).first()
    assert (out["span_days"], out["monthly_avg"], out["top_months"], out["gap_median"]) == (41, 2.0, "1970-01:3,1970-02:1", 3)
    assert out["first_day"] == datetime.date(1970, 1, 1)


def test_time_zone_does_not_follow_the_session(spark):
    df = posts(spark, ("a", "1", 1, 1, 0, 0, 0, 1700000000, "", 0))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            hours = dict(rows(cadence.posts_by_unit(df, tz="Asia/Shanghai"), "unit", "value"))
            assert hours == {"year": 2023, "hour": 6, "weekday": 2}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_segment_lines_round_half_even(spark):
    df = spark.createDataFrame([(0.125, 12.5, " hi ")], "s double, e double, t string")
    assert df.select(C.segment_line("s", "e", "t")).first()[0] == "[000.12 - 012.50] hi"


def test_text_rules(spark):
    assert one(spark, F.array_join(C.hashtags("x"), "|"), x="#a。#b　#a #c.d##e，f") == "a|b|c|e"
    assert one(spark, F.array_join(C.long_ids("x"), "|"), x="12345678 x123456789y 1234567 12345678") == "12345678|123456789"
    assert one(spark, C.correct_terms("x", (("ab", "cd"), ("same", "same"), ("cd", "e"))), x="abab") == "ee"
    assert [one(spark, C.valid_slug("x"), x=v) for v in ("a", ".a", "a/b", "a" * 81)] == [True, False, False, False]
    theme = C.first_keyword_rule("x", (("one", ("a", "b")), ("two", ("c",))))
    assert [one(spark, theme, x=v) for v in ("cb", "c", "z")] == ["one", "two", "other"]


def test_comment_counted_once_and_rules_without_hits_stay(spark):
    df = spark.createDataFrame([("a", "1", 1, "why buy"), ("a", "1", 2, "buy"), ("a", "2", 3, "none")], "account string, aweme_id string, like_count int, content string")
    out = topics.comment_theme_counts(df, (("ask", "why"), ("buy", "buy"), ("gone", "zzz")))
    assert rows(out, "theme", "n", "total") == [("ask", 1, 3), ("buy", 1, 3), ("gone", 0, 3)]


def test_intervals_touching_and_empty(spark):
    schema = "account string, aweme_id string, start double, end double"
    seg = spark.createDataFrame([("a", "1", 1.0, 2.0), ("a", "1", 2.2, 3.0), ("a", "1", 2.2, 2.5), ("a", "1", 3.26, 4.0), ("a", "1", 9.0, 8.0)], schema)
    out = intervals.merge_intervals(seg, 0.25)
    assert rows(out, "start", "end", "segments") == [(1.0, 3.0, 3), (3.26, 4.0, 1), (9.0, 9.0, 1)]
    dur = spark.createDataFrame([("a", "1", 5.0), ("a", "2", 7.0)], "account string, aweme_id string, duration double")
    free = intervals.non_speech_windows(seg, dur, 0.0)
    assert rows(free, "start", "end") == [(0.0, 1.0), (2.0, 2.2), (3.0, 3.26), (4.0, 5.0)]
    record = soundtrack.soundtrack_record(dur, seg, pad=0.0)
    assert rows(record, "aweme_id", "transcript_status", "analysis_status", "non_speech_seconds") == [
        ("1", "segment_mask", "insufficient_evidence", 2.46), ("2", "missing_transcript", "insufficient_evidence", 0.0)]


def test_evidence_limits(spark):
    schema = "account string, aweme_id string, cache_version string, source_kind string, analysis_scope string, analysis_status string, source_status string, bgm_level string, mood string, vocal string, non_speech_seconds double, non_speech_coverage double"

    def rec(i, level="none", secs=3.0, cov=0.10, status="ok"):
        return ("a", str(i), soundtrack.ARCHIVE_VERSION, "mixed_track", "non_speech_windows", status, "ok", level, "m", None, secs, cov)

    records = spark.createDataFrame([rec(1), rec(2, secs=2.999), rec(3, cov=0.0999), rec(4, level="unknown"), rec(5), rec(6), rec(7, "light", status=""), rec(8, status="error")], schema)
    vids = posts(spark, *[("a", str(i), i, i * 10, 0, i, i, None, "", 68 if i == 5 else 0) for i in (1, 2, 3, 4, 5, 7, 8)])
    gated = soundtrack.evidence_gate(records, vids)
    assert rows(gated.filter("evidence"), "aweme_id") == [("1",), ("7",)]
    groups = soundtrack.group_engagement(gated)
    assert rows(groups.filter("dimension = 'by_vocal'"), "value", "n", "pct") == [("unknown", 2, 100.0)]
    assert rows(soundtrack.group_multipliers(groups), "like_mult", "share_mult_exact") == [(7.0, 7.0)]
    assert rows(soundtrack.status_counts(gated), "status", "n", "excluded") == [("error", 1, 1), ("ok", 7, 5)]


def test_mode_ties_go_to_the_first(spark):
    schema = "account string, aweme_id string, seq int, timestamp double, visual_style string, temperature string, composition string, scene string, mean_h double, mean_s double, mean_v double, subtitle_present boolean, region string, product_candidate boolean, ocr_status string"
    data = [
        ("a", "1", 1, 0.0, "low_key", "warm", "centered", "outdoor_candidate", 1.0, 2.0, 3.0, False, "top", True, None),
        ("a", "1", 2, 1.0, "balanced", "cool", "centered", "outdoor_candidate", 2.0, 2.0, 3.0, True, "bottom", False, None),
        ("a", "1", 3, None, "balanced", "warm", "asymmetric", None, 2.0, 2.0, 3.0, False, "top", True, None),
        ("a", "1", 4, 3.0, "low_key", "cool", "asymmetric", None, 2.0, 2.0, 3.0, False, "top", False, None),
    ]
    df = spark.createDataFrame(data, schema)
    for labels in (visual.LABELS, None):
        out = visual.visual_summary(df, labels).first()
        assert (out["visual_style"], out["temperature"], out["composition"], out["scene"]) == ("low_key", "warm", "centered", "outdoor_candidate")
        assert (out["subtitle_region"], out["subtitle_ratio"], out["candidate_timestamps"], out["mean_h"]) == ("bottom", 0.25, [0.0, None], 1.75)
        assert out["ocr_status"] == "unavailable"
    odd = visual.visual_summary(df.withColumn("scene", F.lit("else"))).first()
    assert (odd["scene"], odd["unlisted_labels"], odd["temperature"]) == ("unknown", 4, "warm")


def test_small_groups_show_no_comparison(spark):
    schema = "account string, aweme_id string, visual_style string, temperature string, composition string, scene string, likes int, post_seq int, product_ratio double"
    few = spark.createDataFrame([("a", str(i), "low_key", "warm", "centered", None, i, i, 0.0) for i in range(9)], schema)
    assert visual.top_vs_rest_visual(few).count() == 0
    ten = few.unionByName(few.filter("likes = 0").withColumns({"aweme_id": F.lit("x"), "post_seq": F.lit(99)}))
    out = visual.top_vs_rest_visual(ten)
    assert rows(out.filter("dimension = 'scene'"), "tier", "value", "share_pct") == [("rest", "unknown", 100.0), ("top", "unknown", 100.0)]


def test_reconcile_states(spark):
    df = posts(spark, *[(a, str(i), i, 1, 0, 0, 0, None, "", 0) for a, n in (("full", 3), ("cap", 5), ("gap", 2), ("none", 1), ("zero", 1)) for i in range(n)])
    totals = spark.createDataFrame([("full", 3), ("cap", 9), ("gap", 4), ("zero", 0)], "account string, aweme_count bigint")
    out = reconcile.reconcile_counts(df, totals, 5)
    assert rows(out.filter("account <> 'none'"), "account", "status", "missing") == [
        ("cap", "capped", 4), ("full", "ok", 0), ("gap", "incomplete", 2), ("zero", "unknown", None)]


def test_zero_coverage(spark):
    schema = "account string, aweme_id string, comment_count string"
    rows_ = spark.createDataFrame([("a", "1", "0"), ("a", "2", "0"), ("b", "1", ""), ("c", "1", "0")], schema)
    skipped = rows_.select("account", "aweme_id")
    targets = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", "1"), ("c", "2")], "account string, aweme_id string")
    assert rows(reconcile.explicit_zero_coverage(rows_, skipped, targets), "account", "zero_ok") == [("a", True), ("b", False), ("c", False)]


def test_report_leaves_out_absent_sources(spark):
    df = posts(spark, *[("a", str(i), i, i, 1, 1, 1, 86400 * i, f"t #x{i}", 0) for i in range(1, 6)])
    tables = report.report_tables(report.Sources(df))
    assert "comment_themes" not in tables and "soundtrack_groups" not in tables
    assert rows(tables["inventory"], "n_posts", "missing_sources") == [(5, "comments,soundtrack,frames,transcripts,visual")]
    doc = tables["account_metrics"].first()
    assert [v["aweme_id"] for v in doc["viral"]] == ["5", "4", "3", "2", "1"] and len(doc["tags"]) == 5


def test_images_are_worked_on_in_bounded_stacks():
    """A batch of 10,000 images was one stack, with intermediate arrays of some hundred megabytes."""
    import pandas as pd

    from clipstat.operators import frames

    for each in (24 * 24 * 3, 64 * 36, 4_000_000):
        parts = list(frames._stacks(pd.DataFrame({"idx": range(10_000 if each < 5000 else 5)}), each))
        assert all(len(p) == 1 or len(p) * each <= frames.STACK_BYTES for p in parts)
        assert [i for p in parts for i in p["idx"]] == list(range(sum(map(len, parts)))) and len(parts) > 1
