"""Plan shape: no single-partition exchange, early limits, narrow scans, no row-at-a-time Python."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from clipstat.operators import comments, ingest, profiles, ranking
from clipstat.plans.standins import Views
from clipstat.skew import down, exact_quantiles, middle, ranks_by, ties, up
from clipstat.sources import sinks

SF = "/root/testdata/sf0.001"
WRITING = ("S1", "S2", "S4", "K", "ST", "R", "D5", "V", "op")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith(WRITING) and n != "pipeline"))
def test_no_global_window_and_no_row_udf(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "CollectLimit" not in text


def test_top_n_runs_before_the_shuffle(spark):
    v = Views(spark, SF)
    for df in (comments.top_comments_per_post(v("comments_raw"), 3), ranking.top_posts(v("posts"))):
        text = plan(df)
        assert "WindowGroupLimit" in text and ", Partial" in text
    # Already partitioned by account, so the limit needs no exchange of its own.
    assert "WindowGroupLimit" in plan(ranking.archetype_top5(v("posts")))


WHOLE = ("account", "aweme_id", "_g0", "_g1", "_metric", "_rank")


def windows_over_whole_groups(text: str) -> list[str]:
    """Windows of a plan that are dealt by account or post alone, other than limits on a rank."""
    found = []
    for line in text.splitlines():
        got = re.search(r"(?:^|[ +-])Window \[.*\bwindowspecdefinition\(([^\[]*?), [^,]* (?:ASC|DESC)", line)
        keys = [re.sub(r"#\d+L?", "", k).strip() for k in got[1].split(",") if " ASC" not in k and " DESC" not in k] if got else []
        if keys and all(k in WHOLE for k in keys):
            found.append(line.strip())
    return found


@pytest.mark.parametrize("name", ["W7_merge_intervals", "W7_review_intervals", "W7_speech_islands", "W8_complement_intervals", "J6_frames_in_intervals",
                                  "J7_samples_in_windows", "A3_nearest_rank_percentile", "A4_median", "A5_nonzero_median", "A6_upper_median", "A7_ratio_medians",
                                  "W2_metric_ranks", "W3_prominence"])
def test_no_window_over_a_whole_account_or_post(spark, name):
    assert windows_over_whole_groups(plan(entry.queries()[name](spark, SF))) == []


def test_the_check_above_sees_a_window_over_an_account(spark):
    posts = Views(spark, SF)("posts")
    spec = Window.partitionBy("account").orderBy("seq")
    assert windows_over_whole_groups(plan(posts.select("account", F.sum("likes").over(spec))))


def test_an_account_of_equal_likes_spreads_over_tasks(spark):
    posts = spark.range(20_000).selectExpr("'a0' account", "id seq", "if(id % 10 = 0, id, 0L) likes", "0L comments", "0L collects", "0L shares")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = ranks_by(posts, "account", {"r": "likes"}, "likes", "seq")
        long = ranked._jdf.queryExecution().executedPlan().toString()
        assert long.count("_slice2") and windows_over_whole_groups(long) == []
        late = posts.selectExpr("seq", "likes as _metric", "likes as _then", "seq as _late")
        slices = late.groupBy(down("_metric"), ties("_metric", down("_then")), ties("_metric", ties("_then", up("_late")))).count()
        assert slices.agg(F.max("count")).first()[0] < 20_000 / 16
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_scan_reads_only_what_is_needed(spark):
    v = Views(spark, SF)
    text = plan(v("soundtrack").filter("bgm_level = 'none'").groupBy("account").count())
    scan = text[text.index("ReadSchema") :]
    assert "o_totalprice" not in scan and "o_orderdate" not in scan


def test_no_record_is_carried_where_only_keys_are_asked_for(spark):
    assert "max_by" not in plan(entry.queries()["T1_hard_limit"](spark, SF))


def test_records_are_compared_once_for_a_ranked_post_table(spark):
    assert "max_by" not in plan(ingest.build_posts(Views(spark, SF)("posts_raw")))


def test_what_many_sections_read_is_derived_once_for_the_whole_report(spark):
    from clipstat.plans.queries_report import staged_sources

    made = staged_sources(Views(spark, SF))
    assert all("Aggregate" not in plan(df) and "Window" not in plan(df) for df in (made.comments, made.summaries))


def test_ingest_order_is_aggregated_without_sorting_rows_by_path(spark):
    text = plan(entry.queries()["S4_ingest_order"](spark, SF))
    assert "SortAggregate" not in text


def test_a_comment_is_compared_without_what_its_key_tells(spark):
    text = plan(comments.dedup_comments(comments.clean_comments(Views(spark, SF)("comments_raw"))))
    carried = re.search(r"functions=\[(?:partial_)?min\w*\((?:named_)?struct\(([^()]*)", text).group(1)
    assert "account" not in carried and "aweme_id" not in carried and carried.count("seq, seq#") == 1


def test_captured_comments_are_parsed_and_compared_once_for_both_tables(spark, monkeypatch):
    given = []
    monkeypatch.setattr(sinks, "write_comments", lambda top, unique, path, n, torn: given.extend([top, unique, torn]))
    with pytest.raises(Exception):
        entry.queries()["K2_write_comments"](spark, SF)
    assert len(given) == 3
    for df in given:
        assert "json" not in plan(df) and "min(" not in plan(df)


def test_a_profile_takes_its_frame_count_from_the_summary(spark):
    posts = spark.createDataFrame([("a", "1", 5)], "account string, aweme_id string, comments bigint").withColumn("create_time", F.lit(0).cast("bigint"))
    looks = spark.createDataFrame([("a", "1", 7)], "account string, aweme_id string, frames_analyzed bigint")
    assert profiles.build_profiles(posts, visual=looks).first()["frame_count"] == 7


def test_digests_are_made_once_for_both_looks_of_the_range_shuffle(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(sinks, "stage", lambda df, name: staged.append(name) or df, raising=False)
    rows = spark.createDataFrame([("a", "1", 5, 1)], "account string, aweme_id string, comments bigint, rank int")
    rows = rows.withColumns({"create_time": F.lit(0).cast("bigint"), "title": F.lit("t"), "likes": F.lit(1), "collects": F.lit(1), "shares": F.lit(1)})
    sinks.write_profile_digest(profiles.build_profiles(rows), str(tmp_path / "digest"))
    assert staged == ["digest"] and spark.read.text(str(tmp_path / "digest")).count() == 4


def test_quantiles_deal_every_value_only_for_its_counts(spark):
    text = plan(exact_quantiles(Views(spark, SF)("posts"), ["account"], "likes", {"m": middle}))
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning\(_g0#[^)]*_v#", text)) == 3
