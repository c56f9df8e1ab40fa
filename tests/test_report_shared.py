"""A whole report: what several sections derive is derived once, and sections equal those made alone."""

import re
from dataclasses import replace

import pytest

from clipstat.operators import stats
from clipstat.plans import report
from clipstat.plans.queries_report import sources
from clipstat.plans.standins import Views
from clipstat.session import stage
from clipstat.sources import sinks

SF = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def given(spark):
    made = sources(Views(spark, SF))
    return replace(made, comments=stage(made.comments, "kept"), summaries=stage(made.summaries, "summaries"))


def test_values_of_quantiles_are_dealt_once_when_run(spark):
    found = stats.ratio_medians(stage(Views(spark, SF)("posts")))
    dealt = re.findall(r"(\w*)Exchange hashpartitioning\(_g0#[^)]*_v#", re.sub(r"ReusedExchange [^\n]*", "", final_plan(found)))
    assert len(dealt) == 1


def test_a_report_writes_what_its_sections_share_once(given, monkeypatch):
    names = []
    monkeypatch.setattr(report, "stage", lambda df, name: names.append(name) or stage(df, name))
    tables = report.report_tables(given)
    assert len(names) == len(set(names))
    assert {"gated", "frame-counts", "inventory", "matched", "groups", "percentiles", "units", "hot"} <= set(names)
    assert "Exchange" not in tables["provenance"]._jdf.queryExecution().executedPlan().toString()


def test_what_is_staged_is_not_written_again(given):
    assert stage(given.comments) is given.comments
    assert stage(given.comments.filter("pos = 1")) is not given.comments


def test_only_frames_of_listed_posts_are_put_in_order(given):
    found = report.best_posts(given)["viral_frames"]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text
    places = [(r["account"], r["place"]) for r in found.select("account", "place").orderBy("account", "place").collect()]
    assert places and all(place <= 8 for _, place in places) and len(places) == len(set(places))


def test_sections_of_a_report_equal_those_made_alone(given):
    whole = report.report_tables(given)
    alone = {"inventory": report.inventory(given), "headline": report.headline(given), "provenance": report.provenance(given)}
    alone |= report.publishing(given) | report.best_posts(given) | report.looks(given) | report.comment_evidence(given)
    for name, df in alone.items():
        assert sorted(map(repr, whole[name].collect())) == sorted(map(repr, df.collect())), name


def test_report_tables_are_written_side_by_side_and_a_failure_is_raised(spark, tmp_path, monkeypatch):
    one = spark.createDataFrame([("a", 1)], "account string, n int")
    sinks.write_report_tables({f"t{i}": one for i in range(8)}, str(tmp_path))
    assert all(spark.read.parquet(f"{tmp_path}/t{i}").collect() == [(1, "a")] for i in range(8))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    with pytest.raises(Exception):
        sinks.write_report_tables({"good": one, "bad": one.selectExpr("account", "raise_error('x') n")}, str(tmp_path / "again"))
    assert spark.conf.get(setting) == before


def test_a_report_is_read_back_in_one_aggregate(spark):
    from clipstat.plans.registry import QUERIES

    found = QUERIES["K6_write_report_tables"](Views(spark, SF))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [section") <= 2
    assert found.count() == 29
