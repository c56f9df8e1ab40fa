"""Mixing and the URL filter: SQL checks, odd rows, and plans without Python."""

import pytest

from clipstat.llm import mixing, queries, url_filter
from clipstat.llm.common import table
from tests.compare import differences, duck
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_sql(spark, name):
    assert differences(spark, duck(SF), SF, queries.QUERIES[name], queries.CHECKS[name]) == []


@pytest.mark.parametrize("name", ["op3_urls", "op7_mixing"])
def test_no_python_in_the_plan(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_targets_stop_and_share_the_rest(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 10), (None, 50), ("d", 0)]
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(sizes, "source string, size bigint")).collect()}
    # Weights: a 5, b 2, c 1, d 5, null 2; a, c, d and null stop at three times, b takes the rest.
    assert got["a"].target == 300 and got["c"].target == 30 and got["d"].target == 0 and got[None].target == 150
    assert got["b"].target == 680 and sum(r.target for r in got.values()) == 1160


def test_mix_of_odd_rows(odd, odd_rows, none):
    out = mixing.mix(odd)
    rows = out.collect()
    assert out.columns == [*odd.columns, "_mix"] and len(rows) == len(odd_rows)
    for r in rows:
        assert r._mix.size == len((r.text or "").encode().split()) and 0 <= r._mix.copies <= 3
    assert mixing.emitted(out).count() == sum(r._mix.copies for r in rows)
    assert mixing.mix(none).count() == 0
    assert [r._mix for r in mixing.mix(odd.repartition(3)).orderBy("doc_id", "text").collect()] == [r._mix for r in out.orderBy("doc_id", "text").collect()]


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 9 as int)) as text", "concat('s', id % 4) as source")
    m = mixing.mix(docs).selectExpr("source", "_mix.size * _mix.copies as taken", "_mix.target").groupBy("source", "target").sum("taken")
    for r in m.collect():
        assert abs(r["sum(taken)"] / r["target"] - 1) < 0.05


def test_urls(spark):
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "https://A.B.NET/en/x?q", "http://example.net/en/", "http://x.example.net/EN/",
            "http://example.com/de/#x", "http://xexample.com/de/", "ftp://m.org/fr/a://b", "http://org/fr", "http://a.net?x=/", "http://net:80/", "a://b.net/\n", "http://" + "a." * 3000 + "net/"]
    pages = spark.createDataFrame([(i, u, "n") for i, u in enumerate(urls)] + [(4, "http://net/", "n")], "page_id bigint, url string, key string")
    got = {(r.page_id, r.host[-20:], r.path): (r.rule, r.verdict) for r in url_filter.judged(pages, url_filter.rules(spark)).collect()}
    allow = (None, "allow")
    assert got[0, "", ""] == got[1, "", ""] == got[2, "", ""] == got[3, "", ""] == got[4, "net", ""] == allow
    assert got[5, "net", "/"] == got[4, "net", "/"] == ("net/", "block") and got[6, "a.b.net", "/en/x"] == ("net/", "block")
    assert got[7, "example.net", "/en/"] == ("example.net/en/", "allow") and got[8, "x.example.net", "/EN/"] == ("net/", "block")
    assert got[9, "example.com", "/de/"] == ("example.com/de/", "block") and got[10, "xexample.com", "/de/"] == allow
    assert got[11, "m.org", "/fr/a://b"] == ("org/fr/", "allow") and got[12, "org", "/fr"] == allow and got[13, "a.net", ""] == allow
    assert got[14, "net:80", "/"] == allow and got[15, "b.net", "/\n"][1] == "block" and len(got) == 18
    assert got[16, ("a." * 3000 + "net")[-20:], "/"] == ("net/", "block")


def test_bloom_passes_every_listed_key(spark):
    many = spark.range(3000).selectExpr("concat('h', id % 50, '.example', id % 7, '/p', id) as key", "'block' as verdict")
    pages = spark.range(6000).selectExpr("id as page_id", "concat('http://sub.h', id % 50, '.example', id % 7, '/p', id) as url")
    rows = url_filter.judged(pages, many).collect()
    listed = {f"h{i % 50}.example{i % 7}/p{i}" for i in range(3000)}
    for r in rows:
        fits = [k for k in (f"{r.host.removeprefix('sub.')}{r.path[:n]}" for n in range(1, len(r.path) + 1)) if k in listed]
        assert r.rule == (max(fits, key=len) if fits else None)
    assert url_filter.judged(table(spark, SF, "pages").limit(0), many).count() == 0
    assert url_filter.judged(pages.limit(2), many.limit(0)).count() == 2
