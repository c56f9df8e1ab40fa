"""Posts from files without a state: batches are put together when they are read."""

import json

import pytest
from pyspark.sql import functions as F

from clipstat.plans import queries_sources
from clipstat.plans.registry import QUERIES
from clipstat.plans.standins import Views
from clipstat.streaming import streams

SCHEMA = "account string, aweme_id string, seq int, desc string"
BATCHES = [
    [("a", "1", 5, "new"), ("a", "2", 6, "x"), ("a", "1", 4, "older")], [("a", "1", 2, "old"), ("a", "", 9, "no"), ("a", None, 9, "no")],
    [("a", "1", 8, "newest"), ("b", "1", 7, None)],
]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_batches_in_any_order_give_the_latest_record_at_the_first_place(spark, tmp_path, order):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "stream")
    for number, i in enumerate(order):
        spark.createDataFrame(BATCHES[i], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for _ in range(2):  # Started once more with nothing new.
            live = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
            streams.write_posts(live, out, checkpoint, seq="seq").awaitTermination()
        if number == 1:  # A replayed batch writes the same folder again.
            first = spark.createDataFrame(spark.read.parquet(f"{out}/batch=0").collect())
            first.write.mode("overwrite").parquet(f"{out}/batch=0")
    want = [("a", "1", "newest", 2), ("a", "2", "x", 6), ("b", "1", None, 7)]
    got = streams.merged_posts(spark, out, seq="seq").orderBy(*streams.POST).collect()
    assert [(r["account"], r["aweme_id"], r["desc"], r["first_seq"]) for r in got] == want
    narrow = streams.merged_posts(spark, out, ["desc"], seq="seq")
    assert narrow.columns == ["account", "aweme_id", "seq", "desc", "first_seq"]
    assert not (tmp_path / "stream/state").exists()


def test_a_record_of_a_batch_does_not_depend_on_what_came_before(spark, tmp_path):
    for number in range(3):
        spark.createDataFrame([("a", str(number), number, "x")], SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        live = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        streams.write_posts(live, str(tmp_path / "out"), str(tmp_path / "stream"), seq="seq").awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"out/batch={number}")).count() == 1


def test_the_query_of_captured_files_keeps_no_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries_sources, "staged", lambda v, name: f"{tmp_path}/{name}")
    QUERIES["ST1_stream_posts_files"](Views(spark, "/root/testdata/sf0.001"))
    assert (tmp_path / "stream/commits").exists() and not (tmp_path / "stream/state").exists()


def test_equal_records_have_equal_places_and_others_do_not(spark, tmp_path):
    records = [{"aweme_id": "1", "desc": "x"}, {"aweme_id": "1", "title": "x"}, {"aweme_id": "1", "desc": "x"}, {"aweme_id": "1", "nickname": "x"},
               {"aweme_id": "1", "statistics": {"digg_count": "x"}}, {"aweme_id": "1", "statistics": {"share_count": "x"}}, {"aweme_id": "1"}]
    (tmp_path / "p.jsonl").write_text("\n".join(json.dumps(r) for r in records))
    live = streams.stream_posts(spark, str(tmp_path), "acc")
    streams.write_posts(live.withColumn("aweme_id", F.col("arrival.row").cast("string")), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(records) - 1
