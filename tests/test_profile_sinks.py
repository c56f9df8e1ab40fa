"""Sinks of wide profiles: nothing that made them is on the disk while they are gathered."""

import os
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from clipstat.operators import profiles
from clipstat.session import stage
from clipstat.sources import sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def two_posts(spark):
    rows = spark.createDataFrame([("a", "1", 5, 2), ("b", "2", 6, 1)], "account string, aweme_id string, comments bigint, rank int")
    rows = rows.withColumns({"create_time": F.lit(0).cast("bigint"), "title": F.lit("t"), "likes": F.lit(1), "collects": F.lit(1), "shares": F.lit(1)})
    looks = spark.createDataFrame([("a", "1", 7)], "account string, aweme_id string, frames_analyzed bigint")
    return profiles.build_profiles(rows, visual=looks)


def seen_by(monkeypatch):
    """What the sink gathers, and the folders it reads while it does."""
    given = []
    write = sinks.write_table

    def spy(df, path, **named):
        given.append((plan(df), [f.removeprefix("file://") for f in df.inputFiles()]))
        write(df, path, **named)

    monkeypatch.setattr(sinks, "write_table", spy)
    return given


def test_profiles_are_gathered_after_they_are_made(spark, tmp_path, monkeypatch):
    given = seen_by(monkeypatch)
    made = two_posts(spark)
    sinks.write_profiles(made, str(tmp_path / "p"))
    (text, files), = given
    assert "Join" not in text and files and not any(os.path.exists(f) for f in files)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert sorted(map(tuple, back.select("account", "aweme_id", "frame_count").collect())) == [("a", "1", 7), ("b", "2", 0)]


def test_what_the_caller_staged_stays(spark, tmp_path, monkeypatch):
    given = seen_by(monkeypatch)
    mine = stage(two_posts(spark))
    sinks.write_profiles(mine, str(tmp_path / "p"))
    assert given[0][1] and all(os.path.exists(f) for f in given[0][1]) and mine.count() == 2


def test_the_writing_query_leaves_none_of_its_inputs(spark, monkeypatch):
    given = seen_by(monkeypatch)
    out = entry.queries()["K3_write_profiles"](spark, SF)
    (text, files), = given
    assert not re.search("Join|Window|Aggregate", text)
    assert not any(os.path.exists(f) for f in files) and out.count() > 0


def test_digests_are_dealt_after_they_are_made(spark, tmp_path, monkeypatch):
    left = []
    monkeypatch.setattr(sinks, "release", lambda df: left.append((plan(df), df.count())))
    sinks.write_profile_digest(two_posts(spark), str(tmp_path / "d"))
    assert [(n, "Join" in text) for text, n in left] == [(2, False)]
    assert spark.read.text(str(tmp_path / "d")).count() == 8
    made = []
    monkeypatch.setattr(sinks, "write_profile_digest", lambda df, path: made.append(plan(df)))
    try:
        entry.queries()["K4_write_digest"](spark, SF)
    except Exception:  # Nothing was written to read back.
        pass
    assert len(made) == 1 and not re.search("Window|Aggregate", made[0])
