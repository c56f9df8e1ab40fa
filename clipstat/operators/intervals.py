"""Timed intervals per post: merge, complement and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.skew import ordered, up


def merge_intervals(
    intervals: DataFrame, tol: float = 0.0, pad: float = 0.0, *, account: str = "account",
    key: str = "aweme_id", end_limit: str | None = None
) -> DataFrame:
    """Pad, then join intervals that touch within ``tol`` into islands.

    Repeated starts are combined first (a later end decides), so a post with very many segments
    sorts only distinct starts. ``end_limit`` names a column that caps the padded end.
    """
    start = F.greatest(F.col("start") - pad, F.lit(0.0))
    end = F.col("end") + pad
    if end_limit:
        end = F.least(end, F.col(end_limit))
    padded = intervals.select(account, key, start.alias("start"), F.greatest(end, start).alias("end"))
    starts = padded.groupBy(account, key, "start").agg(
        F.max("end").alias("end"), F.count(F.lit(1)).alias("_n")
    )
    reach = ordered(starts, [account, key], [F.asc("start")], slice_by=up("start"), running_max={"_reach": "end"})
    breaks = reach.withColumn(
        "_break",
        F.when(F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + tol), 1).otherwise(0),
    )
    numbered = ordered(breaks, [account, key], [F.asc("start")], slice_by=up("start"), running_sum={"island": "_break"})
    return numbered.groupBy(account, key, F.col("island").cast("int").alias("island")).agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.sum("_n").alias("segments"),
    )


def complement_intervals(
    islands: DataFrame, durations: DataFrame, min_gap: float = 0.02, *, account: str = "account",
    key: str = "aweme_id", duration: str = "duration"
) -> DataFrame:
    """What the islands leave free of ``[0, duration]``, pieces above ``min_gap`` only."""
    between = ordered(
        islands.select(account, key, "start", "end"), [account, key], [F.asc("start")],
        slice_by=up("start"), previous={"_prev_end": "end"}
    ).select(account, key, F.coalesce("_prev_end", F.lit(0.0)).alias("start"), F.col("start").alias("end"))
    last = islands.groupBy(account, key).agg(F.max("end").alias("start"))
    tail = last.join(durations.select(account, key, F.col(duration).alias("end")), [account, key])
    gaps = between.unionByName(tail).filter(F.col("end") - F.col("start") > min_gap)
    return gaps.select(
        account, key, F.bround("start", 3).alias("start"), F.bround("end", 3).alias("end")
    )


def speech_islands(
    segments: DataFrame, durations: DataFrame, pad: float = 0.15, *, account: str = "account",
    key: str = "aweme_id", duration: str = "duration"
) -> DataFrame:
    """Speech windows: segments clipped to the audio, padded and merged."""
    rows = segments.join(durations.select(account, key, duration), [account, key])
    clipped = rows.select(
        account, key, duration,
        F.greatest(F.col("start"), F.lit(0.0)).alias("start"),
        F.least(F.col("end"), F.col(duration)).alias("end"),
    ).filter("end > start")
    return merge_intervals(clipped, 0.0, pad, account=account, key=key, end_limit=duration)


def non_speech_windows(
    segments: DataFrame, durations: DataFrame, pad: float = 0.15, *, account: str = "account",
    key: str = "aweme_id", duration: str = "duration"
) -> DataFrame:
    """W7 + W8 for soundtracks."""
    islands = speech_islands(segments, durations, pad, account=account, key=key, duration=duration)
    return complement_intervals(islands, durations, account=account, key=key, duration=duration)


def in_intervals(
    points: DataFrame, islands: DataFrame, at: str, *, account: str = "account", key: str = "aweme_id",
    flag: str = "inside",
) -> DataFrame:
    """Flag rows whose time lies in one of the post's intervals, ends included.

    Points and interval starts are swept together in time order: a point is inside when the latest
    end seen so far is not before it. The sweep runs in slices of time; the latest end of the earlier ones
    is carried into each. A point without a time is in no interval.
    """
    seen = points.select(account, key, F.col(at).cast("double").alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast("double").alias("_e"), F.struct("*").alias("_row"))
    opened = islands.select(account, key, F.col("start").cast("double").alias("_t"), F.lit(0).alias("_k"), F.col("end").cast("double").alias("_e"))
    swept = ordered(
        seen.unionByName(opened, allowMissingColumns=True), [account, key], [F.asc("_t"), F.asc("_k")],
        slice_by=up("_t"), running_max={"_reach": "_e"},
    )
    inside = F.coalesce(F.col("_reach") >= F.col("_t"), F.lit(False))
    return swept.filter("_k = 1").select("_row.*", inside.alias(flag))


def frames_in_intervals(frames: DataFrame, islands: DataFrame, *, account: str = "account",
                        key: str = "aweme_id", at: str = "timestamp") -> DataFrame:
    """J6 as a filter."""
    return in_intervals(frames, islands, at, account=account, key=key).filter("inside").drop("inside")


def review_intervals(
    segments: DataFrame, pad: float = 0.35, tol: float = 0.25, low_conf: float = 0.80,
    low_logprob: float = -0.80, *, account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """W7 for review: islands around segments with low confidence."""
    low = segments.filter(low_segment(low_conf, low_logprob)).select(
        account, key,
        F.greatest(F.col("start") - pad, F.lit(0.0)).alias("start"),
        F.greatest(F.greatest(F.col("start") - pad, F.lit(0.0)), F.col("end") + pad).alias("end"),
    )
    return merge_intervals(low, tol, 0.0, account=account, key=key).select(
        account, key, "island", F.bround("start", 3).alias("start"), F.bround("end", 3).alias("end"), "segments"
    )


def low_segment(low_conf: float = 0.80, low_logprob: float = -0.80):
    """the first score that is present decides."""
    return F.coalesce(
        F.col("confidence") < low_conf,
        F.col("probability") < low_conf,
        F.col("language_probability") < low_conf,
        F.col("avg_logprob") < low_logprob,
        F.lit(False),
    )
