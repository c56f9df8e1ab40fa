"""Metric ranks, prominence, archetypes and top lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.skew import exact_quantiles, middle, ranks_by

METRICS = ("likes", "collects", "shares", "comments")
PROMINENCE_MIN = {"collects": 1.3, "shares": 1.3, "comments": 1.4}


def metric_ranks(
    posts: DataFrame, *, account: str = "account", seq: str = "seq"
) -> DataFrame:
    """Four unique ranks per account. Ties follow the manifest order (likes, first seen)."""
    return ranks_by(posts, account, {f"{m}_rank": m for m in METRICS}, "likes", seq)


def prominence(ranked: DataFrame) -> DataFrame:
    """Likes rank over metric rank; above 1 the metric stands out."""
    return ranked.withColumns(
        {
            f"{m}_prominence": F.col("likes_rank").cast("double") / F.greatest(F.col(f"{m}_rank"), F.lit(1)).cast("double")
            for m in METRICS[1:]
        }
    )


def nonzero_median(
    posts: DataFrame, metrics=METRICS[1:], *, account: str = "account"
) -> DataFrame:
    """A5: per account, the median over positive values, 0 when there is none."""
    pairs = ", ".join(f"'{m}', {m}" for m in metrics)
    long = posts.selectExpr(account, f"stack({len(metrics)}, {pairs}) as (_metric, _value)")
    found = exact_quantiles(
        long.withColumn("_value", F.expr("if(_value > 0, _value, null)")), [account, "_metric"], "_value", {"_median": middle}
    )
    return found.groupBy(account).agg(
        *[
            F.coalesce(F.max(F.when(F.col("_metric") == m, F.col("_median"))), F.lit(0.0)).alias(f"{m}_nzmed")
            for m in metrics
        ]
    )


def archetype_top5(
    posts: DataFrame,
    k: int = 5,
    prominence_min: Mapping[str, float] = PROMINENCE_MIN,
    *,
    require_positive: bool = True,
    comment_count: str = "comments",
    account: str = "account",
    key: str = "aweme_id",
    seq: str = "seq"
) -> DataFrame:
    """Posts whose collects, shares or comments outrank their likes.

    ``comment_count`` names the count that stands for comments: the platform's or the captured one.
    Only posts at or above the account's non-zero median compete; order is prominence weighted by
    how far the metric exceeds that median.
    """
    if comment_count != "comments":
        posts = posts.withColumn("comments", F.col(comment_count))
    ranked = prominence(metric_ranks(posts, account=account, seq=seq))
    medians = nonzero_median(posts, tuple(prominence_min), account=account)
    parts = ", ".join(
        f"'{m}', {m}, {m}_prominence, {m}_nzmed, cast({t} as double)" for m, t in prominence_min.items()
    )
    long = ranked.join(medians, account).selectExpr(
        account, key, "title", *METRICS, "likes_rank",
        f"stack({len(prominence_min)}, {parts}) as (archetype, _value, _prom, _med, _min)",
    )
    keep = (F.col("_value") >= F.col("_med")) & (F.col("_prom") > F.col("_min"))
    if require_positive:
        keep = keep & (F.col("_value") > 0)
    score = F.col("_prom") * F.col("_value") / (F.col("_med") + 1)
    spec = Window.partitionBy(account, "archetype").orderBy(F.desc("score"), F.asc("likes_rank"))
    return (
        long.filter(keep)
        .withColumn("score", score)
        .withColumn("place", F.row_number().over(spec))
        .filter(F.col("place") <= k)
        .select(
            account, "archetype", "place", key, *METRICS, "likes_rank", "score",
            C.clip("title", 26).alias("title"),
        )
    )


def top_by_likes(
    posts: DataFrame, k: int, *, account: str = "account", seq: str = "seq"
) -> DataFrame:
    """Best ``k`` posts per account; the limit runs ahead of the shuffle."""
    spec = Window.partitionBy(account).orderBy(F.desc("likes"), F.asc(seq))
    return posts.withColumn("place", F.row_number().over(spec)).filter(F.col("place") <= k)


def viral_top5(
    posts: DataFrame, k: int = 5, *, account: str = "account", key: str = "aweme_id", seq: str = "seq"
) -> DataFrame:
    """T3."""
    return top_by_likes(posts, k, account=account, seq=seq).select(
        account, "place", key, *METRICS, C.clip("title", 26).alias("title")
    )


def top_posts(
    posts: DataFrame, k: int = 10, *, tz: str = "UTC", account: str = "account",
    key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """T5: table of the best posts with their date, ``-`` when unknown."""
    day = F.coalesce(C.local_date("create_time", tz).cast("string"), F.lit("-"))
    return top_by_likes(posts, k, account=account, seq=seq).select(
        account, "place", key, *METRICS, day.alias("day"), C.clip("title", 38).alias("title")
    )


def viral_key_frames(
    posts: DataFrame, frames: DataFrame, k: int = 8, *, account: str = "account",
    key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """Best posts that have a frame; ``frames`` has one row per post."""
    with_frame = posts.join(frames, [account, key])
    return top_by_likes(with_frame, k, account=account, seq=seq)
