"""Account-level totals, rates, percentiles and histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.skew import exact_quantiles, middle, nearest_rank, upper_middle

METRICS = ("likes", "comments", "collects", "shares")

# Left-closed lower edges and their labels.
LIKE_BINS = ((0, "<100"), (100, "100-1k"), (1_000, "1k-10k"), (10_000, "10k-100k"), (100_000, "100k+"))


def engagement_totals(posts: DataFrame, *, account: str = "account") -> DataFrame:
    """A1: post count, sums and means, best post."""
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(f"sum_{m}") for m in METRICS]
    out = posts.groupBy(account).agg(
        F.count(F.lit(1)).alias("n"), *sums, F.max("likes").alias("max_likes")
    )
    means = {f"mean_{m}": F.col(f"sum_{m}").cast("double") / F.col("n") for m in METRICS}
    return out.withColumns(means)


def engagement_rates(totals: DataFrame) -> DataFrame:
    """A2: collects and comments per 100 likes; the larger one names the audience."""
    out = totals.withColumns(
        {
            "collect_rate": C.percent("sum_collects", "sum_likes"),
            "comment_rate": C.percent("sum_comments", "sum_likes"),
        }
    )
    label = F.when(F.col("collect_rate") > F.col("comment_rate"), "collect_led").otherwise("comment_led")
    return out.withColumn("audience", label)


def nearest_rank_percentile(
    posts: DataFrame, percents=(50, 90), *, value: str = "likes", account: str = "account"
) -> DataFrame:
    """A3."""
    picks = {f"p{p}": nearest_rank(p) for p in percents}
    return exact_quantiles(posts, [account], value, picks)


def medians(
    posts: DataFrame, *, value: str = "likes", account: str = "account"
) -> DataFrame:
    """A4 and A6 side by side: the usual median and the upper middle value."""
    return exact_quantiles(
        posts, [account], value, {"median": middle, "upper_median": upper_middle}
    )


def ratio_medians(posts: DataFrame, *, account: str = "account") -> DataFrame:
    """Median collects, shares and comments per like over posts with likes."""
    names = ("collects", "shares", "comments")
    pairs = ", ".join(f"'{m}', if(likes > 0, cast({m} as double) / cast(likes as double), null)" for m in names)
    long = posts.selectExpr(account, f"stack({len(names)}, {pairs}) as (_metric, _value)")
    found = exact_quantiles(
        long, [account, "_metric"], "_value", {"_median": middle},
    )
    wide = found.groupBy(account).agg(
        *[F.max(F.when(F.col("_metric") == m, F.col("_median"))).alias(f"_{m}") for m in names]
    )
    return wide.select(
        account,
        *[F.coalesce(F.bround(f"_{m}", 3), F.lit(0.0)).alias(f"{m}_per_like_median") for m in names],
    )


def top_share(posts: DataFrame, *, account: str = "account") -> DataFrame:
    """The best post's share of all likes in whole percent."""
    out = posts.groupBy(account).agg(F.max("likes").alias("_top"), F.sum("likes").alias("_all"))
    share = F.bround(F.col("_top").cast("double") / F.col("_all").cast("double") * 100).cast("int")
    return out.select(account, F.when(F.col("_all") != 0, share).otherwise(0).alias("top_share_pct"))


def likes_histogram(posts: DataFrame, *, account: str = "account") -> DataFrame:
    """Counts in left-closed bins; negative likes are clamped to the lowest bin and flagged."""
    likes = F.greatest(F.coalesce("likes", F.lit(0)), F.lit(0))
    edges = [edge for edge, _ in LIKE_BINS] + [None]
    counts = []
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (likes >= low) if high is None else (likes >= low) & (likes < high)
        counts.append(F.count_if(inside).alias(f"_n{i}"))
    wide = posts.groupBy(account).agg(*counts, F.count_if(F.col("likes") < 0).alias("_neg"))
    bins = F.array(
        *[
            F.struct(
                F.lit(i).alias("bin"), F.lit(label).alias("label"), F.col(f"_n{i}").alias("n"),
                (F.col("_neg") if i == 0 else F.lit(0).cast("bigint")).alias("n_negative"),
            )
            for i, (_, label) in enumerate(LIKE_BINS)
        ]
    )
    return wide.select(account, F.inline(bins))
