"""Queries over hand-assigned content tags and performance tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators.topics import comment_theme_counts
from clipstat.skew import down, ordered

TIERS = ("head", "middle", "tail")


def performance_tiers(
    posts: DataFrame, *, account: str = "account", seq: str = "seq"
) -> DataFrame:
    """G1: thirds of an account's posts by likes; a remainder goes to the better tiers."""
    placed = ordered(posts, [account], [F.desc("likes"), F.asc(seq)], slice_by=down("likes"), rank="_place", size="_n")
    i, n = F.col("_place") - 1, F.col("_n")
    big = F.floor(n / 3) + 1
    extra = n % 3
    third = F.when(i < big * extra, F.floor(i / big)).otherwise(
        extra + F.floor((i - big * extra) / F.greatest(F.floor(n / 3), F.lit(1)))
    )
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), third.cast("int") + 1)
    return placed.withColumn("tier", tier).drop("_place", "_n")


def _long(tagged: DataFrame, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{f}', {f}" for f in fields)
    return tagged.selectExpr(*keep, f"stack({len(fields)}, {pairs}) as (field, value)").filter("value is not null")


def tag_crosstab(
    tagged: DataFrame, fields: Sequence[str], segments: dict[str, Column], *, account: str = "account"
) -> DataFrame:
    """Tag values by segment (all, viral, normal, ...): counts and shares of the segment."""
    flagged = tagged.withColumns({f"_in_{n}": c for n, c in segments.items()})
    long = _long(flagged, fields, [account, *[f"_in_{n}" for n in segments]])
    counted = long.groupBy(account, "field", "value").agg(
        *[F.count_if(f"_in_{n}").alias(f"n_{n}") for n in segments]
    )
    whole = Window.partitionBy(account, "field")
    return counted.withColumns(
        {f"share_{n}": C.percent(f"n_{n}", F.sum(f"n_{n}").over(whole)) for n in segments}
    )


def tag_lift(
    tagged: DataFrame, fields: Sequence[str], min_count: int = 2, *, account: str = "account"
) -> DataFrame:
    """Share of a tag among head posts over its share among the rest; only repeated tags."""
    segments = {"head": F.col("tier") == "head", "rest": F.col("tier") != "head"}
    cross = tag_crosstab(tagged, fields, segments, account=account)
    return cross.filter(F.col("n_head") >= min_count).withColumn("lift", C.ratio("share_head", "share_rest"))


def structure_engagement(tagged: DataFrame, fields: Sequence[str], *, account: str = "account") -> DataFrame:
    """Posts and mean engagement per tag value."""
    metrics = ("likes", "comments", "collects", "shares")
    grouped = _long(tagged, fields, [account, *metrics]).groupBy(account, "field", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(m).alias(f"_{m}") for m in metrics]
    )
    return grouped.select(
        account, "field", "value", "n",
        *[(F.col(f"_{m}").cast("double") / F.col("n")).alias(f"mean_{m}") for m in metrics],
    )


def need_top10(
    comments: DataFrame, rules: Sequence[tuple[str, str]], k: int = 10, *, account: str = "account"
) -> DataFrame:
    """Most frequent comment themes."""
    counts = comment_theme_counts(comments, rules, account=account).filter("n > 0")
    spec = Window.partitionBy(account).orderBy(F.desc("n"), F.asc("ord"))
    return counts.withColumn("place", F.row_number().over(spec)).filter(F.col("place") <= k).select(
        account, "place", "theme", "n", "share_pct"
    )
