"""Visual summaries per post and their distribution per account."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators.frames import LABELS
from clipstat.skew import down, mode_of, ordered

DIMENSIONS = ("visual_style", "temperature", "composition", "scene")


def visual_summary(
    frames: DataFrame, labels: Mapping[str, Sequence[str]] | None = LABELS, *, account: str = "account",
    key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """One row per post from analysed frames. Ties of a mode go to the value met first.

    ``labels`` lists the values each label column can have: then one aggregate with one shuffle
    counts them all, and a value outside the list fails the query. With ``labels=None`` any value is
    allowed and the modes are counted value by value.
    """
    group = [account, key]
    columns = {**{d: d for d in DIMENSIONS}, "subtitle_region": "_region"}
    rows = frames.withColumn("_region", F.when(F.col("subtitle_present"), F.col("region")))
    aggs = [
        F.count(F.lit(1)).alias("frames_analyzed"),
        *[F.bround(F.avg(c), 3).alias(c) for c in ("mean_h", "mean_s", "mean_v")],
        F.count_if("subtitle_present").alias("_subs"),
        F.count_if("product_candidate").alias("_prods"),
    ]
    if "ocr_status" in frames.columns:
        aggs.append(F.count_if(_ocr_usable()).alias("_ocr"))
    if labels:
        known = {n: labels["region" if n == "subtitle_region" else n] for n in columns}
        for name, source in columns.items():
            for i, value in enumerate(known[name]):
                hit = F.col(source) == value
                aggs.append(F.count_if(hit).alias(f"_n_{name}_{i}"))
                aggs.append(F.min(F.when(hit, F.col(seq))).alias(f"_f_{name}_{i}"))
            aggs.append(F.count_if(~F.col(source).isin(*known[name])).alias(f"_x_{name}"))
        out = rows.groupBy(*group).agg(*aggs).withColumns({n: _most(n, known[n]) for n in columns})
    else:
        out = rows.groupBy(*group).agg(*aggs).join(mode_of(rows, group, columns, seq), group)
    candidate = F.struct(F.col(seq).alias("s"), F.col("timestamp").alias("t"))
    times = frames.filter("product_candidate").groupBy(*group).agg(
        F.transform(F.sort_array(F.collect_list(candidate)), lambda x: x["t"]).alias("candidate_timestamps")
    )
    n = F.col("frames_analyzed")
    out = out.join(times, group, "left").withColumns(
        {
            "subtitle_ratio": F.bround(C.ratio("_subs", n), 3),
            "product_ratio": F.bround(C.ratio("_prods", n), 3),
            "candidate_timestamps": F.coalesce("candidate_timestamps", F.array().cast("array<double>")),
            **{d: F.coalesce(d, F.lit("unknown")) for d in columns},
        }
    )
    if "ocr_status" in frames.columns:
        out = out.withColumn("ocr_status", F.when(F.col("_ocr") > 0, "ok").otherwise("unavailable"))
    others = [F.col(c) for c in out.columns if c.startswith("_x_")]
    out = out.withColumn("unlisted_labels", sum(others, F.lit(0)).cast("bigint"))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def _most(name: str, values: Sequence[str]) -> Column:
    """Value with the highest count, then the earliest first row, from the counted columns."""
    options = [
        F.when(
            F.col(f"_n_{name}_{i}") > 0,
            F.struct(
                (-F.col(f"_n_{name}_{i}")).alias("n"), F.col(f"_f_{name}_{i}").alias("first"), F.lit(value).alias("value")
            ),
        )
        for i, value in enumerate(values)
    ]
    return (F.least(*options) if len(options) > 1 else options[0])["value"]


def _ocr_usable():
    known = F.coalesce(F.lower("ocr_status"), F.lit("none"))
    return ~known.isin("unavailable", "missing", "unknown", "none")


def visual_with_posts(
    summaries: DataFrame, posts: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Summaries of listed posts with their likes."""
    return summaries.join(posts.select(account, key, "likes", F.col("seq").alias("post_seq")), [account, key])


def visual_match_counts(
    summaries: DataFrame, posts: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Posts with and without a summary per account."""
    have = summaries.select(account, key, F.lit(1).alias("_has"))
    return posts.select(account, key).join(have, [account, key], "left").groupBy(account).agg(
        F.count("_has").alias("matched"), F.count_if(F.col("_has").isNull()).alias("unmatched")
    )


def visual_intersection(
    summaries: DataFrame, posts: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """U5."""
    return summaries.select(account, key).intersect(posts.select(account, key))


def visual_distribution(
    matched: DataFrame, labels: Mapping[str, Mapping[str, str]] | None = None, *, account: str = "account"
) -> DataFrame:
    """Counts and shares of the four dimensions, unknown values included in the total."""
    pairs = ", ".join(f"'{d}', coalesce({d}, 'unknown')" for d in DIMENSIONS)
    long = matched.selectExpr(account, f"stack({len(DIMENSIONS)}, {pairs}) as (dimension, value)")
    counted = long.groupBy(account, "dimension", "value").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(account, "dimension")
    label = F.col("value")
    for dimension, names in (labels or {}).items():
        label = F.when(F.col("dimension") == dimension, C.label_of("value", names)).otherwise(label)
    return counted.withColumn("share_pct", C.percent("n", F.sum("n").over(whole))).withColumn("label", label)


def product_exposure(matched: DataFrame, *, account: str = "account") -> DataFrame:
    """Posts with any product candidate and the mean candidate share."""
    ratio = F.coalesce("product_ratio", F.lit(0.0))
    return matched.groupBy(account).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ratio > 0).alias("with_candidate"),
        (F.sum(ratio.cast("decimal(20,6)")).cast("double") / F.count(F.lit(1))).alias("mean_candidate_ratio"),
    )


def top_vs_rest_visual(
    matched: DataFrame, top_share: float = 0.2, min_group: int = 5, *, account: str = "account",
    seq: str = "post_seq"
) -> DataFrame:
    """Most frequent value and its share among the best-liked posts and the others.

    Shown only when both groups have at least ``min_group`` posts. Unknown values do not compete
    for the mode; shares are over the whole group.
    """
    placed = ordered(matched, [account], [F.desc("likes"), F.asc(seq)], slice_by=down("likes"), rank="_place", size="_n")
    top_n = F.greatest(F.lit(5), F.ceil(F.col("_n") * F.lit(top_share)))
    tiered = placed.withColumn("_top", top_n).filter(
        (F.least(F.col("_top"), F.col("_n")) >= min_group) & (F.col("_n") - F.col("_top") >= min_group)
    ).withColumn("tier", F.when(F.col("_place") <= F.col("_top"), "top").otherwise("rest"))
    pairs = ", ".join(f"'{d}', {d}" for d in DIMENSIONS)
    long = tiered.selectExpr(account, "tier", "_place", f"stack({len(DIMENSIONS)}, {pairs}) as (dimension, value)")
    counted = long.groupBy(account, "tier", "dimension", "value").agg(
        F.count(F.lit(1)).alias("_k"), F.min("_place").alias("_first")
    )
    known = F.col("value").isNotNull() & ~F.col("value").isin("", "unknown")
    order = F.when(known, F.struct(-F.col("_k"), F.col("_first")))
    best = counted.groupBy(account, "tier", "dimension").agg(
        F.min_by("value", order).alias("value"), F.min_by("_k", order).alias("_k"), F.sum("_k").alias("n"),
        F.sum(F.when(F.coalesce("value", F.lit("unknown")) == "unknown", F.col("_k"))).alias("_unknown"),
    )
    return best.select(
        account, "tier", "dimension", F.coalesce("value", F.lit("unknown")).alias("value"), "n",
        F.bround(C.percent(F.coalesce("_k", "_unknown", F.lit(0)), "n"), 1).alias("share_pct"),
    )


def top_vs_rest_product(
    matched: DataFrame, top_share: float = 0.2, min_group: int = 5, *, account: str = "account",
    seq: str = "post_seq"
) -> DataFrame:
    """Product candidates among the best-liked posts and the others."""
    placed = ordered(matched, [account], [F.desc("likes"), F.asc(seq)], slice_by=down("likes"), rank="_place", size="_n")
    top_n = F.greatest(F.lit(5), F.ceil(F.col("_n") * F.lit(top_share)))
    tiered = placed.withColumn("_top", top_n).filter(
        (F.least(F.col("_top"), F.col("_n")) >= min_group) & (F.col("_n") - F.col("_top") >= min_group)
    ).withColumn("tier", F.when(F.col("_place") <= F.col("_top"), "top").otherwise("rest"))
    ratio = F.coalesce("product_ratio", F.lit(0.0))
    return tiered.groupBy(account, "tier").agg(
        F.count(F.lit(1)).alias("n"),
        F.bround(C.percent(F.count_if(ratio > 0), F.count(F.lit(1))), 1).alias("with_candidate_pct"),
        F.bround(F.sum(ratio.cast("decimal(20,6)")).cast("double") * 100 / F.count(F.lit(1)), 1).alias("mean_candidate_pct"),
    )


def ocr_note(summaries: DataFrame, *, account: str = "account") -> DataFrame:
    """Whether subtitle shares may be judged: only where some summary carries a usable OCR status."""
    return summaries.groupBy(account).agg(F.max(_ocr_usable()).alias("subtitles_judged"))
