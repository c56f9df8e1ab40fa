"""Themes, comment patterns and hashtags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C

OTHER_THEME = "other"


def classify_theme(posts: DataFrame, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """First theme rule with a keyword in the title."""
    return posts.withColumn("theme", C.first_keyword_rule("title", rules, OTHER_THEME))


def theme_stats(
    posts: DataFrame, rules: Sequence[tuple[str, Sequence[str]]], hot_factor: float = 2, *,
    account: str = "account",
) -> DataFrame:
    """Posts, share and means per theme; hot when mean likes exceed the overall mean enough."""
    grouped = classify_theme(posts, rules).groupBy(account, "theme").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"_{m}") for m in ("likes", "comments", "collects")],
    )
    whole = Window.partitionBy(account)
    out = grouped.withColumns(
        {"_all": F.sum("n").over(whole), "_all_likes": F.sum("_likes").over(whole)}
    )
    mean = {m: F.col(f"_{m}").cast("double") / F.col("n") for m in ("likes", "comments", "collects")}
    overall = F.col("_all_likes").cast("double") / F.col("_all")
    return out.select(
        account, "theme", "n",
        C.percent("n", "_all").alias("share_pct"),
        *[mean[m].alias(f"mean_{m}") for m in mean],
        (mean["likes"] > overall * hot_factor).alias("hot"),
    )


def first_per_theme(
    posts: DataFrame, frames: DataFrame, rules: Sequence[tuple[str, Sequence[str]]], *,
    account: str = "account", key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """Best-liked post with a frame in each theme."""
    rows = classify_theme(posts.join(frames.select(account, key).distinct(), [account, key], "left_semi"), rules)
    spec = Window.partitionBy(account, "theme").orderBy(F.desc("likes"), F.asc(seq))
    best = rows.withColumn("_n", F.row_number().over(spec)).filter("_n = 1")
    return best.select(account, "theme", key, "likes")


def comment_theme_counts(
    comments: DataFrame, rules: Sequence[tuple[str, str]], *, account: str = "account"
) -> DataFrame:
    """Each comment counts once, under its first matching pattern; unmatched only in the total.

    Every rule gets a row per account, also with no hits.
    """
    hit = comments.select(account, C.first_pattern_rule("content", rules).alias("_theme"))
    wide = hit.groupBy(account).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("_theme") == label).alias(f"_n{i}") for i, (label, _) in enumerate(rules)],
    )
    counts = F.array(
        *[
            F.struct(F.lit(i).alias("ord"), F.lit(label).alias("theme"), F.col(f"_n{i}").alias("n"))
            for i, (label, _) in enumerate(rules)
        ]
    )
    out = wide.select(account, "total", F.inline(counts))
    return out.select(account, "ord", "theme", "n", "total", C.percent("n", "total").alias("share_pct"))


def comment_coverage(
    comments: DataFrame, posts: DataFrame, rules: Sequence[tuple[str, str]], *,
    account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """Comments, posts covered, comments per covered post, coverage, best comment, biggest theme."""
    per_post = comments.groupBy(account, key).agg(
        F.count(F.lit(1)).alias("n"), F.max("like_count").alias("best")
    )
    per = per_post.groupBy(account).agg(
        F.sum("n").alias("n_comments"),
        F.count(F.lit(1)).alias("posts_covered"),
        F.max("best").alias("best_like_count"),
    )
    themes = comment_theme_counts(comments, rules, account=account).groupBy(account).agg(
        F.min_by("theme", F.struct(-F.col("n"), F.col("ord"))).alias("biggest_theme")
    )
    total = posts.groupBy(account).agg(F.count(F.lit(1)).alias("n_posts"))
    joined = total.join(per, account).join(themes, account, "left")
    return joined.select(
        account, "n_comments", "posts_covered", "n_posts", "best_like_count", "biggest_theme",
        (F.col("n_comments").cast("double") / F.col("posts_covered")).alias("per_post"),
        C.percent("posts_covered", "n_posts").alias("coverage_pct"),
    )


def long_and_matching(pattern: str, min_len: int = 8, text: str = "content") -> Column:
    """F16."""
    return (F.char_length(text) >= min_len) & F.col(text).rlike(pattern)


def friction_samples(
    comments: DataFrame, groups: Sequence[tuple[str, str, int]], min_len: int = 8, *,
    account: str = "account", key: str = "aweme_id", seq: str = "seq", chars: int = 66,
) -> DataFrame:
    """Per group, the most liked long comments that match its pattern.

    A comment may appear in several groups. ``groups`` are (label, pattern, count).
    """
    hits = F.array_compact(
        F.array(
            *[
                F.when(
                    long_and_matching(pattern, min_len),
                    F.struct(F.lit(label).alias("grp"), F.lit(k).alias("k")),
                )
                for label, pattern, k in groups
            ]
        )
    )
    largest = max(k for _, _, k in groups)
    rows = comments.select(account, key, seq, "like_count", "content", F.explode(hits).alias("g"))
    spec = Window.partitionBy(account, "g.grp").orderBy(F.desc("like_count"), F.asc(key), F.asc(seq))
    return (
        rows.withColumn("place", F.row_number().over(spec))
        .filter(F.col("place") <= largest)
        .filter(F.col("place") <= F.col("g.k"))
        .select(account, F.col("g.grp").alias("grp"), "place", key, "like_count",
                C.clip("content", chars).alias("content"))
    )


def hashtag_stats(
    profiles: DataFrame, k: int | None = 15, *, account: str = "account", body: str = "transcript",
    fallback: str | None = None,
) -> DataFrame:
    """Tags, distinct per post, with count and mean likes; ties go to the smaller tag.

    ``fallback`` names the text (a description) that counts where the body is null or empty.
    """
    said = F.when(F.col(body) != "", F.col(body))
    said = F.coalesce(said, F.col(fallback) if fallback else F.lit(None), F.lit(""))
    text = F.concat_ws("\n", F.coalesce("title", F.lit("")), said)
    tags = profiles.select(account, "likes", F.explode(C.hashtags(text)).alias("tag"))
    stats = tags.groupBy(account, "tag").agg(F.count(F.lit(1)).alias("n"), F.sum("likes").alias("_likes"))
    out = stats.withColumn("mean_likes", F.bround(F.col("_likes").cast("double") / F.col("n")).cast("bigint"))
    if k is not None:
        spec = Window.partitionBy(account).orderBy(F.desc("n"), F.asc("tag"))
        out = out.withColumn("place", F.row_number().over(spec)).filter(F.col("place") <= k)
        return out.select(account, "place", "tag", "n", "mean_likes")
    return out.select(account, "tag", "n", "mean_likes")


def join_segments(
    segments: DataFrame, texts: DataFrame | None = None, *, account: str = "account", key: str = "aweme_id",
    seq: str = "seq", text: str = "text",
) -> DataFrame:
    """A post's stripped segment texts in list order, without separator.

    ``texts`` (one row per post) holds the whole texts that stand in for posts without segments or
    with nothing in them. The result is one string per post by definition, as long as its segments.
    """
    item = F.struct(seq, C.strip(F.coalesce("text", F.lit(""))).alias("text"))
    joined = segments.groupBy(account, key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["text"]), "").alias("transcript")
    )
    if texts is None:
        return joined
    whole = texts.select(account, key, C.strip(F.coalesce(text, F.lit(""))).alias("_whole"))
    both = joined.join(whole, [account, key], "full_outer")
    said = F.coalesce(F.when(F.col("transcript") != "", F.col("transcript")), F.col("_whole"), F.lit(""))
    return both.select(account, key, said.alias("transcript"))


