"""Captured comments -> deduplicated top comments per post."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators.ingest import require_key


def clean_comments(raw: DataFrame, *, key: str = "aweme_id") -> DataFrame:
    """F3 for comments: a post id and non-blank content are required."""
    rows = raw.withColumns(
        {
            "content": C.strip(F.coalesce("content", F.lit(""))),
            "comment_id": F.coalesce(F.col("comment_id").cast("string"), F.lit("")),
            "nickname": F.coalesce("nickname", F.lit("")),
            "like_count": C.count_value("like_count"),
            key: F.col(key).cast("string"),
        }
    )
    return require_key(rows, key).filter(F.col("content") != "")


def comments_of_known_posts(
    comments: DataFrame, posts: DataFrame | None, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Only comments of listed posts, when a list exists."""
    if posts is None:
        return comments
    return comments.join(posts.select(account, key), [account, key], "left_semi")


def dedup_comments(
    comments: DataFrame, *, account: str = "account", key: str = "aweme_id", seq: str = "seq"
) -> DataFrame:
    """D3: by comment id, else by content and nickname; the first row wins.

    What the key tells of a row is not carried beside it, and its place once: both are shuffled and sorted with every row.
    """
    by_id = F.coalesce(F.col("comment_id") != "", F.lit(False))
    rows = comments.withColumns(
        {
            "_id": by_id,
            "_a": F.when(by_id, F.col("comment_id")).otherwise(F.col("content")),
            "_b": F.when(by_id, "").otherwise(F.col("nickname")),
        }
    )
    told = {"comment_id": F.when(~by_id, F.col("comment_id")), "content": F.when(by_id, F.col("content")), "nickname": F.when(by_id, F.col("nickname"))}
    carried = [told.get(c, F.col(c)).alias(c) for c in comments.columns if c not in (account, key, seq)]
    kept = rows.groupBy(account, key, "_id", "_a", "_b").agg(F.min(F.struct(seq, *carried)).alias("_row"))
    back = {
        "comment_id": F.when(F.col("_id"), F.col("_a").cast(comments.schema["comment_id"].dataType)).otherwise(F.col("_row.comment_id")),
        "content": F.when(F.col("_id"), F.col("_row.content")).otherwise(F.col("_a")),
        "nickname": F.when(F.col("_id"), F.col("_row.nickname")).otherwise(F.col("_b")),
    }
    return kept.select(*[(F.col(c) if c in (account, key) else back.get(c, F.col(f"_row.{c}"))).alias(c) for c in comments.columns])


def top_comments_per_post(
    comments: DataFrame, n: int = 100, *, account: str = "account", key: str = "aweme_id",
    seq: str = "seq",
) -> DataFrame:
    """Most liked first, ties in capture order. The limit runs before the shuffle too."""
    spec = Window.partitionBy(account, key).orderBy(F.desc("like_count"), F.asc(seq))
    return comments.withColumn("pos", F.row_number().over(spec)).filter(F.col("pos") <= n)


def nest_comments(
    top: DataFrame, n: int = 100, *, account: str = "account", key: str = "aweme_id",
    pseudonyms: bool = True,
) -> DataFrame:
    """One row per post with its kept comments in order; at most ``n`` per array."""
    who = C.text_key("nickname") if pseudonyms else F.col("nickname")
    item = F.struct("pos", "content", who.alias("nickname"), "like_count", "create_time", "comment_id")
    return (
        top.groupBy(account, key)
        .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(item)).alias("_items"))
        .select(
            account,
            key,
            F.col("n").cast("int").alias("n"),
            F.lit(n).alias("max"),
            F.transform("_items", lambda c: c.dropFields("pos")).alias("comments"),
        )
    )


def comment_summary(
    unique: DataFrame, torn: DataFrame | None = None, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Totals that accompany the nested table: comments kept after dedup and posts covered.

    With ``torn`` (account, corrupt_lines_skipped) the torn lines too; an account of torn lines only has totals of 0.
    """
    per_post = unique.groupBy(account, key).agg(F.count(F.lit(1)).alias("n"))
    totals = per_post.groupBy(account).agg(
        F.sum("n").alias("total_comments"),
        F.count(F.lit(1)).alias("total_videos_with_comments"),
    )
    if torn is None:
        return totals
    return totals.join(torn.select(account, "corrupt_lines_skipped"), account, "full").na.fill(0)


def covered_ids(comments: DataFrame, *, account: str = "account", key: str = "aweme_id") -> DataFrame:
    """U3."""
    return comments.select(account, key).distinct()


def comment_with_title(
    comments: DataFrame, posts: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Title of the comment's post, empty when unknown."""
    titles = posts.select(account, key, "title")
    out = comments.join(titles, [account, key], "left")
    return out.withColumn("title", F.coalesce("title", F.lit("")))


def top_comments(
    comments: DataFrame, posts: DataFrame, k: int = 20, *, content_chars: int = 48,
    title_chars: int = 18, account: str = "account", key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """An account's most liked comments, ties by post standing and place in the post.

    ``comments`` are the kept ones of W4. The cut to ``k`` also runs ahead of the shuffle by
    account, so an account with most of the comments sends few rows per task.
    """
    best = best_comments(comments, posts, k, account=account, key=key, seq=seq)
    return clip_comments(best, k, content_chars=content_chars, title_chars=title_chars, account=account, key=key)


def best_comments(
    comments: DataFrame, posts: DataFrame, k: int = 20, *, account: str = "account", key: str = "aweme_id", seq: str = "seq"
) -> DataFrame:
    """The rows of T4 / T6 with their whole texts."""
    standing = posts.select(account, key, F.col("likes").alias("_likes"), F.col(seq).alias("_seq"), "title")
    joined = comments.join(standing, [account, key])
    spec = Window.partitionBy(account).orderBy(
        F.desc("like_count"), F.desc("_likes"), F.asc("_seq"), F.asc("pos")
    )
    placed = joined.withColumn("place", F.row_number().over(spec)).filter(F.col("place") <= k)
    return placed.select(account, "place", key, "like_count", "content", "nickname", "title")


def clip_comments(
    best: DataFrame, k: int = 20, *, content_chars: int = 48, title_chars: int = 18, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """T4 / T6 from ``best_comments`` of at least ``k``."""
    return best.filter(F.col("place") <= k).select(
        account,
        "place",
        key,
        "like_count",
        C.clip("content", content_chars).alias("content"),
        C.text_key("nickname").alias("nickname"),
        C.clip("title", title_chars).alias("title"),
    )


def build_comments(
    raw: DataFrame, posts: DataFrame | None = None, n: int = 100, *, account: str = "account",
    key: str = "aweme_id", seq: str = "seq",
) -> DataFrame:
    """Clean, keep known posts, dedup, keep the top ``n`` per post."""
    rows = comments_of_known_posts(clean_comments(raw, key=key), posts, account=account, key=key)
    unique = dedup_comments(rows, account=account, key=key, seq=seq)
    return top_comments_per_post(unique, n, account=account, key=key, seq=seq)
