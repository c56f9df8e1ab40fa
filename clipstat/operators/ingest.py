"""Captured post records -> one normalised, ranked row per post."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.session import stage
from clipstat.skew import down, ordered

# Contract words of the published data.
MIXED_TRACK, MISSING = "mixed_track", "missing"
VIDEO_SPEECH = "local_video_then_remote_video"

_STATISTICS = {
    "liked_count": "digg_count",
    "comment_count": "comment_count",
    "collected_count": "collect_count",
    "share_count": "share_count",
}


def flatten_post(df: DataFrame) -> DataFrame:
    """Nested ``statistics`` counters win over the flat ones."""
    if "statistics" not in df.columns:
        return df
    nested = df.schema["statistics"].dataType.names
    cols = {}
    for flat, name in _STATISTICS.items():
        if name in nested:
            inner = C.filled(F.col(f"statistics.{name}").cast("string"))
            cols[flat] = F.coalesce(inner, F.col(flat).cast("string")) if flat in df.columns else inner
    return df.withColumns(cols)


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """drop rows whose key is NULL or empty."""
    for key in keys:
        df = df.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return df


def matches_keyword(keyword: str | None) -> Column:
    """the keyword occurs in description, nickname or author word."""
    if not keyword:
        return F.lit(True)
    parts = [F.coalesce(F.col(c), F.lit("")) for c in ("desc", "nickname", "author_word")]
    return F.concat_ws("|", *parts).contains(F.lit(keyword))


def keyword_filter(df: DataFrame, keyword: str | None) -> DataFrame:
    return df.filter(matches_keyword(keyword))


def dedup_first(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """The first row per key. Partial results combine before the shuffle."""
    kept = df.groupBy(*keys).agg(F.min_by(_payload(df, keys), F.col(seq)).alias("_row"))
    return kept.select(*_unpacked(df, keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Payload of the last row at the position of the first one (``first_seq``)."""
    kept = df.groupBy(*keys).agg(F.max_by(_payload(df, keys), F.col(seq)).alias("_row"), F.min(seq).alias("first_seq"))
    return kept.select(*_unpacked(df, keys), "first_seq")


def _payload(df: DataFrame, keys: Sequence[str]) -> Column:
    """All columns but the keys, which the grouping has: where only keys are asked for, no row is carried."""
    return F.struct(*[c for c in df.columns if c not in keys])


def _unpacked(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]


def hard_limit(
    df: DataFrame, n: int | None, *, account: str = "account", order: str = "first_seq"
) -> DataFrame:
    """First ``n`` posts per account in first-seen order."""
    if n is None:
        return df
    spec = Window.partitionBy(account).orderBy(order)
    return df.withColumn("_n", F.row_number().over(spec)).filter(F.col("_n") <= n).drop("_n")


def normalize_counts(df: DataFrame) -> DataFrame:
    """the four counters as bigint plus a flag for unreadable text."""
    names = {
        "likes": "liked_count",
        "comments": "comment_count",
        "collects": "collected_count",
        "shares": "share_count",
    }
    bad = F.lit(False)
    for source in names.values():
        bad = bad | C.count_is_bad(source)
    return df.withColumns({**{n: C.count_value(s) for n, s in names.items()}, "bad_count": bad})


def split_media_type(df: DataFrame) -> DataFrame:
    """F5."""
    return df.withColumn("is_note", C.is_note("aweme_type"))


def resolve_title(desc: str = "desc", title: str = "title") -> Column:
    """F6."""
    return F.coalesce(C.filled(desc), C.filled(title), F.lit(""))


def resolve_audio(df: DataFrame) -> DataFrame:
    """published audio, its key and kind, the speech source, and the legacy audio fields."""
    music = F.coalesce(C.filled("music_download_url"), C.filled("music_url"), F.lit(""))
    video = F.coalesce("video_download_url", F.lit(""))
    out = df.withColumns({"video_url": video, "_music": music})
    has_music, has_video = F.col("_music") != "", F.col("video_url") != ""
    return out.withColumns(
        {
            "music_url": F.col("_music"),
            "music_key": C.url_key("_music"),
            "published_audio_url": F.col("_music"),
            "published_audio_key": C.url_key("_music"),
            "published_audio_kind": F.when(has_music, MIXED_TRACK).otherwise(MISSING),
            "speech_url": F.col("video_url"),
            "speech_source": F.when(has_video, VIDEO_SPEECH).otherwise(MISSING),
            "audio_url": F.when(has_music, F.col("_music")).otherwise(F.col("video_url")),
            "audio_source": F.when(has_music, "music_download_url")
            .when(has_video, "video_download_url")
            .otherwise(MISSING),
        }
    ).drop("_music")


def speech_source_rows(posts: DataFrame, *, account: str = "account", key: str = "aweme_id") -> DataFrame:
    """F8: videos with their speech URL and published audio, legacy fields as fallback."""
    legacy = F.when(
        F.col("audio_source").isin("music_url", "music_download_url"),
        F.coalesce("audio_url", F.lit("")),
    ).otherwise("")
    url = F.coalesce(C.filled("published_audio_url"), C.filled("music_url"), legacy)
    rows = require_key(posts, key).filter(~C.is_note("aweme_type")).withColumn("_url", url)
    stored = F.coalesce(C.filled("published_audio_key"), C.filled("music_key"), C.url_key("_url"))
    return rows.select(
        account,
        key,
        F.coalesce(C.filled("speech_url"), C.filled("video_url"), F.lit("")).alias("speech_url"),
        F.coalesce(C.filled("speech_source"), F.lit(VIDEO_SPEECH)).alias("speech_source"),
        F.col("_url").alias("published_url"),
        F.when(F.col("_url") == "", "").otherwise(stored).alias("published_key"),
    )


def music_rows(posts: DataFrame, *, account: str = "account", key: str = "aweme_id") -> DataFrame:
    """videos with their music URL; never falls back to the video."""
    url = F.coalesce("music_url", F.lit(""))
    stored = F.coalesce(C.filled("music_key"), C.url_key(url))
    return (
        require_key(posts, key)
        .filter(~C.is_note("aweme_type"))
        .select(
            account,
            key,
            url.alias("music_url"),
            F.when(url == "", "").otherwise(stored).alias("music_key"),
        )
    )


def completeness_gate(df: DataFrame) -> Column:
    """the record has everything later stages need. Columns that do not exist count as NULL."""

    def text(name: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")

    def nested(path: str) -> Column:
        top = path.split(".")[0]
        if top not in df.columns:
            return F.lit(None)
        kind = df.schema[top].dataType
        for part in path.split(".")[1:]:
            if not hasattr(kind, "names") or part not in kind.names:
                return F.lit(None)
            kind = kind[part].dataType
        return F.col(path)

    def urls(*paths: str) -> Column:
        found = F.lit(0)
        for path in reversed(paths):
            links = nested(path).cast("array<string>")
            n = F.size(F.filter(F.coalesce(links, F.array().cast("array<string>")), lambda u: u != ""))
            found = F.when(n > 0, n).otherwise(found)
        return found

    known = (C.filled(text("aweme_id")).isNotNull()) & (text("desc").isNotNull() | text("title").isNotNull())
    known = known & C.filled(text("create_time")).isNotNull()
    known = known & (
        C.filled(text("aweme_type")).isNull() | text("aweme_type").try_cast("int").isNotNull()
    )
    for flat, name in _STATISTICS.items():
        inner = nested(f"statistics.{name}").cast("string")
        value = F.coalesce(inner, text(name), text(flat))
        known = known & C.filled(value).isNotNull()
    flat_media = C.filled(text("video_download_url")).isNotNull() & C.filled(text("cover_url")).isNotNull()
    note_text = C.filled(text("note_download_url"))
    if "images" in df.columns:
        image_hit = F.exists(
            F.coalesce(F.col("images"), F.array().cast(df.schema["images"].dataType)),
            lambda i: F.exists(
                F.coalesce(i["origin_url"]["url_list"], F.array().cast("array<string>")),
                lambda u: u != "",
            ),
        )
    else:
        image_hit = F.lit(False)
    note_ok = F.when(note_text.isNotNull(), F.size(C.comma_list(note_text)) > 0).otherwise(image_hit)
    plays = urls("video.play_addr_h264.url_list", "video.play_addr_256.url_list", "video.play_addr.url_list")
    cover = F.when(nested("video.raw_cover").isNotNull(), urls("video.raw_cover.url_list")).otherwise(
        urls("video.origin_cover.url_list")
    )
    video_ok = (plays >= 2) & (cover >= 2)
    media = flat_media | F.when(C.is_note(text("aweme_type")), note_ok).otherwise(video_ok)
    return F.coalesce(known & media, F.lit(False))


def union_runs(*runs: DataFrame) -> DataFrame:
    """All runs' records in one table; missing columns become NULL."""
    out = runs[0]
    for run in runs[1:]:
        out = out.unionByName(run, allowMissingColumns=True)
    return out


def completed_runs_only(
    records: DataFrame, run_state: DataFrame, *, run: str = "run_id", status: str = "status"
) -> DataFrame:
    """Records of failed or partial runs are never processed."""
    done = run_state.filter(F.col(status) == "completed").select(run)
    return records.join(done, run, "left_semi")


def order_by_targets(
    posts: DataFrame, targets: DataFrame, *, account: str = "account", key: str = "aweme_id",
    pos: str = "pos",
) -> DataFrame:
    """Requested posts only; ``targets`` has a row per request with its place (first mention wins)."""
    asked = targets.groupBy(account, key).agg(F.min(pos).alias(pos))
    return posts.join(asked, [account, key])


def ingest_counters(
    raw: DataFrame, *, keyword: str | None = None, limit: int | None = None,
    account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """Rows read, matched, unique before the limit, unique kept."""
    hit = matches_keyword(keyword)
    has_key = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    per_key = raw.groupBy(account, key).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(hit).alias("matched"),
        F.max(F.when(hit & has_key, 1).otherwise(0)).alias("uniq"),
    )
    out = per_key.groupBy(account).agg(
        F.sum("total").alias("total"),
        F.sum("matched").alias("matched"),
        F.sum("uniq").cast("bigint").alias("unique_before_limit"),
    )
    kept = F.col("unique_before_limit")
    if limit is not None:
        kept = F.least(kept, F.lit(limit).cast("bigint"))
    return out.withColumn("unique_kept", kept)


def rank_posts(
    posts: DataFrame, *, account: str = "account", seq: str = "first_seq"
) -> DataFrame:
    """Rank by likes, ties by first appearance."""
    return ordered(posts, [account], [F.desc("likes"), F.asc(seq)], slice_by=down("likes"), rank="rank")


def build_posts(
    raw: DataFrame,
    *,
    account: str = "account",
    key: str = "aweme_id",
    seq: str = "seq",
    policy: str = "latest",
    keyword: str | None = None,
    max_posts: int | None = None,
) -> DataFrame:
    """Captured records to the ranked post table. ``policy`` picks the payload of repeats."""
    rows = keyword_filter(flatten_post(require_key(raw, key)), keyword)
    # Records are compared with what a post needs of them and no more.
    rows = rows.select(
        account, key, F.col(seq).alias("_at"), "aweme_type", resolve_title().alias("title"), "create_time", "liked_count", "comment_count",
        "collected_count", "share_count", "video_download_url", "cover_url", "music_download_url", "music_url", "note_download_url",
    )
    if policy == "latest":
        unique = dedup_latest(rows, [account, key], "_at")
    else:
        unique = dedup_first(rows, [account, key], "_at").withColumn("first_seq", F.col("_at"))
    # Ranking reads the posts twice; they are ranked before their longer derived texts are made.
    unique = stage(normalize_counts(hard_limit(unique.drop("_at"), max_posts, account=account)), "unique")
    return resolve_audio(rank_posts(unique, account=account)).select(
        account,
        F.col(key).cast("string").alias(key),
        F.coalesce(F.col("aweme_type").cast("string").try_cast("int"), F.lit(0)).alias("aweme_type"),
        "title",
        F.col("create_time").cast("string").try_cast("bigint").alias("create_time"),
        "likes", "comments", "collects", "shares", "bad_count",
        "video_url",
        F.coalesce("cover_url", F.lit("")).alias("cover_url"),
        "music_url", "music_key", "published_audio_url", "published_audio_key",
        "published_audio_kind", "speech_url", "speech_source", "audio_url", "audio_source",
        C.comma_list("note_download_url").alias("note_urls"),
        "first_seq", "rank",
    )


def dedup_ids(texts: DataFrame, text: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """Target ids named in a text, in order, each once."""
    return texts.select(*keep, C.long_ids(text).alias("ids"))


