"""One wide profile per post, and its text digest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.functions import columns as C


def build_profiles(
    posts: DataFrame,
    transcripts: DataFrame | None = None,
    soundtrack: DataFrame | None = None,
    frame_counts: DataFrame | None = None,
    visual: DataFrame | None = None,
    comments: DataFrame | None = None,
    *,
    tz: str = "UTC",
    account: str = "account",
    key: str = "aweme_id",
) -> DataFrame:
    """Every post with whatever was derived for it.

    All inputs have one row per post. ``transcripts`` (duration, transcript), ``soundtrack``
    (duration, bgm_level, mood, vocal, bgm_text), ``frame_counts`` (frame_count, key_frames), ``visual``
    (summary columns), ``comments`` (n, comments). Without ``frame_counts`` the frames that ``visual``
    has analysed count. The joins share one key, so the exchange of the
    posts serves all of them. Missing labels read ``?``.
    """
    out = posts.withColumnRenamed("comments", "comment_count").withColumn(
        "create_day", C.local_date("create_time", tz)
    )

    def attach(left: DataFrame, right: DataFrame | None, cols: dict[str, tuple[str, str]]) -> DataFrame:
        if right is None:
            return left.withColumns({n: F.lit(None).cast(t) for n, (_, t) in cols.items()})
        have = set(right.columns)
        picked = [
            (F.col(src) if src in have else F.lit(None).cast(t)).alias(n) for n, (src, t) in cols.items()
        ]
        return left.join(right.select(account, key, *picked), [account, key], "left")

    out = attach(out, transcripts, {"_t_dur": ("duration", "double"), "transcript": ("transcript", "string")})
    out = attach(
        out, soundtrack,
        {"_s_dur": ("duration", "double"), "bgm_level": ("bgm_level", "string"), "mood": ("mood", "string"),
         "vocal": ("vocal", "string"), "bgm_text": ("bgm_text", "string")},
    )
    counted = {"frame_count": ("frame_count", "bigint"), "key_frames": ("key_frames", "array<string>")}
    if frame_counts is not None or visual is None:
        out, counted = attach(out, frame_counts, counted), {}
    else:
        counted["frame_count"] = ("frames_analyzed", "bigint")
    out = attach(
        out, visual,
        {"visual_style": ("visual_style", "string"), "temperature": ("temperature", "string"),
         "composition": ("composition", "string"), "scene": ("scene", "string"), "ocr_status": ("ocr_status", "string"),
         **{c: (c, "double") for c in ("mean_h", "mean_s", "mean_v", "subtitle_ratio", "product_ratio")},
         "candidate_timestamps": ("candidate_timestamps", "array<double>"), **counted},
    )
    kept = "array<struct<content:string,like_count:bigint>>"
    out = attach(out, comments, {"_n": ("n", "int"), "top": ("comments", kept)})
    return out.withColumns(
        {
            "duration_sec": C.duration_seconds("_t_dur", "_s_dur"),
            **{c: F.coalesce(c, F.lit("")) for c in ("transcript", "bgm_text")},
            **{c: F.coalesce(c, F.lit("?")) for c in ("bgm_level", "mood", "vocal")},
            "frame_count": F.coalesce("frame_count", F.lit(0)).cast("bigint"),
            "comment_n": F.coalesce("_n", F.lit(0)),
        }
    ).drop("_t_dur", "_s_dur", "_n").withColumnRenamed("top", "comments")


def profile_digest(profiles: DataFrame, *, account: str = "account", key: str = "aweme_id") -> DataFrame:
    """K4: one text block per post: figures, title, transcript start, look, best comments."""
    day = F.coalesce(F.col("create_day").cast("string"), F.lit("-"))
    head = F.format_string(
        "## [%s] %s | %s | likes %s / collects %s / shares %s / comments %s (kept %s) | %ss | music %s/%s",
        F.col("rank").cast("string"), F.col(key), day, *[F.col(c).cast("string") for c in
        ("likes", "collects", "shares", "comment_count", "comment_n", "duration_sec")],
        "bgm_level", "mood",
    )
    spoken = F.when(F.col("transcript") == "", "(no speech)").otherwise(C.clip("transcript", 200))
    look = F.when(
        F.col("visual_style").isNotNull(),
        F.concat_ws(" | ", F.concat(F.lit("- look: "), F.col("visual_style")), "temperature", "composition", "scene"),
    )
    best = F.transform(F.slice("comments", 1, 3), lambda c: F.left(c["content"], F.lit(30)))
    said = F.when(F.col("comment_n") > 0, F.concat(F.lit("- top comments: "), F.array_join(best, " / ")))
    text = F.concat_ws(
        "\n", head, F.concat(F.lit("- title: "), F.col("title")), F.concat(F.lit("- speech: "), spoken), look, said
    )
    return profiles.select(account, key, "rank", text.alias("digest"))
