"""Soundtrack evidence: audio features, classification, and engagement by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import arrays as A
from clipstat.functions import columns as C
from clipstat.operators.intervals import non_speech_windows
from clipstat.session import ship_package
from clipstat.skew import ordered, up

# Contract words and labels other results depend on.
ARCHIVE_VERSION = "published-mixed-track-bgm-v3"
SOURCE_KIND = "mixed_track"
SCOPE = "non_speech_windows"
LEVELS = ("none", "light", "full")
LEVEL_LABELS = {"none": "no clear background music", "light": "light background music", "full": "strong background music"}
MOOD_BEAT = "强节奏/重鼓点"
MOOD_BRIGHT = "明快节奏"
MOOD_CALM = "平静铺垫"
MOOD_STORY = "叙事起伏"

MIN_SECONDS, MIN_COVERAGE, SPEECH_PAD = 3.0, 0.10, 0.15
NOTE_NO_MASK = "no valid transcript segments, speech cannot be excluded"
NOTE_TOO_LITTLE = "non-speech windows below the minimum length or share"
NOTE_CANDIDATE = "candidate from the mixed track, not a separated music track"


def status_of() -> Column:
    """``analysis_status``, else ``source_status``, else unknown."""
    return F.coalesce(C.filled("analysis_status"), C.filled("source_status"), F.lit("unknown"))


def contract_check(records: DataFrame) -> DataFrame:
    """marks records of another archive version, source kind or scope."""
    ok = (
        F.col("cache_version").eqNullSafe(ARCHIVE_VERSION)
        & F.col("source_kind").eqNullSafe(SOURCE_KIND)
        & F.col("analysis_scope").eqNullSafe(SCOPE)
    )
    return records.withColumn("contract_ok", ok)


def evidence_gate(
    records: DataFrame, posts: DataFrame, min_seconds: float = MIN_SECONDS,
    min_coverage: float = MIN_COVERAGE, *, account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """F11 + J8: soundtrack records with their video's engagement; ``evidence`` tells which count.

    Records without a matching video stay (left join) and never count.
    """
    videos = posts.filter(~C.is_note("aweme_type")).select(
        account, key, F.lit(True).alias("_video"), "likes", "collects", "shares", "comments", "seq"
    )
    ok = (
        (status_of() == "ok")
        & (F.col("source_kind") == SOURCE_KIND)
        & (F.col("analysis_scope") == SCOPE)
        & (F.coalesce("non_speech_seconds", F.lit(0.0)) >= min_seconds)
        & (F.coalesce("non_speech_coverage", F.lit(0.0)) >= min_coverage)
        & F.col("bgm_level").isin(*LEVELS)
        & F.col("_video").isNotNull()
    )
    joined = records.join(videos, [account, key], "left")
    return joined.withColumn("evidence", F.coalesce(ok, F.lit(False))).drop("_video")


def evidence_with_engagement(gated: DataFrame) -> DataFrame:
    """J8."""
    return gated.filter("evidence")


def status_counts(gated: DataFrame, *, account: str = "account") -> DataFrame:
    """Records per status, in all and among the excluded ones."""
    return gated.groupBy(account, status_of().alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("evidence")).alias("excluded")
    )


def group_engagement(gated: DataFrame, *, account: str = "account") -> DataFrame:
    """Engagement by level, mood and vocal: grouping sets over the sums of each combination."""
    rows = gated.filter("evidence").withColumns(
        {c: F.coalesce(c, F.lit("unknown")) for c in ("bgm_level", "mood", "vocal")}
    )
    rows = rows.groupBy(account, "bgm_level", "mood", "vocal").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(m).alias(m) for m in ("likes", "collects", "shares")]
    )
    sets = [[F.col(account), F.col(c)] for c in ("bgm_level", "mood", "vocal")]
    agg = rows.groupingSets(sets, account, "bgm_level", "mood", "vocal").agg(
        F.grouping_id().alias("_set"),
        F.sum("_n").alias("n"),
        *[F.sum(m).alias(f"_{m}") for m in ("likes", "collects", "shares")],
    )
    dimension = F.when(F.col("_set") == 3, "by_level").when(F.col("_set") == 5, "by_mood").otherwise("by_vocal")
    value = F.coalesce("bgm_level", "mood", "vocal")
    out = agg.select(account, dimension.alias("dimension"), value.alias("value"), "n", "_likes", "_collects", "_shares")
    whole = Window.partitionBy(account, "dimension")
    mean = {m: F.bround(F.col(f"_{m}").cast("double") / F.col("n"), 1) for m in ("likes", "collects", "shares")}
    label = F.when(F.col("dimension") == "by_level", C.label_of("value", LEVEL_LABELS)).otherwise(F.col("value"))
    return out.select(
        account, "dimension", "value", label.alias("label"), "n",
        F.bround(C.percent("n", F.sum("n").over(whole)), 1).alias("pct"),
        *[mean[m].alias(f"avg_{m}") for m in mean],
        *[(F.col(f"_{m}").cast("double") / F.col("n")).alias(f"exact_{m}") for m in mean],
    )


def group_multipliers(groups: DataFrame, *, account: str = "account") -> DataFrame:
    """Light over none, from the rounded means (parity) and from the exact ones."""
    level = groups.filter("dimension = 'by_level'")

    def of(value: str, c: str) -> Column:
        return F.max(F.when(F.col("value") == value, F.col(c)))

    names = {"likes": "like", "collects": "collect", "shares": "share"}
    sides = [of(v, f"{kind}_{m}").alias(f"{v}_{kind}_{m}") for m in names for v in ("none", "light") for kind in ("avg", "exact")]
    wide = level.groupBy(account).agg(*sides)
    cols = []
    for m, short in names.items():
        cols.append(F.bround(C.ratio(f"light_avg_{m}", f"none_avg_{m}"), 3).alias(f"{short}_mult"))
        cols.append(F.bround(C.ratio(f"light_exact_{m}", f"none_exact_{m}"), 3).alias(f"{short}_mult_exact"))
    return wide.filter("none_avg_likes is not null and light_avg_likes is not null").select(account, *cols)


def mood_leader(groups: DataFrame, *, account: str = "account") -> DataFrame:
    """Moods by mean likes, best first."""
    spec = Window.partitionBy(account).orderBy(F.desc("avg_likes"), F.asc("value"))
    return groups.filter("dimension = 'by_mood'").select(
        account, F.row_number().over(spec).alias("place"), F.col("value").alias("mood"), "avg_likes", "n"
    )


def top_soundtrack_posts(
    gated: DataFrame, k: int = 10, *, account: str = "account", key: str = "aweme_id", seq: str = "seq"
) -> DataFrame:
    """T8."""
    spec = Window.partitionBy(account).orderBy(F.desc("likes"), F.asc(seq))
    return (
        gated.filter("evidence")
        .withColumn("place", F.row_number().over(spec))
        .filter(F.col("place") <= k)
        .select(
            account, "place", key, "likes",
            *[F.coalesce(c, F.lit("unknown")).alias(c) for c in ("bgm_level", "mood", "vocal")],
            "non_speech_seconds",
        )
    )


def cross_header(gated: DataFrame, posts: DataFrame, *, account: str = "account") -> DataFrame:
    """Counts that head the soundtrack section."""
    videos = posts.filter(~C.is_note("aweme_type")).groupBy(account).agg(
        F.count(F.lit(1)).alias("total_video_records")
    )
    counted = gated.groupBy(account).agg(
        F.count_if("evidence").alias("n"), F.count_if(~F.col("evidence")).alias("excluded_records")
    )
    return videos.join(counted, account, "left").select(
        account, "total_video_records",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "excluded_records")],
    )


# ---- audio features -------------------------------------------------------------------------


def window_pieces(
    blocks: DataFrame, windows: DataFrame, *, account: str = "account", key: str = "aweme_id",
    block_samples: int, rate: int = A.RATE
) -> DataFrame:
    """The parts of fixed-size audio blocks inside the windows, with their place in the
    concatenated non-speech audio.

    Windows meet blocks by block number, so only overlapping pairs are formed. ``at`` is the sample
    position inside the concatenated audio: window lengths before it plus the offset in the window.
    """
    bounds = windows.select(
        account, key,
        F.greatest(F.bround(F.col("start") * rate).cast("bigint"), F.lit(0)).alias("lo"),
        F.bround(F.col("end") * rate).cast("bigint").alias("hi"),
    )
    length = blocks.groupBy(account, key).agg(
        F.max(F.col("block_no") * block_samples + F.col("samples")).alias("_all")
    )
    bounds = bounds.join(length, [account, key]).withColumn("hi", F.least("hi", "_all")).filter("hi > lo")
    placed = ordered(
        bounds.withColumn("_len", F.col("hi") - F.col("lo")), [account, key], [F.asc("lo")],
        slice_by=up("lo"), running_sum={"_upto": "_len"}
    ).withColumn("base", F.col("_upto") - F.col("_len"))
    spread = placed.withColumn(
        "block_no",
        F.explode(
            F.sequence(
                F.floor(F.col("lo") / block_samples).cast("bigint"),
                F.floor((F.col("hi") - 1) / block_samples).cast("bigint"),
            )
        ),
    )
    first = F.col("block_no") * block_samples
    piece = spread.withColumns(
        {
            "cut_from": F.greatest(F.col("lo"), first) - first,
            "cut_to": F.least(F.col("hi"), first + block_samples) - first,
            "at": F.col("base") + F.greatest(F.col("lo"), first) - F.col("lo"),
        }
    ).select(account, key, "block_no", "cut_from", "cut_to", "at")
    return blocks.join(piece, [account, key, "block_no"]).select(
        account, key, "at",
        F.substring("pcm", F.col("cut_from").cast("int") * 2 + 1, (F.col("cut_to") - F.col("cut_from")).cast("int") * 2).alias("pcm"),
    )


def reblock(
    pieces: DataFrame, size: int = 16384, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Pieces of 16-bit audio to equal blocks of the concatenated audio, each with the first
    samples of the next block attached. Groups hold at most ``size`` samples."""
    n = (F.octet_length("pcm") / 2).cast("bigint")
    cells = pieces.withColumn("n", n).filter("n > 0").withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("at") / size).cast("bigint"), F.floor((F.col("at") + F.col("n") - 1) / size).cast("bigint")
            )
        ),
    )
    lo = F.greatest(F.col("at"), F.col("cell") * size)
    hi = F.least(F.col("at") + F.col("n"), (F.col("cell") + 1) * size)
    cut = cells.select(
        account, key, "cell", lo.alias("lo"),
        F.substring("pcm", ((lo - F.col("at")) * 2 + 1).cast("int"), ((hi - lo) * 2).cast("int")).alias("pcm"),
    )
    whole = cut.groupBy(account, key, "cell").agg(
        F.array_sort(F.collect_list(F.struct(F.col("lo"), F.hex("pcm").alias("h")))).alias("_parts")
    ).select(
        account, key, "cell", F.unhex(F.array_join(F.transform("_parts", lambda p: p["h"]), "")).alias("pcm")
    )
    head = whole.select(
        account, key, (F.col("cell") - 1).alias("cell"),
        F.substring("pcm", F.lit(1), F.lit(2 * A.FRAME_SAMPLES)).alias("next_pcm"),
    )
    return whole.join(head, [account, key, "cell"], "left")


def audio_block_sums(
    cells: DataFrame, size: int = 16384, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """V6 + V7 per block: RMS frame sums and low-frequency sums of all audio; blocks are independent."""
    if size % A.FFT_SIZE:
        raise ValueError("the block size must be a multiple of the FFT size")
    keys = cells.select(account, key).schema.fields
    ship_package(cells.sparkSession)

    def samples(pcm: bytes | None) -> np.ndarray:
        return np.frombuffer(pcm or b"", dtype="<i2").astype(np.float32) / 32768.0

    def sums(cell: int, pcm: bytes, tail: bytes | None) -> tuple:
        body = samples(pcm)
        wide = np.concatenate((body, samples(tail)))
        # Frames start on hops of the whole audio; those that start in this block are its own.
        skip = -int(cell) * size % A.HOP_SAMPLES
        room = min(len(body) - 1, len(wide) - A.FRAME_SAMPLES) - skip
        frames = A.energy_sums(wide[skip:], room // A.HOP_SAMPLES + 1) if room >= 0 else (0, 0.0, 0.0, 0)
        return (len(body), *frames, *A.spectrum_sums(body))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [sums(*row) for row in zip(pdf["cell"], pdf["pcm"], pdf["next_pcm"])]
            out = pd.DataFrame(rows, columns=["samples", "frames", "rms_sum", "square_sum", "silent", "low", "total"])
            yield pd.concat([pdf[[account, key, "cell"]].reset_index(drop=True), out], axis=1)

    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys)
    schema = (
        f"{head}, cell bigint, samples bigint, frames bigint, rms_sum double, square_sum double, "
        "silent bigint, low double, total double"
    )
    return cells.select(account, key, "cell", "pcm", "next_pcm").mapInPandas(run, schema)


def audio_features(
    sums: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """V6 + V7: energy, its deviation, silence and low-frequency share per post.

    Audio shorter than one frame has no features.
    """
    agg = sums.groupBy(account, key).agg(
        F.sum("samples").alias("samples"), F.sum("frames").alias("frames"),
        F.sum("rms_sum").alias("_r"), F.sum("square_sum").alias("_q"), F.sum("silent").alias("_s"),
        F.sum("low").alias("_l"), F.sum("total").alias("_t"),
    )
    n = F.col("frames").cast("double")
    mean = F.col("_r") / n
    spread = F.sqrt(F.greatest(F.col("_q") / n - mean * mean, F.lit(0.0)))
    low = F.when(F.col("samples") < 1024, 0.0).otherwise(F.col("_l") / (F.col("_t") + 1e-9))
    real = F.col("frames") > 0
    return agg.select(
        account, key, "samples",
        F.when(real, mean).alias("energy"),
        F.when(real, spread).alias("energy_var"),
        F.when(real, F.col("_s") / n).alias("silence"),
        F.when(real, low).alias("lfe_ratio"),
    )


def classify_soundtrack(features: DataFrame) -> DataFrame:
    """V8: level and mood from the unrounded features, then the features rounded."""
    e, v, lfe = F.col("energy"), F.col("energy_var"), F.col("lfe_ratio")
    level = (
        F.when(e.isNull(), "unknown")
        .when(lfe >= 0.55, F.when(e >= 0.18, "full").otherwise("light"))
        .when(lfe >= 0.35, F.when(e < 0.25, "light").otherwise("full"))
        .when((e >= 0.12) & (v < 0.15), "light")
        .otherwise("none")
    )
    mood = (
        F.when(e.isNull(), "unknown")
        .when(e >= 0.32, F.when(v < 0.12, MOOD_BEAT).otherwise(MOOD_BRIGHT))
        .when(e <= 0.10, MOOD_CALM)
        .when(v >= 0.10, MOOD_STORY)
        .otherwise(MOOD_BRIGHT)
    )
    return features.withColumns({"bgm_level": level, "mood": mood, "vocal": F.lit("unknown")}).withColumns(
        {
            "energy": F.bround("energy", 4), "energy_var": F.bround("energy_var", 4),
            "silence": F.bround("silence", 3), "lfe_ratio": F.bround("lfe_ratio", 3),
        }
    )


def soundtrack_record(
    durations: DataFrame, segments: DataFrame, features: DataFrame | None = None,
    min_seconds: float = MIN_SECONDS, min_coverage: float = MIN_COVERAGE, pad: float = SPEECH_PAD, *,
    account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """V9: one record per post: window status, non-speech seconds and share, gate and class.

    ``durations`` lists the posts with their audio length, ``features`` the V8 result.
    """
    windows = non_speech_windows(segments, durations, pad, account=account, key=key)
    free = windows.groupBy(account, key).agg(
        F.bround(F.sum((F.col("end") - F.col("start")).cast("decimal(18,3)")), 3).cast("double").alias("_free"),
        F.count(F.lit(1)).alias("n_windows"),
    )
    usable = segments.join(durations, [account, key]).filter(
        F.least(F.col("end"), F.col("duration")) > F.greatest(F.col("start"), F.lit(0.0))
    ).select(account, key).distinct().withColumn("_mask", F.lit(True))
    transcribed = segments.select(account, key).distinct().withColumn("_seen", F.lit(True))
    out = (
        durations.join(free, [account, key], "left")
        .join(usable, [account, key], "left")
        .join(transcribed, [account, key], "left")
    )
    seconds = F.coalesce("_free", F.lit(0.0))
    share = F.when(F.col("duration") > 0, seconds / F.col("duration")).otherwise(0.0)
    status = F.when(F.col("_mask"), "segment_mask").when(F.col("_seen"), "missing_segments").otherwise("missing_transcript")
    enough = (seconds >= min_seconds) & (share >= min_coverage)
    out = out.withColumns(
        {
            "transcript_status": status,
            "non_speech_seconds": seconds,
            "non_speech_coverage": F.bround(share, 4),
            "n_windows": F.coalesce("n_windows", F.lit(0)),
            "_ok": F.coalesce(F.col("_mask") & enough, F.lit(False)),
        }
    ).withColumns(
        {
            "analysis_status": F.when(F.col("_ok"), "ok").otherwise("insufficient_evidence"),
            "limitation": F.when(F.col("_mask").isNull(), NOTE_NO_MASK)
            .when(~F.col("_ok"), NOTE_TOO_LITTLE)
            .otherwise(NOTE_CANDIDATE),
            "cache_version": F.lit(ARCHIVE_VERSION),
            "source_kind": F.lit(SOURCE_KIND),
            "analysis_scope": F.lit(SCOPE),
        }
    )
    words = ("bgm_level", "mood", "vocal")
    if features is not None:
        found = features.select(account, key, *words, "energy", "energy_var", "silence", "lfe_ratio")
        out = out.join(found, [account, key], "left")
        for c in words:
            out = out.withColumn(c, F.when(F.col("_ok"), F.coalesce(c, F.lit("unknown"))).otherwise("unknown"))
    else:
        out = out.withColumns({c: F.lit("unknown") for c in words})
    return out.drop("_free", "_mask", "_seen", "_ok")
