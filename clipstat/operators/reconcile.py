"""Audits: counts against published totals, missing artefacts, identities, logs and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C


def missing_artifacts(
    posts: DataFrame, records: DataFrame, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """Videos without a record; any row is an error for the caller."""
    return posts.filter(~C.is_note("aweme_type")).select(account, key).join(
        records.select(account, key), [account, key], "left_anti"
    )


def missing_ids(
    expected: DataFrame, found: DataFrame, preview: int = 10, *, account: str = "account", key: str = "aweme_id"
) -> DataFrame:
    """How many expected ids are missing per account, with the first few in order."""
    gone = expected.select(account, key).subtract(found.select(account, key))
    spec = Window.partitionBy(account).orderBy(key)
    heads = gone.withColumn("_n", F.row_number().over(spec)).filter(F.col("_n") <= preview).groupBy(account).agg(
        F.array_join(F.array_sort(F.collect_list(key)), ",").alias("preview")
    )
    return gone.groupBy(account).agg(F.count(F.lit(1)).alias("missing")).join(heads, account)


def reconcile_counts(
    posts: DataFrame, creator_counts: DataFrame, max_posts: int = 100, *, account: str = "account"
) -> DataFrame:
    """Captured posts against the published total."""
    got = posts.groupBy(account).agg(F.count(F.lit(1)).alias("captured"))
    total = F.col("aweme_count")
    status = (
        F.when(total.isNull() | (total <= 0), "unknown")
        .when(F.col("captured") >= total, "ok")
        .when(F.col("captured") >= max_posts, "capped")
        .otherwise("incomplete")
    )
    return got.join(creator_counts.select(account, "aweme_count"), account, "left").select(
        account, "captured", "aweme_count", status.alias("status"),
        F.when(total > 0, F.greatest(total - F.col("captured"), F.lit(0))).alias("missing"),
    )


def identity_guard(records: DataFrame, *, account: str = "account", creator: str = "sec_uid") -> DataFrame:
    """Accounts bound to more than one creator, or with an invalid slug."""
    per = records.groupBy(account).agg(
        F.count_distinct(creator).alias("creators"), F.min(creator).alias("first_creator")
    )
    return per.withColumn("slug_ok", C.valid_slug(account)).filter((F.col("creators") > 1) | ~F.col("slug_ok"))


def explicit_zero_coverage(
    posts: DataFrame, skipped: DataFrame, targets: DataFrame | None = None, *, account: str = "account",
    key: str = "aweme_id", comment_count: str = "comment_count",
) -> DataFrame:
    """U4: may a comment file be absent? Only if the captured posts are exactly the targets, all
    were skipped, and all say zero comments. Accounts without targets are false."""
    rows = posts.groupBy(account, key).agg(
        F.lit(True).alias("_row"), F.max(F.coalesce(C.strict_int(comment_count) != 0, F.lit(True))).alias("_some")
    )
    asked = (rows if targets is None else targets).select(account, key).distinct().withColumn("_asked", F.lit(True))
    skips = skipped.select(account, key).distinct().withColumn("_skip", F.lit(True))
    both = rows.join(asked, [account, key], "full").join(skips, [account, key], "left")
    good = F.col("_row") & F.col("_asked") & F.col("_skip") & ~F.col("_some")
    return both.groupBy(account).agg(
        F.bool_and(F.coalesce(good, F.lit(False))).alias("zero_ok"), F.count(F.lit(1)).alias("targets")
    )


def skip_counters(log: DataFrame, *, account: str = "account", line: str = "value") -> DataFrame:
    """Marker counts and distinct skipped ids in a crawl log."""
    zero = F.col(line).contains("skipped_zero_comments")
    saved = F.col(line).contains("saved_detail_requests")
    found = C.filled(F.regexp_extract(line, r"skipped_zero_comments aweme_id:(\S+)", 1))
    rows = log.filter(zero | saved).select(account, zero.alias("z"), saved.alias("s"), found.alias("id"))
    per_id = rows.groupBy(account, "id").agg(F.count_if("z").alias("z"), F.count_if("s").alias("s"))
    return per_id.groupBy(account).agg(
        F.sum("s").alias("saved_detail_requests"),
        F.sum("z").alias("skipped_comment_requests"),
        F.sum("z").alias("skipped_zero_comments"),
        F.count("id").alias("skipped_ids"),
    )


def stage_metrics(events: DataFrame, *, run: str = "run_id", stage: str = "stage", seq: str = "seq") -> DataFrame:
    """Per run and stage: duration, items, throughput, most frequent backend, status.

    Each event has ``duration_sec``, ``items``, ``backend`` and ``returncode``.
    """
    group = [run, stage]
    per_backend = events.groupBy(*group, "backend").agg(
        F.count(F.lit(1)).alias("_n"), F.min(seq).alias("_first"),
        F.sum(F.col("duration_sec").cast("decimal(18,3)")).alias("_d"), F.sum("items").alias("_i"),
        F.max(F.when(F.coalesce("returncode", F.lit(1)) != 0, 1).otherwise(0)).alias("_bad"),
    )
    order = F.when(C.filled("backend").isNotNull(), F.struct(-F.col("_n"), F.col("_first")))
    out = per_backend.groupBy(*group).agg(
        F.sum("_d").cast("double").alias("duration_sec"), F.sum("_i").alias("items"),
        F.min_by("backend", order).alias("backend"), F.max("_bad").alias("_bad"),
    )
    rate = F.when(F.col("duration_sec") > 0, F.bround(F.col("items") / F.col("duration_sec"), 3)).otherwise(0.0)
    return out.select(
        *group, "duration_sec", "items", rate.alias("throughput"), "backend",
        F.when(F.col("_bad") == 0, "completed").otherwise("failed").alias("status"),
    )


def artifact_counts(
    transcripts: DataFrame, frame_posts: DataFrame, soundtrack: DataFrame, summaries: DataFrame, *,
    account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """Finished posts (and frames) per stage and account. ``frame_posts`` has one row per post
    with ``completed`` and ``frames``; soundtrack counts evidence only."""

    def stage(df: DataFrame, name: str, items, frames=None) -> DataFrame:
        return df.groupBy(account).agg(
            items.cast("bigint").alias("items"),
            (F.lit(0) if frames is None else frames).cast("bigint").alias("frames"),
        ).withColumn("stage", F.lit(name))

    everything = F.count(F.lit(1))
    return (
        stage(transcripts.select(account, key).distinct(), "transcribe", everything)
        .unionByName(stage(frame_posts, "extract_frames", F.count_if("completed"), F.sum("frames")))
        .unionByName(stage(soundtrack, "transcribe_bgm", F.count_if("evidence")))
        .unionByName(stage(summaries.select(account, key), "analyze_frames", everything))
    )


def source_inventory(
    posts: DataFrame, *, transcripts: DataFrame | None = None, comments: DataFrame | None = None,
    frames: DataFrame | None = None, soundtrack: DataFrame | None = None, covers: DataFrame | None = None,
    visual: DataFrame | None = None, frame_counts: DataFrame | None = None, account: str = "account", key: str = "aweme_id",
) -> DataFrame:
    """How much of each source an account has, and which sources are missing.

    ``comments`` has one row per post with its count ``n``, ``frames`` one row per frame (or ``frame_counts`` one per post with its count ``k``),
    ``soundtrack`` one evidence row per post. Frames, covers and summaries count for listed posts.
    """
    out = posts.groupBy(account).agg(F.count(F.lit(1)).alias("n_posts"))
    listed = posts.select(account, key)

    def add(out, df, **aggs):
        if df is None:
            return out.withColumns({n: F.lit(0).cast("bigint") for n in aggs})
        part = df.groupBy(account).agg(*[a.cast("bigint").alias(n) for n, a in aggs.items()])
        return out.join(part, account, "left").withColumns({n: F.coalesce(n, F.lit(0)) for n in aggs})

    one = F.count(F.lit(1))

    def known(df):
        return None if df is None else df.join(listed, [account, key], "left_semi")

    out = add(out, None if transcripts is None else transcripts.select(account, key).distinct(), n_transcripts=one)
    out = add(out, comments, n_comments=F.sum("n"), n_comment_posts=one)
    out = add(out, None if covers is None else known(covers.select(account, key).distinct()), n_covers=one)
    if frames is not None:
        frame_counts = frames.groupBy(account, key).agg(F.count(F.lit(1)).alias("k"))
    out = add(out, known(frame_counts), n_frame_posts=one, n_frames=F.sum("k"))
    out = add(out, soundtrack, n_soundtrack=one)
    out = add(out, known(visual), n_visual=one)
    lacks = [("comments", "n_comments"), ("soundtrack", "n_soundtrack"), ("frames", "n_frame_posts"),
             ("transcripts", "n_transcripts"), ("visual", "n_visual")]
    gone = F.array_compact(F.array(*[F.when(F.col(c) == 0, name) for name, c in lacks]))
    return out.withColumn("missing_sources", F.array_join(gone, ","))
