"""Reuse of finished work and transcript-level checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipstat.functions import columns as C


def artifact_validity(
    expected: Mapping[str, object], *, actual_device: str = "actual_device",
    required: Sequence[str] = ("actual_compute", "runner"), hash_now: str = "current_sha256",
    hash_then: str = "audio_sha256",
) -> Column:
    """an artefact is reusable iff version, config, devices and content hash all agree.

    ``expected`` maps columns to the values this run needs; NULL matches only NULL.
    """
    ok = F.lit(True)
    for name, value in expected.items():
        ok = ok & F.col(name).eqNullSafe(F.lit(value))
    if "requested_device" in expected:
        ok = ok & F.col(actual_device).eqNullSafe(F.lit(expected["requested_device"]))
    for name in required:
        ok = ok & C.filled(name).isNotNull()
    return F.coalesce(ok & C.filled(hash_then).isNotNull() & (F.col(hash_then) == F.col(hash_now)), F.lit(False))


def pending_work(
    items: DataFrame, done: DataFrame, *, keys: Sequence[str] = ("account", "aweme_id"),
    match: Sequence[str] = ("config_hash", "content_hash", "version"),
) -> DataFrame:
    """Items without a finished artefact of the same config, content and version."""
    return items.join(done.select(*keys, *match), [*keys, *match], "left_anti")


def low_confidence_flag(
    n_segments: str = "n_segments", language_prob: str = "language_probability", avg_logprob: str = "avg_logprob",
    language_prob_min: float = 0.80, logprob_min: float = -0.80,
) -> Column:
    """no segments, unsure language, or low mean log-probability."""
    return (
        (F.coalesce(n_segments, F.lit(0)) == 0)
        | (F.coalesce(language_prob, F.lit(0.0)) < language_prob_min)
        | F.coalesce(F.col(avg_logprob) < logprob_min, F.lit(False))
    )


def avg_logprob(segments: DataFrame, *, account: str = "account", key: str = "aweme_id") -> DataFrame:
    """Mean of known segment log-probabilities, NULL when none is known."""
    total = F.sum(F.col("avg_logprob").cast("decimal(24,6)")).cast("double")
    return segments.groupBy(account, key).agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.bround(total / F.count("avg_logprob"), 3).alias("avg_logprob"),
    )


def compute_once_per_url(items: DataFrame, url: str, *, keys: Sequence[str] = ("account", "aweme_id")) -> tuple[DataFrame, DataFrame]:
    """Items sharing one URL share one piece of work: (distinct work by URL key, item to key)."""
    linked = items.withColumn("url_key", C.url_key(url)).filter("url_key <> ''")
    work = linked.groupBy("url_key").agg(F.min(url).alias(url), F.count(F.lit(1)).alias("items"))
    return work, linked.select(*keys, "url_key")
