"""Sinks. Tables are Parquet by account; a rerun replaces only the accounts it computed."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.operators import comments as comment_ops
from clipstat.operators.profiles import profile_digest
from clipstat.session import NO_SHUFFLE_LEFT, release, settings, stage

#: Report tables written at the same time: most are small, and one alone leaves cores idle. Each holds its plans in the driver.
AT_ONCE = 2


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``stage`` for as long as a sink writes; what the caller has staged stays."""
    held = stage(df, name)
    try:
        yield held
    finally:
        if held is not df:
            release(held)


def write_table(df: DataFrame, path: str, *, account: str = "account") -> None:
    """Replace the written accounts' partitions in one commit.

    Rows are gathered by account first, so an account is a few files and a very large one is split.
    """
    df.hint("rebalance", account).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(account).parquet(path)


def write_posts(posts: DataFrame, path: str) -> None:
    """K1."""
    write_table(posts, path)


def write_comments(top: DataFrame, unique: DataFrame, path: str, n: int = 100, torn: DataFrame | None = None) -> None:
    """K2: nested kept comments per post, and the totals (with the torn lines skipped, if given) as a second table."""
    write_table(comment_ops.nest_comments(top, n), f"{path}/by_post")
    write_table(comment_ops.comment_summary(unique, torn), f"{path}/summary")


def write_profiles(profiles: DataFrame, path: str) -> None:
    """K3."""
    # Profiles are wide: what made them leaves the disk before they are gathered by account.
    with staged(profiles, "profiles") as held:
        write_table(held, path)


def write_profile_digest(profiles: DataFrame, path: str) -> None:
    """K4: text blocks by account, best rank first inside each file."""
    # Dealing by ranges looks at all rows twice; the second look is at the finished texts.
    with staged(profile_digest(profiles).select("account", "rank", "digest"), "digest") as blocks:
        blocks.repartitionByRange("account", "rank").sortWithinPartitions("account", "rank").select(
            "account", F.concat("digest", F.lit("\n")).alias("value")
        ).write.mode("overwrite").partitionBy("account").text(path)


def write_documents(metrics: DataFrame, path: str, *, account: str = "account") -> None:
    """K5: one JSON document per account; the report rows it is built from are bounded by top-k."""
    metrics.write.mode("overwrite").partitionBy(account).json(path)


def write_report_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """K6: one table per report section."""
    if not tables:
        return
    with settings(next(iter(tables.values())).sparkSession, NO_SHUFFLE_LEFT), ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(write_table, table, f"{path}/{name}") for name, table in tables.items()]:
            done.result()


def write_targets(rows: DataFrame, path: str) -> None:
    """K7: filtered posts back to JSON lines."""
    rows.write.mode("overwrite").json(path)
