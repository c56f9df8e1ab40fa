"""Publishing rhythm. Everything runs on one small (account, day) or (account, hour) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.skew import upper_middle


def posts_by_day(posts: DataFrame, *, tz: str = "UTC", account: str = "account", key: str = "aweme_id",
                 seq: str = "seq") -> DataFrame:
    """Posts per account and calendar day with that day's first post; undated posts drop out."""
    dated = posts.withColumn("day", C.local_date("create_time", tz)).filter("day is not null")
    return dated.groupBy(account, "day").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(key, seq).alias("first_post")
    )


def publish_gaps(posts: DataFrame, *, tz: str = "UTC", account: str = "account", key: str = "aweme_id",
                 seq: str = "seq") -> DataFrame:
    """Days since the account's previous post; 0 for later posts of the same day."""
    days = _gaps(posts_by_day(posts, tz=tz, account=account, key=key, seq=seq), account)
    dated = posts.select(account, key, C.local_date("create_time", tz).alias("day")).filter("day is not null")
    joined = dated.join(days.select(account, "day", "first_post", "gap"), [account, "day"])
    gap = F.when(F.col(key) == F.col("first_post"), F.col("gap")).otherwise(F.lit(0))
    return joined.select(account, key, "day", gap.cast("int").alias("gap_days"))


def _gaps(days: DataFrame, account: str) -> DataFrame:
    spec = Window.partitionBy(account).orderBy("day")
    return days.withColumn("gap", F.date_diff("day", F.lag("day").over(spec)))


def gap_counts(posts: DataFrame, *, tz: str = "UTC", account: str = "account", key: str = "aweme_id",
               seq: str = "seq") -> DataFrame:
    """How often each gap length occurs, same-day repeats as gap 0."""
    days = _gaps(posts_by_day(posts, tz=tz, account=account, key=key, seq=seq), account)
    parts = days.select(
        account,
        F.explode(
            F.array(
                F.struct(F.col("gap").alias("gap"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(0).alias("gap"), (F.col("n") - 1).alias("n")),
            )
        ).alias("g"),
    ).select(account, "g.gap", "g.n")
    return parts.filter("gap is not null and n > 0").groupBy(account, "gap").agg(F.sum("n").alias("n"))


def upper_median_gap(posts: DataFrame, *, tz: str = "UTC", account: str = "account", **keys) -> DataFrame:
    """A6 on publish gaps, from the gap counts."""
    counts = gap_counts(posts, tz=tz, account=account, **keys)
    whole = Window.partitionBy(account)
    upto = whole.orderBy("gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(whole)})
    pos = upper_middle(F.col("_all"))[0]
    hit = (F.col("_upto") > pos) & (F.col("_upto") - F.col("n") <= pos)
    return placed.groupBy(account).agg(F.max(F.when(hit, F.col("gap"))).alias("gap_median"))


def top_months(posts: DataFrame, k: int = 3, *, tz: str = "UTC", account: str = "account") -> DataFrame:
    """Busiest months; ties go to the earlier month."""
    days = posts_by_day(posts, tz=tz, account=account)
    months = days.groupBy(account, C.month_key("day").alias("month")).agg(F.sum("n").alias("n"))
    spec = Window.partitionBy(account).orderBy(F.desc("n"), F.asc("month"))
    return months.withColumn("place", F.row_number().over(spec)).filter(F.col("place") <= k)


def publish_cadence(posts: DataFrame, *, tz: str = "UTC", months_k: int = 3, account: str = "account",
                    key: str = "aweme_id", seq: str = "seq") -> DataFrame:
    """First and last day, span, posts per active month, busiest months, upper median gap."""
    days = posts_by_day(posts, tz=tz, account=account, key=key, seq=seq)
    base = days.groupBy(account).agg(
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
        F.sum("n").alias("dated"),
        F.count_distinct(C.month_key("day")).alias("active_months"),
    )
    tops = top_months(posts, months_k, tz=tz, account=account).groupBy(account).agg(
        F.concat_ws(
            ",",
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "month", "n"))),
                lambda m: F.concat(m["month"], F.lit(":"), m["n"].cast("string")),
            ),
        ).alias("top_months")
    )
    gaps = upper_median_gap(posts, tz=tz, account=account, key=key, seq=seq)
    # Accounts without any dated post keep a row.
    span = F.when(F.col("dated") >= 2, F.date_diff("last_day", "first_day") + 1).otherwise(0)
    monthly = F.bround(F.col("dated").cast("double") / F.greatest("active_months", F.lit(1)), 1)
    return (
        posts.select(account).distinct()
        .join(base, account, "left").join(tops, account, "left").join(gaps, account, "left")
        .select(
            account, "first_day", "last_day",
            F.coalesce(span, F.lit(0)).alias("span_days"),
            F.coalesce(monthly, F.lit(0.0)).alias("monthly_avg"),
            F.coalesce("active_months", F.lit(0)).alias("active_months"),
            F.coalesce("top_months", F.lit("")).alias("top_months"),
            "gap_median",
        )
    )


def posts_by_unit(posts: DataFrame, *, tz: str = "UTC", account: str = "account", seq: str = "seq") -> DataFrame:
    """A10: post counts by year, hour and weekday (Monday is 0) in one pass."""
    t = C.local_time("create_time", tz)
    rows = posts.select(account, seq, t.alias("t"), "create_time").filter("t is not null")
    long = rows.selectExpr(
        account, "create_time", seq,
        "stack(3, 'year', year(t), 'hour', hour(t), 'weekday', weekday(t)) as (unit, value)",
    )
    return long.groupBy(account, "unit", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("create_time", seq)).alias("_first")
    )


def peaks(posts: DataFrame, *, tz: str = "UTC", account: str = "account", seq: str = "seq") -> DataFrame:
    """Busiest hour, busiest and quietest occurring weekday; ties go to the earliest in time."""
    return peaks_of(posts_by_unit(posts, tz=tz, account=account, seq=seq), account=account)


def peaks_of(units: DataFrame, *, account: str = "account") -> DataFrame:
    """A11 from the counts of A10."""

    def pick(unit: str, most: bool):
        on = F.col("unit") == unit
        n = -F.col("n") if most else F.col("n")
        return F.min_by(F.when(on, F.col("value")), F.when(on, F.struct(n, F.col("_first"))))

    return units.groupBy(account).agg(
        pick("hour", True).alias("peak_hour"),
        pick("weekday", True).alias("peak_weekday"),
        pick("weekday", False).alias("low_weekday"),
        F.max(F.when(F.col("unit") == "hour", F.col("n"))).alias("peak_hour_n"),
        F.max(F.when(F.col("unit") == "weekday", F.col("n"))).alias("peak_weekday_n"),
        F.min(F.when(F.col("unit") == "weekday", F.col("n"))).alias("low_weekday_n"),
    )


def month_trend(posts: DataFrame, *, tz: str = "UTC", account: str = "account") -> DataFrame:
    """Posts and mean likes per month with the scaled line; accounts with one month drop out."""
    dated = posts.withColumn("month", C.month_key(C.local_date("create_time", tz))).filter("month is not null")
    months = dated.groupBy(account, "month").agg(
        F.count(F.lit(1)).alias("n"), F.sum("likes").alias("likes")
    )
    whole = Window.partitionBy(account)
    out = months.withColumns(
        {"_months": F.count(F.lit(1)).over(whole), "_likes": F.sum("likes").over(whole)}
    ).filter("_months >= 2")
    mean = F.col("likes").cast("double") / F.col("n")
    limit = F.col("_likes").cast("double") / F.col("_months") * 3
    scaled = F.when(limit != 0, F.least(mean / limit, F.lit(1.0))).otherwise(0.0)
    return out.select(account, "month", "n", mean.alias("mean_likes"), scaled.alias("scaled"))


def years_active(posts: DataFrame, *, tz: str = "UTC", account: str = "account") -> DataFrame:
    """Whole days between first and last post, in years."""
    t = C.local_time("create_time", tz)
    out = posts.groupBy(account).agg(F.min(t).alias("_a"), F.max(t).alias("_b"))

    def clock(c: str):
        return F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)

    short = F.when(clock("_b") < clock("_a"), 1).otherwise(0)
    days = F.date_diff(F.col("_b").cast("date"), F.col("_a").cast("date")) - short
    return out.select(account, F.coalesce(days / F.lit(365.0), F.lit(0.0)).alias("years"))


def idle_periods(posts: DataFrame, min_days: int = 30, *, tz: str = "UTC", account: str = "account") -> DataFrame:
    """Breaks of at least ``min_days`` between publishing days."""
    spec = Window.partitionBy(account).orderBy("day")
    days = posts_by_day(posts, tz=tz, account=account).select(
        account, F.lag("day").over(spec).alias("from_day"), F.col("day").alias("to_day")
    )
    gap = F.date_diff("to_day", "from_day")
    return days.withColumn("days", gap).filter(F.col("days") >= min_days)


