"""Report sections R1-R11 as tables, for all accounts at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstat.functions import columns as C
from clipstat.operators import cadence, ranking, reconcile, soundtrack, stats, topics, visual
from clipstat.operators import comments as co
from clipstat.operators.frames import median_frame
from clipstat.plans import rules
from clipstat.session import stage


@dataclass
class Sources:
    """Inputs of a report. ``posts`` is required; sections of absent sources are left out.

    posts: manifest rows with ``seq``. comments: kept comments (W4) with ``pos``. transcripts: one row
    per post (``transcript``). soundtrack: archive records. frames: one row per frame (``file``).
    summaries: A22 rows. covers: posts that have a cover.
    """

    posts: DataFrame
    comments: DataFrame | None = None
    transcripts: DataFrame | None = None
    soundtrack: DataFrame | None = None
    frames: DataFrame | None = None
    summaries: DataFrame | None = None
    covers: DataFrame | None = None
    tz: str = "UTC"
    theme_rules: Sequence = rules.THEME_RULES
    comment_patterns: Sequence = rules.COMMENT_PATTERNS
    comment_groups: Sequence = rules.COMMENT_GROUPS
    #: Of a whole report: what several sections derive, each written once under its name.
    made: dict[str, DataFrame] | None = None


GROUP = ["account", "aweme_id"]


def _once(s: Sources, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What several sections derive: a plan for a section alone, written once for a whole report."""
    if s.made is None:
        return make()
    if name not in s.made:
        s.made[name] = stage(make(), name)
    return s.made[name]


def _comment_counts(s: Sources) -> DataFrame | None:
    return None if s.comments is None else s.comments.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))


def _frame_counts(s: Sources) -> DataFrame | None:
    if s.frames is None:
        return None
    return _once(s, "frame-counts", lambda: s.frames.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("k")))


def _gated(s: Sources) -> DataFrame | None:
    if s.soundtrack is None:
        return None
    good = soundtrack.contract_check(s.soundtrack).filter("contract_ok").drop("contract_ok")
    return _once(s, "gated", lambda: soundtrack.evidence_gate(good, s.posts))


def _percentiles(s: Sources) -> DataFrame:
    return _once(s, "percentiles", lambda: stats.nearest_rank_percentile(s.posts, (50, 90)))


def _units(s: Sources) -> DataFrame:
    return _once(s, "units", lambda: cadence.posts_by_unit(s.posts, tz=s.tz))


def _hot(s: Sources) -> DataFrame:
    return _once(s, "hot", lambda: co.best_comments(s.comments, s.posts))


def inventory(s: Sources) -> DataFrame:
    """R1 (and the missing-source lines of R10)."""
    gated = _gated(s)
    return _once(s, "inventory", lambda: reconcile.source_inventory(
        s.posts, transcripts=s.transcripts, comments=_comment_counts(s), frame_counts=_frame_counts(s),
        soundtrack=None if gated is None else gated.filter("evidence"), covers=s.covers, visual=s.summaries,
    ))


def headline(s: Sources) -> DataFrame:
    """R2: figures behind the automatic conclusions."""
    rates = stats.engagement_rates(stats.engagement_totals(s.posts))
    p50 = _percentiles(s).select("account", "p50")
    years = cadence.years_active(s.posts, tz=s.tz)
    first = s.posts.groupBy("account").agg(C.month_key(C.local_date(F.min("create_time"), s.tz)).alias("since"))
    return rates.join(p50, "account").join(years, "account").join(first, "account").select(
        "account", "n", F.bround("years", 1).alias("years"), "since", F.bround("mean_likes").cast("bigint").alias("mean_likes"),
        "p50", "max_likes", F.bround("collect_rate", 1).alias("collect_rate"),
        F.bround("comment_rate", 1).alias("comment_rate"), "audience",
    )


def profile_rows(s: Sources) -> DataFrame:
    """Account profile: period, posts per year, means, like distribution."""
    totals = stats.engagement_totals(s.posts)
    pct = _percentiles(s)
    period = s.posts.groupBy("account").agg(
        C.local_date(F.min("create_time"), s.tz).alias("first_day"), C.local_date(F.max("create_time"), s.tz).alias("last_day")
    )
    years = _units(s).filter("unit = 'year'").groupBy("account").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("value", "n"))), lambda y: F.concat_ws(":", y["value"].cast("string"), y["n"].cast("string"))),
            " / ",
        ).alias("posts_by_year")
    )
    means = [F.bround(f"mean_{m}").cast("bigint").alias(f"mean_{m}") for m in stats.METRICS]
    return totals.join(pct, "account").join(period, "account").join(years, "account", "left").select(
        "account", "n", "first_day", "last_day", F.coalesce("posts_by_year", F.lit("")).alias("posts_by_year"),
        *means, "p50", "p90", "max_likes",
    )


def publishing(s: Sources) -> dict[str, DataFrame]:
    """Counts by hour, weekday and year, peaks, month trend."""
    return {
        "publishing_units": _units(s).select("account", "unit", "value", "n"),
        "publishing_peaks": cadence.peaks_of(_units(s)),
        "publishing_months": cadence.month_trend(s.posts, tz=s.tz),
    }


def themes(s: Sources) -> dict[str, DataFrame]:
    """Theme matrix and like histogram."""
    return {
        "theme_matrix": topics.theme_stats(s.posts, s.theme_rules),
        "likes_histogram": stats.likes_histogram(s.posts),
    }


def best_posts(s: Sources) -> dict[str, DataFrame]:
    """Best posts, viral frames, one frame per theme. The middle frame stands for a post."""
    out = {"top_posts": ranking.top_posts(s.posts, tz=s.tz)}
    if s.frames is not None:
        shown = _frame_counts(s)
        # Only frames of the posts that are listed are put in order.
        listed = ranking.viral_key_frames(s.posts, shown).select(*GROUP)
        middle = median_frame(s.frames.select(*GROUP, "file").join(listed, GROUP, "left_semi"))
        out["viral_frames"] = ranking.viral_key_frames(s.posts, middle).select("account", "place", "aweme_id", "likes", "file")
        out["theme_frames"] = topics.first_per_theme(s.posts, shown, s.theme_rules)
    return out


def looks(s: Sources) -> dict[str, DataFrame]:
    """Visual distribution and the best-liked posts against the rest."""
    matched = _once(s, "matched", lambda: visual.visual_with_posts(s.summaries, s.posts))
    return {
        "visual_distribution": visual.visual_distribution(matched),
        "visual_products": visual.product_exposure(matched),
        "visual_top_vs_rest": visual.top_vs_rest_visual(matched),
        "visual_top_vs_rest_products": visual.top_vs_rest_product(matched),
        "visual_ocr": visual.ocr_note(s.summaries),
        "visual_matched": visual.visual_match_counts(s.summaries, s.posts),
    }


def comment_evidence(s: Sources) -> dict[str, DataFrame]:
    """Comment themes, coverage, best comments, friction samples."""
    return {
        "comment_themes": topics.comment_theme_counts(s.comments, s.comment_patterns),
        "comment_coverage": topics.comment_coverage(s.comments, s.posts, s.comment_patterns),
        "comment_cards": co.clip_comments(_hot(s), 6, content_chars=80, title_chars=20),
        "comment_friction": topics.friction_samples(s.comments, s.comment_groups),
    }


def soundtrack_section(s: Sources) -> dict[str, DataFrame]:
    """Engagement by soundtrack group, multipliers, moods, best posts, excluded records."""
    gated = _gated(s)
    groups = _once(s, "groups", lambda: soundtrack.group_engagement(gated))
    return {
        "soundtrack_header": soundtrack.cross_header(gated, s.posts),
        "soundtrack_status": soundtrack.status_counts(gated),
        "soundtrack_groups": groups,
        "soundtrack_multipliers": soundtrack.group_multipliers(groups),
        "soundtrack_moods": soundtrack.mood_leader(groups),
        "soundtrack_top": soundtrack.top_soundtrack_posts(gated),
    }


def provenance(s: Sources) -> DataFrame:
    """What the report rests on, and what was missing."""
    found = inventory(s)
    line = F.concat_ws(
        "; ", F.format_string("%d posts", "n_posts"),
        F.when(F.col("n_comments") > 0, F.format_string("%d comments", "n_comments")),
        F.when(F.col("missing_sources") != "", F.concat(F.lit("missing: "), F.col("missing_sources"))),
    )
    return found.select("account", line.alias("line"))


def account_metrics(s: Sources) -> DataFrame:
    """One document per account: cadence, structure, archetypes, tags, best comments.

    Every list inside is a top-k, so a document stays small whatever the account's size.
    """
    posts = s.posts

    def listed(df: DataFrame, name: str, *cols: str) -> DataFrame:
        items = F.array_sort(F.collect_list(F.struct("place", *cols)))
        return df.groupBy("account").agg(items.alias(name))

    archetypes = ranking.archetype_top5(posts)
    kinds = archetypes.groupBy("account").agg(
        *[
            F.array_sort(
                F.collect_list(F.when(F.col("archetype") == kind, F.struct("place", "aweme_id", "likes", "collects", "shares", "comments", "title")))
            ).alias(f"top_{kind}")
            for kind in ("collects", "shares", "comments")
        ]
    )
    body = posts.withColumn("transcript", F.lit("")) if s.transcripts is None else posts.join(
        s.transcripts.select(*GROUP, "transcript"), GROUP, "left")
    tags = topics.hashtag_stats(body)
    out = posts.groupBy("account").agg(F.count(F.lit(1)).alias("count"))
    parts = [
        cadence.publish_cadence(posts, tz=s.tz), stats.ratio_medians(posts), stats.top_share(posts),
        listed(ranking.viral_top5(posts), "viral", "aweme_id", "likes", "collects", "shares", "comments", "title"),
        kinds, listed(tags, "tags", "tag", "n", "mean_likes"),
    ]
    if s.comments is not None:
        hot = co.clip_comments(_hot(s))
        parts.append(listed(hot, "hot_comments", "like_count", "content", "nickname", "title"))
    for part in parts:
        out = out.join(part, "account", "left")
    return out


def report_tables(s: Sources) -> dict[str, DataFrame]:
    """K6 input: every section the sources allow. What several sections read is written once."""
    shared = ("comments", "summaries")
    s = replace(s, made={}, **{n: stage(getattr(s, n), n) for n in shared if getattr(s, n) is not None})
    out = {"inventory": inventory(s), "headline": headline(s), "profile": profile_rows(s), "provenance": provenance(s),
           "account_metrics": account_metrics(s)}
    out |= publishing(s) | themes(s) | best_posts(s)
    if s.summaries is not None:
        out |= looks(s)
    if s.comments is not None:
        out |= comment_evidence(s)
    if s.soundtrack is not None:
        out |= soundtrack_section(s)
    return out
