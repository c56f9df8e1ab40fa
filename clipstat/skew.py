"""Order-dependent columns and exact quantiles in one plan for groups of any size.

Nothing is counted beforehand and nothing comes to the driver. A window over ``account`` sorts an account
in one task; ``ordered`` takes ``slice_by``, numbers that never fall along the order, and sorts slices of
a group instead. Each slice is summed up (rows, sums, largest values, last row); the slices of a group are
few, so what stands before each is a running fold over an array of them, which is joined back: a prefix
scan in two passes. Several numbers make slices of slices, so rows that are alike in the leading key are
split by the next one. ``up`` and ``down`` make numbers from a numeric key: sixteen per doubling of its
size, which needs no look at the data and bounds the array whatever the group's size. ``exact_quantiles``
never sorts a group: it counts the values, finds the digit of a position, then the next digit among the
values that begin with it, and sorts only those that agree in both.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICE = "_slice"
_POS = "_pos"
_NULL_SLICE = 1 << 20
#: Whole numbers up to this one have a slice of their own.
_ALONE = 21


def _magnitude(value: str) -> Column:
    c = F.col(value).cast("double")
    return (F.signum(c) * F.floor(F.log2(F.abs(c) + 1) * 16)).cast("int")


def ties(value: str, then: Column) -> Column:
    """``then`` where the slice of a whole number holds no other value, so that equal rows are split by it; else 0."""
    alone = F.coalesce(F.col(value).between(0, _ALONE), F.lit(True))
    return F.when(alone, then).otherwise(0).cast("int")


def up(value: str) -> Column:
    """Slices along an ascending numeric key, nulls first."""
    return F.coalesce(_magnitude(value), F.lit(-_NULL_SLICE))


def down(value: str) -> Column:
    """Slices along a descending numeric key, nulls last."""
    return F.coalesce(-_magnitude(value), F.lit(_NULL_SLICE))


def ordered(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    *,
    slice_by: Column | Sequence[Column] | None = None,
    rank: str | None = None,
    size: str | None = None,
    previous: Mapping[str, str] | None = None,
    running_max: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    total: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add columns that depend on the order of rows inside a group.

    ``rank`` is ``row_number``, ``size`` the group's row count, ``previous`` maps a new column to
    the column whose value on the preceding row it takes, ``running_max`` is the maximum over all
    *preceding* rows, ``running_sum`` the sum up to and including the row and ``total`` the sum
    over the group. ``order`` must end in a key that is unique inside the group. With several columns in
    ``slice_by`` each splits the slices of those before it; together they must never fall along the order.
    """
    asked = dict(
        rank=rank,
        size=size,
        previous=dict(previous or {}),
        running_max=dict(running_max or {}),
        running_sum=dict(running_sum or {}),
        total=dict(total or {}),
    )
    if slice_by is None:
        return _by_window(df, list(group), order, **asked)
    return _by_slice(df, list(group), order, [slice_by] if isinstance(slice_by, Column) else list(slice_by), **asked)


def ranks_by(df: DataFrame, group: str, ranks: Mapping[str, str], then: str, last: str) -> DataFrame:
    """Several ``row_number`` columns at once: each by its metric, then by ``then``, both descending, then by ``last``.

    ``ranks`` maps a new column to a metric of whole numbers; ``last`` is a number, unique inside the group.
    Rows are dealt by metric and slices of (metric, ``then``, place of ``last``), so neither a large group nor
    a metric that is the same almost everywhere stays in one task; places are counts of earlier slices plus
    the place in the slice.
    """
    first = df.groupBy(F.col(group).alias("_of")).agg(F.min(last).alias("_from"))
    narrow = df.select(group, last, then, *[m for m in dict.fromkeys(ranks.values()) if m != then])
    places = narrow.join(first, F.col(group).eqNullSafe(F.col("_of")))
    cases = ", ".join(f"'{n}', cast({m} as bigint)" for n, m in ranks.items())
    long = places.selectExpr(group, last, f"cast({then} as bigint) as _then", f"{last} - _from as _late", f"stack({len(ranks)}, {cases}) as (_rank, _metric)")
    slices = [down("_metric"), ties("_metric", down("_then")), ties("_metric", ties("_then", up("_late")))]
    order = [F.desc("_metric"), F.desc("_then"), F.asc(last)]
    placed = ordered(long, [group, "_rank"], order, slice_by=slices, rank="_place")
    wide = placed.groupBy(F.col(group).alias("_of"), F.col(last).alias("_last")).agg(*[F.max(F.when(F.col("_rank") == n, F.col("_place"))).alias(n) for n in ranks])
    return df.join(wide, F.col(group).eqNullSafe(F.col("_of")) & (F.col(last) == F.col("_last"))).select(*df.columns, *ranks)


def _by_window(df, group, order, rank, size, previous, running_max, running_sum, total):
    whole = Window.partitionBy(*group)
    spec = whole.orderBy(*order)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols: list[Column] = []
    if rank:
        cols.append(F.row_number().over(spec).alias(rank))
    if size:
        cols.append(F.count(F.lit(1)).over(whole).alias(size))
    cols += [F.lag(c).over(spec).alias(n) for n, c in previous.items()]
    cols += [F.max(c).over(before).alias(n) for n, c in running_max.items()]
    cols += [F.sum(c).over(upto).alias(n) for n, c in running_sum.items()]
    cols += [F.sum(c).over(whole).alias(n) for n, c in total.items()]
    return df.select("*", *cols)


def _by_slice(df, group, order, slices, rank, size, previous, running_max, running_sum, total):
    # Group keys without nulls, so that windows, sums and the join share one partitioning.
    keys = [f"_g{k}" for k in range(len(group))]
    cut = [f"{_SLICE}{k}" for k in range(len(slices))]
    sliced = df.select(
        "*", *[F.coalesce(F.col(g).cast("string"), F.lit("\0")).alias(k) for g, k in zip(group, keys)],
        *[c.alias(n) for c, n in zip(slices, cut)],
    )
    whole = Window.partitionBy(*keys, *cut)
    spec = whole.orderBy(*order)
    before = spec.rowsBetween(Window.unboundedPreceding, -1)
    upto = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = [F.row_number().over(spec).alias(_POS)]
    local += [F.lag(c).over(spec).alias(f"_lag_{n}") for n, c in previous.items()]
    local += [F.max(c).over(before).alias(f"_max_{n}") for n, c in running_max.items()]
    local += [F.sum(c).over(upto).alias(f"_sum_{n}") for n, c in running_sum.items()]
    rows = sliced.select("*", *local)

    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.max(c).alias(f"m_{n}") for n, c in running_max.items()]
    aggs += [F.sum(c).alias(f"s_{n}") for n, c in running_sum.items()]
    aggs += [F.sum(c).alias(f"t_{n}") for n, c in total.items()]
    if previous:
        kept = F.struct(*sorted(set(previous.values())))
        tail = rows.groupBy(*keys, *cut).agg(*aggs, F.max_by(kept, _POS).alias("last"))
    else:
        tail = sliced.groupBy(*keys, *cut).agg(*aggs)
    carry = _carried(tail, keys, cut)
    joined = rows.join(carry, [*keys, *cut])
    out = [F.col(c) for c in df.columns]
    if rank:
        out.append((F.col(_POS) + F.col("_scan_before.n")).cast("int").alias(rank))
    if size:
        out.append(F.col("_scan_all.n").alias(size))
    for name, source in previous.items():
        out.append(F.when(F.col(_POS) == 1, F.col("_scan_before.last")[source]).otherwise(F.col(f"_lag_{name}")).alias(name))
    out += [F.greatest(f"_max_{n}", f"_scan_before.m_{n}").alias(n) for n in running_max]
    for name in running_sum:
        here, carried = F.col(f"_sum_{name}"), F.col(f"_scan_before.s_{name}")
        out.append(F.when(here.isNull(), carried).otherwise(here + F.coalesce(carried, F.lit(0))).alias(name))
    out += [F.col(f"_scan_all.t_{n}").alias(n) for n in total]
    return joined.select(*out)


def _carried(summary: DataFrame, keys: list[str], cut: list[str]) -> DataFrame:
    """Per slice ``_scan_before``, the fold of all earlier slices of its group, and ``_scan_all``, that of the whole group.

    The slices of one parent are an array; a fold over its beginning is what stands before a slice. Parents
    are folded the same way, and what stands before a parent stands before all its slices.
    """
    fields = [f for f in summary.schema.fields if f.name not in (*keys, *cut)]
    start = "named_struct(" + ", ".join(f"'{f.name}', " + ("0L" if f.name == "n" else f"cast(null as {f.dataType.simpleString()})") for f in fields) + ")"

    def merged(a: str, b: str) -> str:
        """The fold of ``a`` and the later ``b``."""
        parts = []
        for f in fields:
            x, y = f"{a}.{f.name}", f"{b}.{f.name}"
            how = {"m": f"greatest({x}, {y})", "l": f"coalesce({y}, {x})"}.get(f.name[0], f"coalesce({x} + {y}, {x}, {y})")
            parts.append(f"'{f.name}', cast({how} as {f.dataType.simpleString()})")
        return "named_struct(" + ", ".join(parts) + ")"

    fold = f"aggregate({{}}, {start}, (a, y) -> {merged('a', 'y._own')})"
    level = summary.select(*keys, *cut, F.struct(*[f.name for f in fields]).alias("_own"))
    found = None
    for k in range(len(cut) - 1, -1, -1):
        parent = [*keys, *cut[:k]]
        listed = level.groupBy(*parent).agg(F.sort_array(F.collect_list(F.struct(cut[k], "_own"))).alias("_parts"))
        listed = listed.select(*parent, "_parts", F.expr(fold.format("_parts")).alias("_own"))
        level = listed.select(*parent, "_own")
        each = f"inline(transform(_parts, (x, i) -> struct(x.{cut[k]} as {cut[k]}, {fold.format('slice(_parts, 1, i)')} as _here{k})))"
        here = listed.select(*parent, *([] if k else [F.col("_own").alias("_scan_all")]), F.expr(each))
        found = here if found is None else found.join(here, [*parent, cut[k]])
    for k in range(1, len(cut)):
        found = found.withColumn("_here0", F.expr(merged("_here0", f"_here{k}")))
    return found.select(*keys, *cut, F.col("_here0").alias("_scan_before"), "_scan_all")


def exact_quantiles(
    df: DataFrame, group: Sequence[str], value: str, picks: Mapping[str, Callable[[Column], Sequence[Column]]]
) -> DataFrame:
    """Exact order statistics by selection: two counting passes over digits of the values, then one small sort.

    ``picks`` maps an output column to a function of the group size giving the zero-based positions
    whose values are averaged. NULL values do not count; a group with nothing else gets NULL. A value's
    first digit is its slice (sixteen per doubling), its second one of 256 parts of that slice; both rise
    with the value. Values are counted before the shuffle and dealt by themselves, a group's digits are a
    bounded array, and only values that agree in both digits with a wanted position are put in order.
    """
    group = list(group)
    keys = [f"_g{k}" for k in range(len(group))]
    c = F.col(value).cast("double")
    fine = (F.signum(c) * F.floor(F.log2(F.abs(c) + 1) * 4096)).cast("bigint")
    dealt = [F.coalesce(F.col(g).cast("string"), F.lit("\0")).alias(k) for g, k in zip(group, keys)]
    counted = df.select(*dealt, *[F.col(g) for g in group], F.col(value).alias("_v"), fine.alias("_fine"))
    # One condition for all that reads the counts and a digit that is never null, so that they are one shuffle.
    hist = counted.filter("_v is not null and _fine is not null").groupBy(*keys, *group, "_v", "_fine").agg(F.count("_v").alias("_n"))
    # Groups are few: taken from the rows they combine before the shuffle, taken from the counts they would be dealt with every value.
    names = counted.select(*keys, *group).distinct()
    digits = hist.groupBy(*keys, F.coalesce(F.shiftright("_fine", 8), F.lit(0)).alias("_first"), "_fine").agg(F.sum("_n").alias("_n"))
    parts = digits.groupBy(*keys, "_first").agg(F.sum("_n").alias("_n"), F.sort_array(F.collect_list(F.struct("_fine", "_n"))).alias("_seconds"))
    firsts = parts.groupBy(*keys).agg(F.sum("_n").alias("_all"), F.sort_array(F.collect_list(F.struct("_first", "_n"))).alias("_firsts"))
    wanted = [(name, k) for name, positions in picks.items() for k in range(len(positions(F.lit(1))))]
    asked = F.array(*[F.struct(F.lit(i).alias("_pick"), picks[n](F.col("_all"))[k].cast("bigint").alias("_at")) for i, (n, k) in enumerate(wanted)])
    at = firsts.select(*keys, "_firsts", F.inline(asked)).select(*keys, "_pick", *_digit_of("_firsts", "_first"))
    at = at.join(parts.select(*keys, "_first", "_seconds"), [*keys, "_first"]).select(*keys, "_pick", *_digit_of("_seconds", "_fine"))
    near = hist.drop(*group).join(at, [*keys, "_fine"])
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_pick", "_fine").orderBy("_v"))
    hit = near.withColumn("_upto", upto).filter((F.col("_upto") > F.col("_at")) & (F.col("_upto") - F.col("_n") <= F.col("_at")))
    found = names.join(hit.groupBy(*keys).agg(*[F.max(F.when(F.col("_pick") == i, F.col("_v"))).alias(f"_p{i}") for i in range(len(wanted))]), keys, "left")
    out = []
    for name in picks:
        own = [F.col(f"_p{i}") for i, (n, _) in enumerate(wanted) if n == name]
        out.append((own[0] if len(own) == 1 else (own[0] + own[1]) / F.lit(2.0)).alias(name))
    return found.select(*group, *out)


def _digit_of(counts: str, digit: str) -> list[Column]:
    """The digit under position ``_at`` of an array of (digit, count) in order, and the position among its values."""
    fold = (
        f"aggregate({counts}, named_struct('digit', cast(null as bigint), 'at', _at, 'found', false), (a, y) -> case when a.found then a "
        f"when y._n > a.at then named_struct('digit', y.{digit}, 'at', a.at, 'found', true) "
        f"else named_struct('digit', a.digit, 'at', a.at - y._n, 'found', false) end)"
    )
    return [F.expr(f"{fold}.digit").alias(digit), F.expr(f"{fold}.at").alias("_at")]


def middle(n: Column) -> list[Column]:
    """Both middle positions: the usual median."""
    return [F.floor((n - 1) / 2), F.floor(n / 2)]


def upper_middle(n: Column) -> list[Column]:
    return [F.floor(n / 2)]


def nearest_rank(p: float) -> Callable[[Column], list[Column]]:
    """Position ``round(p/100 * (n-1))`` with half-even rounding."""
    return lambda n: [F.bround(F.lit(p) / F.lit(100.0) * (n - 1)).cast("bigint")]


def mode_of(
    df: DataFrame, group: Sequence[str], values: Mapping[str, str], first: str
) -> DataFrame:
    """Most frequent value per group and column; ties go to the value met first."""
    group = list(group)
    pairs = ", ".join(f"'{n}', cast({c} as string)" for n, c in values.items())
    long = df.selectExpr(*group, first, f"stack({len(values)}, {pairs}) as (_field, _value)")
    counted = long.groupBy(*group, "_field", "_value").agg(
        F.count(F.lit(1)).alias("_n"), F.min(first).alias("_first")
    )
    picked = [
        F.min_by(
            F.when(F.col("_field") == n, F.col("_value")),
            F.when((F.col("_field") == n) & F.col("_value").isNotNull(), F.struct(-F.col("_n"), F.col("_first"))),
        ).alias(n)
        for n in values
    ]
    return counted.groupBy(*group).agg(*picked)
