"""Exact quantiles, with the usual moments, for any number of groups and without sorting or collecting a group.

Scan 1 counts values per group and coarse bin. Bins are fixed intervals of about 1.6 % relative width, so the counts are
combined on the map side and their number per group is bounded by the spread of the values, not by the rows. The running
counts say exactly which bin holds each wanted rank. Scan 2 keeps only the values in those bins (a bin that holds a
single value needs no second look) and reads the order statistics off their running counts.

Nothing here is approximate and nothing depends on the order in which tasks finish.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalars import known
from shelfwise.operators.lookup import Lookup, attach, store_lookup
from shelfwise.operators.ranks import running_totals
from shelfwise.session import materialize

BINS_PER_E = 64  # bins per factor of e


def coarse_bin(v: Column, bins_per_e: int = BINS_PER_E) -> Column:
    """Label of the interval a value falls in. Larger values never fall in an earlier interval of the same sign."""
    magnitude = F.floor(F.least(F.ln(F.abs(v)), F.lit(1000.0)) * bins_per_e) + 1_000_000  # infinity is one bin
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * magnitude).cast("long")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    *,
    bins_per_e: int = BINS_PER_E,
) -> DataFrame:
    """One stored row per group: ``keys``, ``n``, ``sum``, ``mean``, ``std`` (sample), ``std_pop``, ``min``, ``max``, and
    ``q``: linear quantiles in the order of ``probs``.

    NULL values are ignored; a group of NULL values only has ``n`` = 0. Groups with a NULL key are left out.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    data = _valued(df, keys, value)
    groups = materialize(_groups(_placed(_binned(data, keys, bins_per_e), keys, probs), keys))

    # Every entry of ``bins`` holds wanted ranks. Bins with lo = hi are settled, the others need a second look.
    todo = groups.select(*keys, "n", F.explode("bins").alias("b")).where("b.lo < b.hi").select(
        *keys, "n", F.col("b.bin").alias("_bin"), F.col("b.before").alias("before"), F.col("b.c").alias("_n")
    )
    resolved = None
    if not todo.isEmpty():
        asked = store_lookup(todo, [*keys, "_bin"], stored=True)
        resolved = materialize(_resolve(_counted(data, asked, bins_per_e), keys, probs))
    found = _read_off(groups, keys, probs, resolved)
    return found.select(*keys, "n", "sum", "mean", "std", "std_pop", "min", "max", "q")


def exact_boxes(
    df: DataFrame, keys: Sequence[str], value: str, *, width: float = 1.5, bins_per_e: int = BINS_PER_E
) -> DataFrame:
    """One row per group: ``keys``, ``rows`` (missing values included), ``n``, ``q1``, ``median``, ``q3``, ``low`` and ``high``
    (the most extreme values within ``width`` times the box of it) and ``outside`` (how many lie beyond).

    Two scans. The first tells between which values each quartile, and so each fence, must lie. A bin that lies wholly on
    one side of all that a fence can be is settled by its ends and count; the second scan counts the values of the few
    other bins together with those of the bins that hold the quartiles.

    NULL values are ignored. Groups with a NULL key are left out, and a frame without rows has no group at all.
    """
    asked, probs = list(keys), [0.25, 0.5, 0.75]
    keys = asked or ["_all"]
    data = _valued(df if asked else df.withColumn("_all", F.lit(0)), keys, value)
    placed = _placed(_binned(data, keys, bins_per_e), keys, probs)
    group = Window.partitionBy(*keys)

    def end(prob: float, rank: str, side: str) -> Column:
        holds = F.expr(f"array_contains(hits, {rank}({prob}D * (n - 1)))")
        return F.max(F.when(holds, F.col(side))).over(group)

    # The first quartile lies from a1 to b1, the third from a3 to b3.
    a1, b1 = end(0.25, "floor", "lo"), end(0.25, "ceil", "hi")
    a3, b3 = end(0.75, "floor", "lo"), end(0.75, "ceil", "hi")
    rounding = (F.abs(a1) + F.abs(b1) + F.abs(a3) + F.abs(b3)) * (1e-9 * (1.0 + width))
    limits = {
        "low_least": a1 - (b3 - a1) * width - rounding,
        "low_most": b1 - (a3 - b1) * width + rounding,
        "high_least": a3 + (a3 - b1) * width - rounding,
        "high_most": b3 + (b3 - a1) * width + rounding,
    }
    lo, hi = F.col("lo"), F.col("hi")
    unsure = reduce(or_, [F.isnan(c) for c in limits])  # fences of infinite values
    inside = (lo >= F.col("low_most")) & (hi <= F.col("high_least"))
    settled = ~unsure & (inside | (hi < F.col("low_least")) | (lo > F.col("high_most")))
    wanted = F.size("hits") > 0
    marked = placed.withColumns(limits).withColumns({"wanted": wanted, "look": (lo < hi) & (wanted | ~settled)})
    marked = materialize(marked.drop(*limits))

    todo = marked.where("look").select(*keys, "n", "_bin", "before", "wanted", F.col("c").alias("_n"))
    asked_bins = store_lookup(todo, [*keys, "_bin"], stored=True)
    pieces, resolved = marked.where("c > 0 AND NOT look").select(*keys, "lo", "hi", "c"), None
    if asked_bins.total:
        looked = materialize(_counted(data, asked_bins, bins_per_e))
        pieces = pieces.unionByName(looked.select(*keys, F.col("_v").alias("lo"), F.col("_v").alias("hi"), "c"))
        resolved = _resolve(looked.where("wanted").drop("wanted"), keys, probs)

    q = F.col("q")
    boxes = store_lookup(
        _read_off(_groups(marked, keys), keys, probs, resolved).select(
            *keys, "rows", "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"), F.col("n").alias("_n")
        ),
        keys,
    )
    reach = (F.col("q3") - F.col("q1")) * width
    near_low, near_high = lo >= F.col("q1") - reach, hi <= F.col("q3") + reach
    beyond = attach(pieces, boxes).groupBy(*keys).agg(
        F.min(F.when(near_low, lo)).alias("low"),
        F.max(F.when(near_high, hi)).alias("high"),
        F.sum(F.when(~near_low | ~near_high, F.col("c")).otherwise(0)).alias("outside"),
    )
    return boxes.table.drop("_n").join(beyond, keys, "left").select(
        *asked, "rows", "n", "q1", "median", "q3", "low", "high", F.coalesce("outside", F.lit(0)).cast("long").alias("outside")
    )


def _valued(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    data = df.select(*keys, known(F.col(value).cast("double")).alias("_v"))
    return data.dropna(subset=keys) if keys else data


def _read_off(groups: DataFrame, keys: list[str], probs: list[float], resolved: DataFrame | None) -> DataFrame:
    """Adds ``q`` to the groups, from the bins with a single value and the values of the bins that were looked at."""
    if resolved is not None:
        groups = groups.join(resolved, keys, "left") if keys else groups.withColumn("found", resolved.scalar())
    else:
        groups = groups.withColumn("found", F.expr("cast(array() AS array<struct<hits:array<bigint>,v:double>>)"))

    def at(rank: str) -> str:
        return (
            f"coalesce(get(filter(found, f -> array_contains(f.hits, {rank})), 0).v, "
            f"get(filter(bins, b -> array_contains(b.hits, {rank})), 0).lo)"
        )

    position = "(p * (n - 1))"
    low, high = at(f"floor{position}"), at(f"ceil{position}")
    ends = f"transform({_numbers(probs)}, p -> named_struct('a', {low}, 'b', {high}, 'part', {position} - floor{position}))"
    q = F.expr(
        f"CASE WHEN n > 0 THEN transform({ends}, e -> CASE WHEN e.a = e.b THEN e.a ELSE e.a + (e.b - e.a) * e.part END) END"
    )
    return groups.withColumn("q", q)


def _numbers(probs: Sequence[float]) -> str:
    return f"array({', '.join(f'{p!r}D' for p in probs)})"


def _hits(probs: Sequence[float], start: str, end: str) -> Column:
    """Wanted zero-based ranks in [start, end): the ranks on either side of every quantile position."""
    ranks = f"flatten(transform({_numbers(probs)}, p -> array(floor(p * (n - 1)), ceil(p * (n - 1)))))"
    return F.expr(f"array_distinct(filter({ranks}, r -> r >= {start} AND r < {end}))")


def _binned(data: DataFrame, keys: list[str], bins_per_e: int) -> DataFrame:
    """Scan 1. Rows with a NULL value form a bin of their own, which keeps their group in the result."""
    v = F.col("_v")
    return data.groupBy(*keys, coarse_bin(v, bins_per_e).alias("_bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("c"),
        F.sum(v).alias("s"),
        F.var_pop(v).alias("var"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
    )


def _placed(bins: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Bins with the values before them and the wanted ranks they hold. Windows span bins, never rows."""
    group = Window.partitionBy(*keys)
    running = group.orderBy(F.col("lo").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumns(
            {"n": F.sum("c").over(group), "total": F.sum("s").over(group), "end": F.sum("c").over(running)}
        )
        .withColumn("before", F.col("end") - F.col("c"))
        .withColumn("hits", _hits(probs, "before", "end"))
    )


def _groups(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Moments per group and the bins that hold wanted ranks. Lists here span bins, never rows."""
    mean = F.try_divide(F.col("total"), F.col("n"))
    from_mean = F.try_divide(F.col("s"), F.col("c")) - mean
    return (
        placed.groupBy(*keys)
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("n"),
            F.max("total").alias("sum"),
            F.max(mean).alias("mean"),
            F.min("lo").alias("min"),
            F.max("hi").alias("max"),
            F.sum(F.col("c") * (F.col("var") + from_mean * from_mean)).alias("_m2"),
            F.collect_list(F.when(F.size("hits") > 0, F.struct("hits", "lo", "hi", "before", "c", F.col("_bin").alias("bin")))).alias("bins"),
        )
        .withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.try_divide(F.col("_m2"), F.col("n") - 1))))
        .withColumn("std_pop", F.sqrt(F.try_divide(F.col("_m2"), F.col("n"))))
        .drop("_m2")
    )


def _counted(data: DataFrame, asked: Lookup, bins_per_e: int) -> DataFrame:
    """Scan 2: how often each value of the bins asked for occurs, with what is known of its bin.

    Values find their bin by its label, one probe per row; the label also splits a large group over many join keys.
    """
    binned = data.withColumn("_bin", coarse_bin(F.col("_v"), bins_per_e))
    keys = [k for k in asked.keys if k != "_bin"]
    return (
        attach(binned, asked)
        .where(F.col("before").isNotNull())
        .groupBy(*keys, *asked.values, "_v")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def _resolve(counted: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """The values at the wanted ranks that lie in bins holding more than one value."""
    ranked = running_totals(counted, [*keys, "n", "before"], [F.col("_v").asc()], "c")
    hits = _hits(probs, "before + start", "before + end")
    return (
        ranked.withColumn("hits", hits)
        .where(F.size("hits") > 0)
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("hits", F.col("_v").alias("v"))).alias("found"))
    )
