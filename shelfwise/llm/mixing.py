"""Temperature mixing: source shares raised to an exponent, drawn as budgeted permutations of blocks.

The weight of a source is its share of the tokens to the power alpha, scaled to sum to one: alpha 1 keeps the shares,
alpha 0 makes them equal. Alpha is the largest value in [0, 1] whose weights reach the entropy asked for, raised again as
far as needed to keep every source within the allowed repetitions.

A source's budget is drawn in epochs. An epoch is a permutation of the source's blocks of rows, and within each block of
its rows; whole epochs are drawn whole, and of the last one the rows before the budget ends. Only the block in which it
ends is looked at row by row.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh
from shelfwise.session import materialize

#: Least entropy of the weights, as a share of that of equal weights, and most times a row may be drawn.
ENTROPY, REPETITIONS = 0.95, 4.0
#: Rows of a block, about.
BLOCK_ROWS = 4096
SEED = 7
#: Parts of the interval looked at in one step of the search for the exponent, and steps.
PARTS, STEPS = 32, 5


class Target(NamedTuple):
    """``budget`` in tokens of all sources together; none stands for as many as there are."""

    budget: int | None = None
    entropy: float = ENTROPY
    repetitions: float = REPETITIONS
    seed: int = SEED


def _at_exponents(totals: DataFrame, exponents: list[float], budget: int, whole: int) -> list[tuple[float, float]]:
    """Entropy and most repetitions of the weights at each exponent, in one job over the sources."""
    each = totals.select("tokens", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(exponents)))).alias("e"))
    log_p = F.log(F.col("tokens") / F.lit(float(whole)))
    power = F.exp(F.col("e.a") * log_p)
    sums = each.groupBy("e.i").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("e.a") * log_p).alias("x"), F.max(power / F.col("tokens")).alias("r")
    )
    rows = {r["i"]: (math.log(r["z"]) - r["x"] / r["z"], budget * r["r"] / r["z"]) for r in sums.collect()}
    return [rows[i] for i in range(len(exponents))]


def find_exponent(totals: DataFrame, target: Target) -> float:
    """The exponent for the sources' ``tokens`` (above 0); interval by interval, ``PARTS`` at a time.

    1 where the shares as they are have entropy enough, or where no exponent keeps the repetitions.
    """
    whole, sources = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    if not sources:
        return 1.0
    budget, least = target.budget or whole, target.entropy * math.log(sources)

    def search(low: float, high: float, fits) -> tuple[float, float]:
        """Narrow an interval whose lower end fits and whose upper end does not."""
        for _ in range(STEPS):
            grid = [low + (high - low) * i / PARTS for i in range(PARTS + 1)]
            found = [fits(x) for x in _at_exponents(totals, grid, budget, whole)]
            last = max((i for i in range(1, PARTS) if found[i]), default=0)
            low, high = grid[last], grid[last + 1]
        return low, high

    natural = _at_exponents(totals, [1.0], budget, whole)[0]
    if natural[0] >= least - 1e-12:
        return 1.0
    exponent = search(0.0, 1.0, lambda x: x[0] >= least)[0]
    # More repetitions than allowed: go up until the rarest source keeps to them.
    if _at_exponents(totals, [exponent], budget, whole)[0][1] > target.repetitions:
        if natural[1] > target.repetitions:
            return 1.0
        exponent = search(exponent, 1.0, lambda x: x[1] > target.repetitions)[1]
    return exponent


def weights(totals: DataFrame, target: Target) -> DataFrame:
    """``totals`` (source, tokens, n_rows) with share, weight, budget, whole epochs and the rest of the last one."""
    some = totals.where("tokens > 0")
    whole = some.agg(F.sum("tokens")).first()[0] or 0
    exponent = find_exponent(some, target)
    budget = target.budget or whole
    power = F.pow(F.col("tokens") / F.lit(float(max(whole, 1))), F.lit(exponent))
    scale = some.agg(F.sum(power)).first()[0] or 1.0
    out = some.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1)))).withColumn("weight", power / F.lit(scale))
    out = out.withColumn("budget", F.floor(F.col("weight") * F.lit(float(budget)) + F.lit(1e-6)))
    out = out.withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")))
    return out.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")).withColumn("exponent", F.lit(exponent))


def _order(*of: Column | str) -> Column:
    return F.xxhash64(*(F.lit(x) if isinstance(x, int) else x for x in of))


def mix(rows: DataFrame, target: Target | None = None, *, source: str = "source", tokens: str = "n_tokens", key: str = "doc_id") -> DataFrame:
    """Draw ``rows`` by the weights of their sources: every row once per epoch it is drawn in, with its columns.

    Added are epoch (from 0), block, and block_rank and row_rank, by which the rows of an epoch are permuted (names that
    ``rows`` has are lengthened). Rows with a
    null source are a source of their own. Rows without tokens (null or 0) cost nothing: they go with every whole epoch,
    and with the last as far as it goes; a source without any token has no share and is not drawn. Rows with equal or
    null keys are told apart by their place in the input, which is stored once. The budget of a source is never exceeded, and missed by less
    than the next row of its last epoch. Weights do not depend on the partitioning. No rows give no rows.
    """
    target = target or Target()
    src, cost, row, block, begin, end, place, draws = (
        fresh(rows, f"mix_{n}") for n in ("source", "cost", "row", "block", "begin", "end", "place", "draws")
    )
    plan_source, epochs, rest, blocks = (fresh(rows, f"plan_{n}") for n in ("source", "epochs", "rest", "blocks"))
    kept, named = rows.columns, F.col(f"`{key}`")
    amount = F.greatest(F.coalesce(F.col(f"`{tokens}`").cast("long"), F.lit(0)), F.lit(0))
    # The numbers are written with the rows, so they stay.
    stored = materialize(rows.withColumns({src: F.col(f"`{source}`"), cost: amount, row: F.monotonically_increasing_id()}))
    totals = stored.groupBy(F.col(src).alias("source")).agg(F.sum(cost).alias("tokens"), F.count(F.lit(1)).alias("n_rows"))
    plan = materialize(weights(materialize(totals), target))
    plan = plan.select(
        F.col("source").alias(plan_source),
        F.col("epochs").alias(epochs),
        F.col("rest").alias(rest),
        F.ceil(F.col("n_rows") / BLOCK_ROWS).alias(blocks),
    )
    drawn = stored.join(plan, F.col(src).eqNullSafe(F.col(plan_source))).drop(plan_source)
    # Blocks are dealt by a hash of the row, so they are even whatever the keys.
    drawn = drawn.withColumn(block, F.pmod(_order(target.seed, named, row), F.col(blocks)))

    # The blocks of the last epochs, in their order, as far as the budget goes.
    sizes = drawn.where(F.col(rest) > 0).groupBy(src, block, epochs, rest).agg(F.sum(cost).alias(end))
    order = Window.partitionBy(src).orderBy(_order(target.seed + 1, src, epochs, block), block)
    ends = sizes.withColumn(begin, F.sum(end).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(end))
    ends = ends.withColumn(end, F.col(begin) + F.col(end)).where(F.col(begin) < F.col(rest))
    ends = materialize(ends.select(F.col(src).alias(plan_source), F.col(block).alias(blocks), begin, end))
    drawn = drawn.drop(blocks).join(ends, F.col(src).eqNullSafe(F.col(plan_source)) & (F.col(block) == F.col(blocks)), "left")

    # One block of a source is cut: its rows in their order, up to what is left.
    inner = Window.partitionBy(src, block).orderBy(_order(target.seed + 2, epochs, named, row), row)
    cut = drawn.where(F.col(end) > F.col(rest)).select(src, block, epochs, rest, begin, named, row, cost)
    upto = F.col(begin) + F.sum(cost).over(inner.rowsBetween(Window.unboundedPreceding, 0))
    first = materialize(cut.withColumn(place, upto).where(F.col(place) <= F.col(rest)).select(F.col(row).alias(place)))
    drawn = drawn.join(first, F.col(row) == F.col(place), "left")
    again = (F.col(end) <= F.col(rest)) | F.col(place).isNotNull()
    drawn = drawn.withColumn(draws, F.col(epochs) + F.coalesce(again, F.lit(False)).cast("long")).where(F.col(draws) > 0)
    drawn = drawn.withColumn(epochs, F.explode(F.sequence(F.lit(0).cast("long"), F.col(draws) - 1)))
    added = [
        F.col(epochs).alias(fresh(rows, "epoch")),
        F.col(block).alias(fresh(rows, "block")),
        _order(target.seed + 1, src, epochs, block).alias(fresh(rows, "block_rank")),
        _order(target.seed + 2, epochs, named, row).alias(fresh(rows, "row_rank")),
    ]
    return drawn.select(*(F.col(f"`{c}`") for c in kept), *added)
