"""Left lookups of per-key statistics, with the join strategy chosen from a measured size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import materialize

# A lookup is broadcast only when its measured size stays below this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key that holds at least 1/HOT_SHARE of the rows is hot, so at most HOT_SHARE keys can be.
HOT_SHARE = 1000


@dataclass(frozen=True)
class Lookup:
    """A stored table with one row per key, its measured size, and the number of rows its keys stand for (``_n``)."""

    keys: tuple[str, ...]
    table: DataFrame
    size_bytes: int
    total: int

    @property
    def values(self) -> list[str]:
        return [c for c in self.table.columns if c not in self.keys and c != "_n"]


def store_lookup(table: DataFrame, keys: Sequence[str], *, stored: bool = False) -> Lookup:
    """Store ``table`` and measure it. ``stored`` marks a table that is, or is a projection of, a stored one.

    A table without ``_n`` counts one row per key.
    """
    if "_n" not in table.columns:
        table = table.withColumn("_n", F.lit(1).cast("long"))
    row_bytes = F.lit(32 + 16 * len(table.columns)).cast("long")
    for f in table.schema:
        if isinstance(f.dataType, T.StringType):
            row_bytes = row_bytes + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            row_bytes = row_bytes + F.greatest(F.size(f.name), F.lit(0)) * 64
    measures = [F.sum(row_bytes).alias("size"), F.sum("_n").alias("total")]
    if stored:
        kept, measured = table, table.agg(*measures).first().asDict()
    else:
        seen = Observation()  # measured by the job that writes the table
        kept = materialize(table.observe(seen, *measures))
        measured = seen.get
    size, total = measured["size"], measured["total"]
    return Lookup(tuple(keys), kept, int(size or 0), int(total or 0))


def attach(
    df: DataFrame, lookup: Lookup, *, needed: Column | None = None, broadcast_bytes: int | None = None, stored: bool = False
) -> DataFrame:
    """Left-join the values of ``lookup``; rows without a match get NULL.

    Small table: broadcast, no shuffle. Large table: the keys that are hot in ``df`` are counted, the few there can be are
    broadcast with what the lookup has for them, and their rows are spread over the shuffle instead of meeting in the
    partition of their key; all other rows join by key. With ``needed``, rows that do not satisfy it are spread as well,
    and the values of all such rows are NULL if the table is large. If ``df`` is ``stored``, so that reading it twice costs little,
    such rows stay out of the shuffle.
    """
    keys, values = list(lookup.keys), lookup.values
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if lookup.size_bytes <= limit:
        return df.join(F.broadcast(lookup.table.select(*keys, *values)), keys, "left")
    asked = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    if stored and needed is not None:
        types = {f.name: f.dataType for f in lookup.table.schema}
        rest = df.where(~asked).withColumns({v: F.lit(None).cast(types[v]) for v in values})
        return attach(df.where(asked), lookup, broadcast_bytes=limit).unionByName(rest)
    unkeyed = reduce(or_, [F.col(k).isNull() for k in keys])
    counts = materialize(df.where(asked & ~unkeyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = counts.where(F.col("_rows") * HOT_SHARE >= total).join(lookup.table, keys, "left").select(
        *keys, *[F.col(v).alias(f"_hot{v}") for v in values], F.lit(True).alias("_is_hot")
    )
    # Rows that need nothing from the shuffle get a salt of their own. It is a task number: it does not depend on row
    # contents (copies of a row spread too) and a re-run of the same task repeats it.
    marked = df.withColumn("_asked", asked).join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_is_hot") | unkeyed | ~F.col("_asked"), 1 + F.spark_partition_id()).otherwise(0)
    )
    cold = lookup.table.select(*keys, *values, F.lit(0).alias("_salt"))
    joined = marked.join(cold.hint("merge"), [*keys, "_salt"], "left")
    return joined.select(
        *df.columns, *[F.when(F.col("_asked"), F.coalesce(F.col(f"_hot{v}"), F.col(v))).alias(v) for v in values]
    )
