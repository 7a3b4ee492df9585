"""What the trained operators share: bounded samples, sparse vectors for Spark's learners, linear scores."""

from __future__ import annotations

from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seed of the hash that picks samples; a row is in or out whatever the partitioning.
SAMPLE_SEED = 20


def bounded_sample(rows: DataFrame, by: str, most: int, *, key: str = "doc_id", text: str | None = None) -> DataFrame:
    """About ``most`` rows of each value of ``by`` (all of them where there are fewer), picked by a hash of
    its key (and, with ``text``, the length of that column, which tells rows without a key apart).

    The values of ``by`` must be few: their counts come to the driver.
    """
    counts = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    of = [F.lit(SAMPLE_SEED), F.col(key).cast("string"), *([F.length(text)] if text else [])]
    draw = F.pmod(F.xxhash64(*of), F.lit(1 << 30))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | (F.col(by).eqNullSafe(F.lit(value)) & (draw < int((1 << 30) * min(1.0, most / n))))
    return rows.where(keep)


def sparse(size: int, indices: Column, values: Column) -> Column:
    """A vector for Spark's learners, for the rows of a bounded sample."""
    return F.udf(lambda i, v: Vectors.sparse(size, i, v), VectorUDT())(indices, values)
