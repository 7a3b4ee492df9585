"""Readers and writers. Schemas are explicit: no inference pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.config import RETAIL, Roles
from shelfwise.functions.scalars import known


def sales_schema(roles: Roles = RETAIL, *, with_target: bool = True) -> T.StructType:
    """Column order and types of the published sales file."""
    text, number = T.StringType(), T.DoubleType()
    fields = [
        (roles.item, text), (roles.weight, number), (roles.fat_content, text), (roles.visibility, number),
        (roles.item_type, text), (roles.price, number), (roles.outlet, text), (roles.opened_year, T.IntegerType()),
        (roles.outlet_size, text), (roles.outlet_location, text), (roles.outlet_type, text),
    ]
    if with_target:
        fields.append((roles.target, number))
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def clean_missing(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, which every operator treats as missing."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: known(F.col(c).cast("double")) for c in floats}) if floats else df


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """Spread an input that arrives in fewer splits than the cluster has cores, such as one file of one row group.

    Inputs with enough splits, so every large one, are left alone and cost no shuffle. Hashing keeps a re-run stable.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def read_sales_csv(
    spark: SparkSession, path: str, roles: Roles = RETAIL, *, with_target: bool = True
) -> DataFrame:
    """CSV with a header. A header that disagrees with the schema is an error rather than shifted columns."""
    reader = spark.read.schema(sales_schema(roles, with_target=with_target))
    return clean_missing(reader.csv(path, header=True, enforceSchema=False, mode="FAILFAST"))


def write_predictions_csv(df: DataFrame, path: str, columns: dict[str, str]) -> None:
    """Submission files: ``columns`` maps source column to header name. Written in parallel, one file per task."""
    df.select(*[F.col(source).alias(name) for source, name in columns.items()]).write.mode("overwrite").csv(
        path, header=True
    )


def write_sections(sections: dict[str, DataFrame], folder: str) -> None:
    """One table per profile section, replacing an earlier profile in the same folder."""
    for name, section in sections.items():
        section.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add metric rows to a history table, stamped with the time of writing."""
    metrics.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)
