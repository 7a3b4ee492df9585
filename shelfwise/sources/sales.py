"""The sales table of the test data: a flat retail view over lineitem, part, supplier and nation.

Missing values, zeros and untidy labels are injected by key arithmetic, so every engine builds the same rows. No
join carries a hint: sizes decide, and adaptive execution splits a part or supplier that holds too many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.tables import spread

SALES_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def read_sales(spark: SparkSession, folder: str, *, keys: bool = False) -> DataFrame:
    """The sales view; ``keys=True`` adds the line keys used for splits and folds."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")

    order, part, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    lines = (
        spread(table("lineitem").select(*SALES_KEYS, "l_quantity", "l_discount"), SALES_KEYS)
        .join(table("part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )

    no_weight = ((order * 7 + part * 3 + supplier) % 6 == 0) | (part % 97 == 0)
    no_size = (supplier % 4 == 0) | ((order + supplier) % 9 == 0)
    cents = F.floor(
        F.col("p_retailprice") * (1 + supplier % 10) * (50 + F.col("l_quantity")) * (1 - F.col("l_discount")) / 2
    )

    def cycle(c, labels: list[str]):
        chain = F.when(c % len(labels) == 0, labels[0])
        for remainder, label in enumerate(labels[1:-1], start=1):
            chain = chain.when(c % len(labels) == remainder, label)
        return chain.otherwise(labels[-1])

    return lines.select(
        *(SALES_KEYS if keys else []),
        F.concat(F.lit("FD"), F.lpad(part.cast("string"), 6, "0")).alias("Item_Identifier"),
        F.when(~no_weight, F.col("p_size").cast("double")).alias("Item_Weight"),
        cycle(part, ["Low Fat", "LF", "low fat", "Regular", "reg"]).alias("Item_Fat_Content"),
        F.col("l_discount").alias("Item_Visibility"),
        F.col("p_type").alias("Item_Type"),
        F.when((order + part * 5) % 41 != 0, F.col("p_retailprice")).alias("Item_MRP"),
        F.concat(F.lit("OUT"), F.lpad(supplier.cast("string"), 4, "0")).alias("Outlet_Identifier"),
        (1985 + supplier % 25).cast("int").alias("Outlet_Establishment_Year"),
        F.when(~no_size, cycle(supplier, ["Small", "medium", "HIGH"])).alias("Outlet_Size"),
        cycle(F.col("n_regionkey"), ["Tier 1", "Tier2", "tier 3"]).alias("Outlet_Location_Type"),
        cycle(
            F.col("s_nationkey"), ["Grocery", "Supermarket Type1", "Supermarket Type 2", "Supermarket Type3"]
        ).alias("Outlet_Type"),
        (cents.cast("double") / 100).alias("Item_Outlet_Sales"),
    )
