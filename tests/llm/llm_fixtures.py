"""Inputs shared by the tests of the training-data operators."""

import glob

import pandas as pd
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = " ".join(f"word{i} and the other one" for i in range(9000))

FOLDER = "/root/testdata/sf0.001"


def read_table(folder, name):
    path = f"{folder}/{name}.parquet"
    return pd.concat([pd.read_parquet(p) for p in sorted(glob.glob(f"{path}/*.parquet")) or [path]], ignore_index=True)
