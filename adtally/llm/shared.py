"""Small helpers of the operators: tables, written intermediate results, shipping to workers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import shared_dir, ship_package

#: The words of a text are runs of anything but six ASCII characters (fixed value).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once as Parquet in the shared folder and read back.

    Cuts the lineage: an executor lost later costs a re-read, not a recomputation. The
    files stay under ``<spark.checkpoint.dir>/llm`` for as long as the returned frame is
    used; the folder may be deleted between runs.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark, 'llm')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def python_ready(df: DataFrame) -> SparkSession:
    """The frame's session, with this package importable in the Python workers."""
    ship_package(df.sparkSession)
    return df.sparkSession


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def bound_to(value, body):
    """``body(value)`` with ``value`` evaluated once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)
