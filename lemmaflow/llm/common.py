"""What the operators of this package share: scratch tables, the heavy-key split, table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lemmaflow.scratch import bucketed, scratch_dir, scratch_scope, staged

__all__ = ["P", "bucketed", "heavy_keys", "null_safe", "scratch_dir", "scratch_scope", "staged", "table"]

#: Names that operators add begin with this, so that they can't clash with columns of the input.
P = "__lf_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def heavy_keys(counts: DataFrame, keys: list[str], n: str = "n", share: int = 500) -> DataFrame:
    """Keys that hold over 1/``share`` of all rows. There can't be more than ``share`` of them, so broadcasting them is safe at any size.

    ``counts``: one row a key, with its number of rows in column ``n``; read twice, so pass a staged table.
    """
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.filter(F.col(n) > total // share + 1)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(right[k])
    return on
