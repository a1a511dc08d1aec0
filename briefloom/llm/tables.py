"""Input tables, the split of the documents, and intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import mark, release, shared_dir, stored

__all__ = ["held_out", "load", "mark", "release", "shared_dir", "stored"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column, remainder: int = 0, modulus: int = 5) -> Column:
    """crc32 of the id as text modulo 5 equals ``remainder``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
