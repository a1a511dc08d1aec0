"""JSON sources: arrays and maps read as one value each, so that order is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import DEAL, VERDICT


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store Spark reads it from."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_array(spark: SparkSession, path: str, schema: StructType = DEAL, source: int = 0) -> DataFrame:
    """Columns of ``schema`` with ``src_ord`` and ``deal_ord``; malformed files raise."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.from_json("value", f"array<{schema.simpleString()}>", {"mode": "FAILFAST"}).alias("v"))
    return rows.select(F.lit(source).alias("src_ord"), F.posexplode("v").alias("deal_ord", "r")).select("src_ord", "deal_ord", "r.*")


def read_deals(spark: SparkSession, required: str, *optional: str) -> DataFrame:
    """All deals, the required file first, then the optional ones that exist."""
    out = read_array(spark, required)
    for i, path in enumerate(optional, 1):
        if exists(spark, path):
            out = out.unionByName(read_array(spark, path, source=i), allowMissingColumns=True)
    return out.withColumn("ord", F.col("src_ord").cast("long") * (1 << 40) + F.col("deal_ord"))


def read_verdicts(spark: SparkSession, path: str | None) -> DataFrame:
    """(name, verdict) of a JSON map; its ``_readme`` text is dropped, no file is no row."""
    if path is None or not exists(spark, path):
        return spark.createDataFrame([], f"name string, verdict {VERDICT.simpleString()}")
    text = spark.read.text(path, wholetext=True)
    pairs = text.select(F.explode(F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})).alias("name", "v"))
    return pairs.filter("name <> '_readme'").select("name", F.from_json("v", VERDICT.simpleString()).alias("verdict"))


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """Distinct URLs of a JSON array; no file is an empty set."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url string")
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "array<string>", {"mode": "FAILFAST"})).alias("url")).distinct()
