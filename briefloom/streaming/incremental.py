"""Incremental ingestion: new pages against the stored state, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import DEFAULT, Dims
from ..operators.dedup import batch_filter, greedy, signals, unknown_links, with_signals
from ..operators.extract import parse_articles
from ..plans.lineage import stored
from ..schemas import ARTICLE
from ..sources.documents import exists
from ..sources.html import paragraphs_of

_SIGNAL, _SEEN = "kind string, key string", "url string"


class State:
    """Tables below one folder; each batch owns a subfolder, so a repeated batch replaces itself."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def read(self, table: str, schema: str, before: int | None = None) -> DataFrame:
        if not exists(self.spark, f"{self.folder}/{table}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch int").option("basePath", f"{self.folder}/{table}").parquet(f"{self.folder}/{table}")
        return (rows if before is None else rows.filter(F.col("batch") < before)).drop("batch")

    def write(self, table: str, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/batch={batch}")

    def index(self, before: int | None = None) -> DataFrame:
        return self.read("signals", _SIGNAL, before)

    def register_seen(self, urls: DataFrame) -> None:
        """Seen URLs without a record: their url and slug become known (as batch -1)."""
        done = self.read("seen", _SEEN)
        lone = with_signals(urls.join(done, "url", "left_anti").select("url", F.lit(None).cast("string").alias("headline"), F.lit(None).cast("string").alias("snippet")))
        self.write("signals", signals(lone).distinct(), -1)
        self.write("seen", lone.select("url"), -1)


def parse(articles: DataFrame, dims: Dims = DEFAULT, detector: Callable | None = None) -> DataFrame:
    """Deal records of pages with ``error``; one bad page costs itself only."""
    failed = F.col("html").isNull() | (F.trim("html") == "") | F.col("headline").isNull()
    # The pages are parsed once, into a table without their markup, which three plans read.
    read = stored(articles.select("ord", "url", "headline", failed.alias("failed"), paragraphs_of("html").alias("paragraphs")), "paragraphs")
    good = read.filter("not failed and paragraphs is not null")
    records = parse_articles(good.select("ord", "url", "headline", "paragraphs"), dims, detector).withColumn("error", F.lit(None).cast("string"))
    bad = read.filter("failed").select("ord", "url", "headline", F.lit("no page").alias("error"))
    broken = read.filter("not failed and paragraphs is null").select("ord", "url", "headline", F.lit("page cannot be parsed").alias("error"))
    return records.unionByName(bad, allowMissingColumns=True).unionByName(broken, allowMissingColumns=True)


def run_batch(articles: DataFrame, batch: int, state: State, dims: Dims = DEFAULT, detector: Callable | None = None) -> DataFrame:
    """Filter by links first, parse what is left, filter by content, advance the state.

    Added rows register all signals; duplicates are seen only; failures are
    neither and come again with the next run.
    """
    index = state.index(before=batch)
    seen = state.read("seen", _SEEN, before=batch)
    fresh = articles.join(seen, "url", "left_anti")
    plain = with_signals(fresh.withColumn("snippet", F.lit(None).cast("string")))
    fresh = unknown_links(plain, index).select(*articles.columns)
    out = stored(batch_filter(stored(parse(fresh, dims, detector), "records"), index), "batch")
    added = out.filter("status = 'added'")
    columns = ["ord", "headline", "client", "source", "url", "snippet", "law_firms", "transaction_types", "people"]
    state.write("deals", added.select(*columns), batch)
    state.write("signals", signals(added).distinct(), batch)
    state.write("seen", out.filter("status <> 'failed'").select("url").distinct(), batch)
    return out


def ingest(spark: SparkSession, source: str, folder: str, dims: Dims = DEFAULT, detector: Callable | None = None) -> None:
    """Run all new files of ``source`` (Parquet of ord, url, headline, html) and stop.

    The stream's checkpoint knows the files done; a batch that is run again after a
    crash overwrites its own folders and sees only the batches before it.
    """
    state = State(spark, folder)
    pages = spark.readStream.schema(ARTICLE).parquet(source)
    query = pages.writeStream.foreachBatch(lambda df, batch: run_batch(df, batch, state, dims, detector)).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def reparse_all(deals: DataFrame, pages: DataFrame, dims: Dims = DEFAULT, detector: Callable | None = None) -> DataFrame:
    """Stored deals, deduplicated greedily and extracted anew from ``pages`` (url, html).

    A deal whose page is missing or fails keeps its old record.
    """
    kept = stored(greedy(deals), "survivors")
    fresh = kept.select("ord", "url", "headline").join(pages.select("url", "html"), "url", "left")
    new = parse(fresh.select("ord", "url", "headline", "html"), dims, detector).filter("error is null").drop("error")
    old = kept.join(new.select(F.col("ord")), "ord", "left_anti")
    return new.unionByName(old.select(*new.columns))
