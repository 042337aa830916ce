"""Pages that arrive in a folder, read as a stream: the running twin of leaving out what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliomill.functions import text as T
from foliomill.sources.alto import parsed_pages, place, whole_text


def arriving(spark: SparkSession, folder: str, *, files_at_once: int = 1000) -> DataFrame:
    """(document, page, arrived, xml) of XML files that appear in folder and below; each once, as the checkpoint knows."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", "*.xml")
    rows = reader.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_at_once).load(folder)
    own = place(F.col("_metadata.file_path"))
    return rows.select(*[v.alias(k) for k, v in own.items()], F.col("_metadata.file_modification_time").alias("arrived"), F.col("value").alias("xml"))


def texts(pages: DataFrame) -> DataFrame:
    """pages with text: all texts of a page's lines, cleaned, as the batch reader has them; a broken file has none."""
    rows = parsed_pages(pages, ("arrived",))
    return rows.select("document", "page", "arrived", T.cleaned(whole_text(F.col("blocks"))).alias("text"))


def counts(page_texts: DataFrame, *, window: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(window, document, pages, chars): what arrived in each stretch of time; what comes later than late is left out."""
    rows = page_texts.withWatermark("arrived", late).groupBy(F.window("arrived", window), "document")
    return rows.agg(F.count("*").alias("pages"), F.sum(F.length("text")).alias("chars"))


def write(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until what is there now has been read."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
