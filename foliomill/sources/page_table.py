"""Pages of a folder, parsed once: a table that grows by the files that are new or have changed.

The table holds what a file gave beside its path, length and time of change. A listing, which opens no file, is joined with these: what
it has no equal for is opened, by tasks, and appended; what has gone or has changed since is left out when the table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.sinks import paths
from foliomill.sources import alto, files

FILE = ["path", "length", "modified"]


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of the XML files below root: as Spark names them, without opening any."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(root)
    m = F.col("_metadata")
    return rows.select(m["file_path"].alias("path"), m["file_size"].alias("length"), m["file_modification_time"].alias("modified"))


def opened(listing: DataFrame) -> DataFrame:
    """listing with xml: the texts of the files, each opened once by a task; null where one has gone meanwhile or is not UTF-8."""
    rows = listing.withColumn("_uri", files.decoded(F.col("path")))
    at = rows.columns.index("_uri")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):  # a page at a time: files may be large
                system, where = paths.opened(batch.column(at)[i].as_py())
                try:
                    with system.open_input_stream(where) as f:
                        text = f.read().decode("utf-8-sig")
                except (FileNotFoundError, UnicodeDecodeError):
                    text = None
                own = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([text], pa.string())], [*own.schema.names, "xml"])

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    # listings are of few bytes, files are not: as many tasks as there are shuffle partitions
    spread = rows.repartition(int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInArrow(run, f"{kinds}, xml string").drop("_uri")


class PageTable:
    """The pages of the XML files below root, kept as a Parquet table in folder. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, folder: str):
        self.spark, self.root, self.folder = spark, root, folder

    def _rows(self) -> DataFrame | None:
        return self.spark.read.parquet(self.folder) if files._present(self.spark, self.folder) else None

    def refresh(self) -> DataFrame:
        """Appends what is new or has changed, and returns pages()."""
        there, rows = listed(self.spark, self.root), self._rows()
        new = there if rows is None else there.join(rows.select(*FILE), FILE, "left_anti")
        names = {k: v.alias(k) for k, v in alto.place(F.col("path")).items()}
        parsed = alto.parsed_pages(opened(new).select(*names.values(), *FILE, "xml"), tuple(FILE))
        parsed.write.mode("append").option("compression", "zstd").parquet(self.folder)
        return self.pages()

    def pages(self) -> DataFrame:
        """As alto.read_pages() gives them, of the files that the table has as they are now; what is no page has no row."""
        current = self._rows().join(listed(self.spark, self.root), FILE, "left_semi")
        current = current.filter("image is not null or width is not null or blocks is not null")
        return current.dropDuplicates(FILE).drop(*FILE)  # a file that two refreshes read at once

    def compact(self) -> None:
        """Writes the current rows as a table of their own and puts them in place of all others."""
        kept = paths.written(self._rows().join(listed(self.spark, self.root), FILE, "left_semi").dropDuplicates(FILE), "page-table")
        kept.write.mode("overwrite").option("compression", "zstd").parquet(self.folder)
