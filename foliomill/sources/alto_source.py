"""ALTO folders as a Spark data source: spark.read.format("alto").load(folder).

Rows are (document, page, path, xml); alto.parsed_pages() makes pages of them. A document is a partition, or several if it has very
many files, and a filter on document (equal to a value, or one of some) opens the folders of those only.
Filters are pushed to Python sources where spark.sql.python.filterPushdown.enabled is set; else Spark filters the rows.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from foliomill.sinks import paths

KINDS = "document string, page string, path string, xml string"


class Files(InputPartition):
    """Files of one document."""

    def __init__(self, document: str, names: list[str]):
        self.document, self.names = document, names


class AltoReader(DataSourceReader):
    """Lists folders on the driver, names only, and opens files in tasks."""

    def __init__(self, root: str, at_once: int = 1000):
        self.root, self.at_once, self.wanted = root, at_once, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or tuple(f.attribute) != ("document",):
                yield f  # Spark's to test
            else:
                self.wanted = values if self.wanted is None else self.wanted & values

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, base = paths.opened(self.root)
        folders = [x.path for x in system.get_file_info(fs.FileSelector(base)) if x.type == fs.FileType.Directory] + [base]
        out = []
        for folder in sorted(folders):
            document = "" if folder == base else posixpath.basename(folder)
            if self.wanted is not None and document not in self.wanted:
                continue
            names = sorted(x.path for x in system.get_file_info(fs.FileSelector(folder)) if x.is_file and x.extension == "xml")
            out += [Files(document, names[i : i + self.at_once]) for i in range(0, len(names), self.at_once)]
        return out or [Files("", [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = paths.opened(self.root)
        for name in partition.names:
            with system.open_input_stream(name) as f:
                row = (partition.document, posixpath.basename(name).removesuffix(".xml"), name, f.read().decode("utf-8-sig", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in row], ["document", "page", "path", "xml"])


class AltoSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "alto"

    def schema(self) -> str:
        return KINDS

    def reader(self, schema: StructType) -> AltoReader:
        return AltoReader(self.options["path"])


def load(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a folder; registers the source first. folder is named as Spark names it."""
    spark.dataSource.register(AltoSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("alto").load(paths.qualified(spark, folder))
