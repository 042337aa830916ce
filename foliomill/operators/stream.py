"""Steps that need a page's rows together: pages stream through Python, many to a call, as pages are small and there are very many."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by_pages(rows: DataFrame, page: Sequence[str], by: Sequence[str | Column], kinds, each: Callable[[pa.Table, np.ndarray], pa.Table]) -> DataFrame:
    """each(table, starts) of some whole pages at a time, as one table of kinds (a schema).

    rows are shuffled by page and sorted by page and by; the rows of the table's page i are those from starts[i] to starts[i + 1]. A page that
    goes on in the next batch is held until it ends.
    """
    along = Window.partitionBy(*page).orderBy(*(by or page))
    rows = rows.withColumn("_n", F.row_number().over(along)).sortWithinPartitions(*page, *by)

    def done(parts: list[pa.Table]):
        table = pa.concat_tables(parts)
        starts = np.append(np.flatnonzero(table["_n"].to_numpy() == 1), table.num_rows)
        yield from each(table.drop_columns(["_n"]), starts).to_batches()

    def run(batches):
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            begins = np.flatnonzero(table["_n"].to_numpy() == 1)
            if len(begins):
                at = int(begins[-1])
                if held or at:
                    yield from done([*held, table.slice(0, at)])
                held, table = [], table.slice(at)
            held.append(table)
        if held and sum(t.num_rows for t in held):
            yield from done(held)

    return rows.mapInArrow(run, kinds)
