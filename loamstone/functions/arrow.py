"""Row functions over Arrow batches, for the few operators that built-in expressions cannot state."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loamstone.sources.tables import ship_package


def flat_map(df: DataFrame, make: Callable[[], Callable[..., Iterable[tuple]]], schema: str) -> DataFrame:
    """Each row of df through a function that yields output tuples.

    make is called once per task and returns the row function, so automata
    and tables are built once. Batches stay as small as the input batches:
    output is flushed every 4096 rows, so no task holds a whole partition.
    """
    ship_package(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema), timestamp_utc=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, rows = make(), []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.extend(f(*row))
                if len(rows) >= 4096:
                    yield _batch(rows, out)
                    rows = []
        if rows:
            yield _batch(rows, out)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
