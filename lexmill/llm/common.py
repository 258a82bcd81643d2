"""Helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType, BinaryType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

#: Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 512

KINDS: dict[str, DataType] = {
    "long": LongType(), "int": IntegerType(), "string": StringType(), "binary": BinaryType(),
    "double": DoubleType(), "longs": ArrayType(LongType()), "doubles": ArrayType(DoubleType()), "ints": ArrayType(IntegerType()),
    "strings": ArrayType(StringType()),
}


def columns(**kinds: str) -> StructType:
    """A schema from names and kinds; unlike DDL it needs no session, so modules load on executors."""
    return StructType([StructField(name, KINDS[kind]) for name, kind in kinds.items()])


def text_or_empty(column: str) -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_rows(df: DataFrame, schema: StructType, make: Callable[[], Callable]) -> DataFrame:
    """Apply a function to slices of rows, on the executors, with bounded memory.

    ``make()`` runs once per task and returns ``f(*columns) -> dict of lists`` that takes the
    columns of ``df`` as Python lists. A slice may give any number of rows. If ``make()`` returns a
    pair, its second function is called after the last slice and gives the last rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make()
        apply, finish = made if isinstance(made, tuple) else (made, None)
        target = to_arrow_schema(schema)

        def table(out):
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(start, SLICE_ROWS)
                yield table(apply(*(c.to_pylist() for c in piece.columns)))
        if finish:
            yield table(finish())

    return df.mapInArrow(run, schema)
