"""Sorted passes: one Python walk over rows that Spark has dealt by group and sorted.

A pass sees the rows of its task one after another, group by group, in order,
and holds whatever state it needs, never a whole group.  What a group may hold
is therefore bounded by time and not by memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

ROWS = 10_000           # rows of a batch passed on


def _walk(batches) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for r in rows:
        held.append(r)
        if len(held) == ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def same(a, b) -> bool:
    """Equal keys; nulls and NaNs are equal to themselves."""
    return a == b or (a != a and b != b)


def sorted_pass(df: DataFrame, by: list[str], order: list[str], walk: Callable[[Iterator[tuple]], Iterator[tuple]],
                fields: list[StructField]) -> DataFrame:
    """Rows ``fields`` that ``walk`` makes of the rows of ``df``, dealt by ``by`` and sorted by ``by`` and ``order``."""
    schema = StructType(fields)
    arrow = to_arrow_schema(schema)
    return df.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(
        lambda batches: _batches(walk(_walk(batches)), arrow), schema)
