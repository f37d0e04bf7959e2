"""One text in, any number of rows out - the shape of every Arrow-batched walker here."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.session import ship_package

_ROWS_PER_BATCH = 8192
_SIMPLE = {T.LongType: pa.int64(), T.StringType: pa.string(), T.DateType: pa.date32(), T.BooleanType: pa.bool_()}


def _arrow_type(dtype: T.DataType) -> pa.DataType:
    if isinstance(dtype, T.ArrayType):
        return pa.list_(_arrow_type(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in dtype.fields])
    return _SIMPLE[type(dtype)]


def expand_text(df: DataFrame, text: str, keys: Sequence[str], out: T.StructType,
                expand: Callable[[str], Iterable[tuple]]) -> DataFrame:
    """Apply ``expand`` to each text; its tuples become rows next to the ``keys`` columns.

    Only the needed columns travel to Python, key columns never leave Arrow, and output
    is sent on in bounded batches, so a long document does not inflate a whole batch.
    """
    ship_package(df.sparkSession)
    keys = list(keys)
    schema = T.StructType([df.schema[k] for k in keys] + list(out.fields))
    names, types = schema.names, [_arrow_type(f.dataType) for f in out.fields]
    last = len(keys)

    def emit(batch, rows, values):
        columns = zip(*values)
        arrays = [pa.array(column, type=t) for column, t in zip(columns, types)]
        origin = pa.array(rows, type=pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(k).take(origin) for k in range(last)] + arrays, names)

    def run(batches):
        for batch in batches:
            rows, values = [], []
            for row in range(batch.num_rows):
                body = batch.column(last)[row].as_py()
                for found in expand(body or ""):
                    rows.append(row)
                    values.append(found)
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield emit(batch, rows, values)
                        rows, values = [], []
            if rows:
                yield emit(batch, rows, values)

    return df.select(*keys, text).mapInArrow(run, schema)
