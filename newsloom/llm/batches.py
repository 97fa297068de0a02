"""Python inside tasks: Arrow batches in, Arrow batches out, bounded memory."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ship_package

#: Bytes of a batch that Python turns into objects at once.
SLICE_BYTES = 2_000_000

Rows = dict[str, list]


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes; a longer row stands alone."""
    rows = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(
    df: DataFrame,
    schema: str | StructType,
    task: Callable[[], Callable[[Rows], Rows | Iterable[Rows]]],
    finish: bool = False,
    keep: Sequence[str] = (),
    read: Sequence[str] | None = None,
    arrays: bool = False,
) -> DataFrame:
    """Apply ``task()`` (called once per task) to slices of each partition.

    The work function gets the columns ``read`` (all that are not kept, by
    default; numpy arrays with ``arrays``, else lists) and returns columns by name. With ``finish`` it is
    called once more with no columns at the end of the partition. The output
    has the columns ``keep`` unchanged, for which the function returns the row number of each output row as ``_row``
    where it does not return exactly one row per input row in order.
    """
    spark: SparkSession = df.sparkSession
    ship_package(spark)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    full = StructType([df.schema[c] for c in keep] + list(schema.fields))
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = task()
        arrow = to_arrow_schema(full)

        def built(out: Rows, rows: pa.RecordBatch | None) -> pa.RecordBatch:
            own = [pa.array(out[n], type=arrow.field(n).type) for n in names]
            passed = [rows.column(c) for c in keep] if rows is not None else []
            if "_row" in out:
                passed = [c.take(pa.array(out["_row"], type=pa.int64())) for c in passed]
            return pa.RecordBatch.from_arrays(passed + own, schema=arrow)

        for batch in batches:
            for rows in slices(batch):
                wanted = [n for n in rows.schema.names if n not in keep] if read is None else read
                if arrays:
                    out = work({n: rows.column(n).to_numpy(zero_copy_only=False) for n in wanted})
                else:
                    out = work({n: rows.column(n).to_pylist() for n in wanted})
                for piece in [out] if isinstance(out, dict) else out:
                    yield built(piece, rows)
        if finish:
            out = work({})
            for piece in [out] if isinstance(out, dict) else out:
                yield built(piece, None)

    return df.mapInArrow(run, full)
