"""Helpers the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructField, StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def apart(df: DataFrame, side: DataFrame) -> DataFrame:
    """``side`` with column names that ``df`` doesn't have, in order."""
    return side.toDF(*(free_name(df, f"__{c}") for c in side.columns))


def same_row(docs: DataFrame, side: DataFrame, key: str, text: str) -> Column:
    """Condition that joins ``docs`` to the first two columns of ``side``: id and text hash."""
    number, hashed = (F.col(c) for c in side.columns[:2])
    return F.col(key).eqNullSafe(number) & (F.xxhash64(whole_text(text)) == hashed)


#: Bytes of a batch that are turned into Python objects at a time.
BATCH_BYTES = 4 << 20
#: What operators remember from task to task in this worker: how to forget it, by operator.
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember(operator: str, forget: Callable[[], None]) -> None:
    """Let the next task of another operator in this worker call ``forget``."""
    _REMEMBERED[operator] = forget


def turn_to(operator: str) -> None:
    """Free what earlier tasks of other operators have left in a worker that Spark uses again.

    Memory that is free within the process goes back to the machine, so that the largest
    tasks of two workers don't add up for the rest of the job.
    """
    for name in [name for name in _REMEMBERED if name != operator]:
        _REMEMBERED.pop(name)()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _row_bytes(column: pa.Array):
    """About the bytes of each row of a column."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return pc.cast(pc.fill_null(pc.binary_length(column), 0), pa.int64())
    if pa.types.is_list(column.type):
        return pc.multiply(pc.cast(pc.fill_null(pc.list_value_length(column), 0), pa.int64()), 16)
    return None


def by_bytes(batches: Iterable[pa.RecordBatch], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes, of one row at least; none is empty."""
    most = most or BATCH_BYTES
    for batch in batches:
        if batch.num_rows and batch.nbytes <= most:
            yield batch
        elif batch.num_rows:
            sizes = [x for x in map(_row_bytes, batch.columns) if x is not None]
            total = 8 * batch.num_columns + sum(x.to_numpy(zero_copy_only=False) for x in sizes)
            start = held = 0
            for at, size in enumerate(total.tolist() if sizes else [batch.nbytes // batch.num_rows] * batch.num_rows):
                if at > start and held + size > most:
                    yield batch.slice(start, at - start)
                    start, held = at, 0
                held += size
            yield batch.slice(start)


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict], dict]], ddl: str, operator: str = "") -> DataFrame:
    """Run the function that ``make`` builds in each task over Arrow batches.

    The function gets the columns of a batch as lists and returns lists of the columns of
    ``ddl``. Batches come in slices of bounded size, and a slice is dropped before the next
    is read. ``operator`` names whose memory of earlier tasks the worker may keep.
    """
    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        turn_to(operator)
        function = make()
        for batch in by_bytes(batches):
            yield pa.RecordBatch.from_pydict(function(batch.to_pydict()), schema=arrow)

    return df.mapInArrow(run, schema)


def append(df: DataFrame, make: Callable[[], Callable], read: list[Column], ddl: str, name: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all, if None) and a struct column of fields ``ddl``.

    ``make`` builds, in each task, a function from lists of the ``read`` columns to a list
    of one value per row: a tuple of the fields. Kept columns pass through untouched.
    """
    keep = df.columns if keep is None else keep
    fields = StructType.fromDDL(ddl)
    schema = StructType([*(df.schema[c] for c in keep), StructField(name, fields)])
    kind, names, n = to_arrow_type(fields), fields.names, len(keep)

    def run(batches):
        turn_to("")
        function = make()
        for batch in by_bytes(batches):
            rows = function(*(c.to_pylist() for c in batch.columns[n:]))
            made = pa.array([dict(zip(names, r)) for r in rows], kind)
            own = [pa.field(f.name, f.type) for f in batch.schema][:n]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], made], schema=pa.schema([*own, pa.field(name, kind)]))

    return df.select(*(F.col(f"`{c}`") for c in keep), *(c.alias(f"__read{i}") for i, c in enumerate(read))).mapInArrow(run, schema)


def row_key(key: str = "doc_id", text: str = "text") -> Column:
    """Key of a document that stays defined for null and repeated ids.

    Rows that agree in id and text share a key and every decision.
    """
    return F.struct(F.col(key).alias("id"), F.xxhash64(whole_text(text)).alias("text_hash"))
