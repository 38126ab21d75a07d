"""Pareto fronts of solutions per segment, both criteria to be minimised.

The number of a point's front is one more than the highest front among the points that
dominate it. Sorted by both criteria, it follows from one sweep that remembers the least
second criterion of each front so far: a staircase whose steps only rise, so the front is
found by bisection.

A front within a part of the points is never later than within all of them. So tasks first
number the points they read and drop those beyond the fronts that can be asked for; parts
are merged in groups until one sweep for each segment is left. Points are read once, and
no number of fronts costs a further pass.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from mediamix.session import cut_lineage, release

# Fixed values.
FRONTS = 3
MIN_CANDIDATES = 200

# Points that a task numbers at a time, and parts that are merged into one.
BLOCK = 1 << 16
MERGED = 64


def front_numbers(code: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Front of each point among those of its ``code``, from 1; ``most + 1`` for all later ones.

    Equal points share a front.
    """
    order = np.lexsort((y, x, code))
    numbers = np.empty(len(code), np.int32)
    found, stairs, before = 0, [], None
    out = []
    for point in zip(code[order].tolist(), x[order].tolist(), y[order].tolist()):
        if point != before:
            if before is None or point[0] != before[0]:
                stairs = []
            found = bisect_right(stairs, point[2])
            if found < most:
                stairs[found : found + 1] = [point[2]]
            before = point
        out.append(found + 1)
    numbers[order] = out
    return numbers


def _criteria(table: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns as doubles; not-a-numbers are as bad as can be."""
    columns = [np.asarray(table.column(n).cast(pa.float64())) for n in names]
    return [np.where(np.isnan(c), np.inf, c) for c in columns]


def _numbered(table: pa.Table, segment: str, x: str, y: str, most: int) -> np.ndarray:
    code = np.asarray(pc.dictionary_encode(table.column(segment), null_encoding="encode").combine_chunks().indices)
    return front_numbers(code, *_criteria(table, x, y), most)


def _survivors(points: DataFrame, segment: str, x: str, y: str, most: int) -> DataFrame:
    """Points of the first ``most`` fronts within blocks of each task, with ``__part``: the task."""
    schema = StructType([*points.schema.fields, StructField("__part", IntegerType())])
    arrow = to_arrow_schema(schema)

    def kept(held: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        table = table.filter(pa.array(_numbered(table, segment, x, y, most) <= most))
        return table.combine_chunks().to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, n = TaskContext.get().partitionId(), [], 0

        def named(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                yield pa.RecordBatch.from_arrays([*part.columns, pa.repeat(pa.scalar(task, pa.int32()), part.num_rows)], schema=arrow)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= BLOCK:
                held = kept(held)
                n = sum(b.num_rows for b in held)
                if n > BLOCK // 2:  # too little to gain from more points of this task
                    yield from named(held)
                    held, n = [], 0
        if held:
            yield from named(kept(held))

    return points.mapInArrow(run, schema)


def pareto_fronts(
    points: DataFrame,
    fronts: int = FRONTS,
    min_candidates: int = MIN_CANDIDATES,
    x: str = "nrmse",
    y: str = "decomp_rssd",
    segment: str = "segment",
) -> DataFrame:
    """Points of the first fronts of each segment with their ``front`` number.

    A segment has ``fronts`` of them, and more until there are ``min_candidates`` points or
    all are used up. Every front has a point at least, so no more than the larger of the two
    numbers can be needed, which bounds what tasks keep. Points without a criterion take no
    part; a null segment is one of its own.
    """
    most = max(fronts, min_candidates, 1)
    proper = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    rest = cut_lineage(_survivors(proper, segment, x, y, most))
    while (parts := (rest.agg(F.max("__part")).first()[0] or 0) + 1) > MERGED:
        groups = -(-parts // MERGED)
        dealt = rest.withColumn("__part", F.col("__part") % groups).repartition(groups, segment, "__part").drop("__part")
        merged = cut_lineage(_survivors(dealt, segment, x, y, most))
        release(rest)
        rest = merged
    schema = StructType([*points.schema.fields, StructField("front", IntegerType())])
    arrow = to_arrow_schema(schema)

    def finished(table: pa.Table) -> pa.RecordBatch | None:
        """The asked fronts of whole segments."""
        numbers = _numbered(table, segment, x, y, most)
        code = np.asarray(pc.dictionary_encode(table.column(segment), null_encoding="encode").combine_chunks().indices)
        counts = np.zeros((int(code.max()) + 1, most + 2), np.int64)
        np.add.at(counts, (code, numbers), 1)
        enough = np.cumsum(counts, axis=1) >= min_candidates
        last = np.where(enough.any(1), np.maximum(enough.argmax(1), fronts), most)
        chosen = np.flatnonzero(numbers <= last[code])
        table = table.take(pa.array(chosen)).append_column("front", pa.array(numbers[chosen], pa.int32())).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in table.columns], schema=arrow)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table.column(segment)[-1]
            same = pc.is_null(table.column(segment)) if not last.is_valid else pc.fill_null(pc.equal(table.column(segment), last), False)
            start = pc.index(same, True).as_py()  # rows come sorted: what stands before is complete
            if start:
                yield finished(table.slice(0, start))
            table = table.slice(start)
            table = table.filter(pa.array(_numbered(table, segment, x, y, most) <= most))
            held, n = table.combine_chunks().to_batches(), table.num_rows
        if held:
            yield finished(pa.Table.from_batches(held))

    return rest.drop("__part").repartition(segment).sortWithinPartitions(segment).mapInArrow(run, schema)


def front(points: DataFrame, x: str = "nrmse", y: str = "decomp_rssd", segment: str = "segment") -> DataFrame:
    """Points no other point of the segment dominates."""
    return pareto_fronts(points, 1, 0, x, y, segment).drop("front")
