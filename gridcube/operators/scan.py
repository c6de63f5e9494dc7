"""Ordered scans over rows of any distribution: forward fill.

Rows are range-partitioned by (entity, order), so an entity with most of the rows
is spread over as many tasks as its size needs, ties included. Each partition is
filled in one streaming pass; what its leading rows lack is the last value of the
partitions before it, carried over by a scan of one row per partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType

from gridcube.session import materialize


def _changed(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before it (NULL equals NULL, NaN equals
    NaN); the first place counts as no change."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    differs = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        differs = differs & ~(pc.fill_null(pc.is_nan(a), False).to_numpy(zero_copy_only=False) & pc.fill_null(pc.is_nan(b), False).to_numpy(zero_copy_only=False))
    apart = a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False)
    return np.concatenate([[False], differs | apart])


def _fill(batches, keys: list[int], columns: list[int], names: list[str]):
    """The rows of one sorted partition, filled inside it, and their partition,
    place, and whether they belong to its first entity."""
    before, leading, n = None, True, 0
    for b in batches:
        if not b.num_rows:
            continue
        arrays = list(b.columns)
        joined = arrays if before is None else [pa.concat_arrays([p, c]) for p, c in zip(before, arrays)]
        skip, m = len(joined[0]) - b.num_rows, len(joined[0])
        new = np.zeros(m, bool)
        for k in keys:
            new |= _changed(joined[k])
        place = np.arange(m)
        start = np.maximum.accumulate(np.where(new, place, 0))
        for c in columns:
            there = joined[c].is_valid().to_numpy(zero_copy_only=False)
            last = np.maximum.accumulate(np.where(there, place, -1))
            joined[c] = joined[c].take(pa.array(last, mask=last < start))
        first = np.full(m, leading) & (np.cumsum(new) == 0)
        leading = bool(first[-1])
        before = [c.slice(m - 1, 1) for c in joined]
        yield pa.RecordBatch.from_arrays(
            [*[c.slice(skip) for c in joined], pa.array(np.full(b.num_rows, TaskContext.get().partitionId(), np.int64)),
             pa.array(np.arange(n, n + b.num_rows, dtype=np.int64)), pa.array(first[skip:])], names=[*names, "__part", "__place", "__leading"])
        n += b.num_rows


def fill_forward(df: DataFrame, columns: list[str], partition_by: list[str], order_by: list) -> DataFrame:
    """Carry the last non-null value forward inside each entity, in the order
    ``order_by`` (NULLs first). Rows that tie there go by a hash of the row, so the
    result is the same however they were distributed; NULL entities are one
    entity, and NaN is a value. Without ``partition_by`` the table is one entity.

    One range shuffle and one written copy; the carries are a row per partition,
    which a window over the partitions (not the rows) brings in order."""
    order = [F.col(f"`{o}`") if isinstance(o, str) else o for o in order_by]
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() != "map"])
    by = [*[F.col(f"`{k}`") for k in partition_by], *order, tie]
    names = [f"_{i}" for i in range(len(df.columns))]      # by place: column names may hold anything
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).toDF(*names)
    schema = type(df.schema)(list(ranged.schema.fields)).add("__part", LongType()).add("__place", LongType()).add("__leading", BooleanType())
    at, what = [df.columns.index(k) for k in partition_by], [df.columns.index(c) for c in columns]
    filled = materialize(ranged.mapInArrow(lambda batches: _fill(batches, at, what, names), schema), "fill")

    entity = F.struct(F.lit(0).alias("k"), *[F.col(names[k]).alias(f"k{i}") for i, k in enumerate(at)])
    value = [F.col(names[c]).alias(f"v{i}") for i, c in enumerate(what)]
    ends = filled.groupBy("__part").agg(F.min_by(entity, "__place").alias("first"), F.max_by(F.struct(entity.alias("last"), *value), "__place").alias("z")) \
        .select("__part", "first", "z.*")
    # the last value an entity had at the end of any partition so far; then that of the partition before
    so_far = Window.partitionBy("last").orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = Window.orderBy("__part")
    ends = ends.select("__part", "first", "last", *[F.last(f"v{i}", ignorenulls=True).over(so_far).alias(f"__c{i}") for i in range(len(columns))])
    same = F.lag("last").over(step).eqNullSafe(F.col("first"))
    carry = ends.select("__part", *[F.when(same, F.lag(f"__c{i}").over(step)).alias(f"__c{i}") for i in range(len(columns))])
    out = filled.join(carry, "__part", "left")
    return out.select(*[(F.coalesce(n, F.when(F.col("__leading"), F.col(f"__c{what.index(i)}"))) if i in what else F.col(n)).alias(df.columns[i])
                        for i, n in enumerate(names)])
