"""What the operators of this package share: sessions, batches of documents, running sums over a global order.

Conventions. Operators read the id and text columns they are told of and no other column of the input, so extra
columns, whatever their names, change nothing. Rows are never merged: a repeated row gives a repeated result row. Where
documents are compared by id, a null id counts as larger than every other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import checkpointed, configure, scratch_path

LARGEST = 2**63 - 1

# Words are separated by blank, tab, line feed, vertical tab, form feed and carriage return; bytes.split() separates at
# the same six.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS, BATCH_BYTES = 20_000, 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of this package: batches small enough that long documents fit a worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: like a checkpoint, but packed, for frames with many rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def comparable_id(column: str) -> Column:
    """The id as a number that is never null. Ids are integers, or texts of integers; any other text is an error."""
    return F.coalesce(F.col(column).cast("bigint"), F.lit(LARGEST))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8; a null text is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def each_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str | T.StructType
) -> DataFrame:
    """Apply ``work`` to every record batch; it returns the columns of the result by name."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(struct)
        for batch in batches:
            if batch.num_rows:
                columns = work(batch)
                arrays = [
                    columns[f.name].cast(f.type)
                    if isinstance(columns[f.name], pa.Array)
                    else pa.array(columns[f.name], type=f.type)
                    for f in target
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, struct)


def running_sums(df: DataFrame, order: list[str], value: str, group: str | None, total: str) -> DataFrame:
    """Add the inclusive running sum of ``value`` along ``order``, over all rows or within each ``group``.

    The rows are range-sorted over all tasks (``order`` must start with ``group``). Every task sums its own rows; what
    it starts from is the sum of the shares of the tasks before it, one figure per task and group in it. The frame is
    checkpointed, because the shares depend on sampled range bounds and must not be computed twice.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_run", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        target, part = to_arrow_schema(schema), TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sums = np.cumsum(batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64))
            keys = (batch.column(group).to_numpy(zero_copy_only=False) if group else np.zeros(n, dtype=np.int64))
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            before = np.where(starts > 0, sums[starts - 1], 0)
            if last is not None and keys[0] == last:
                before[0] -= carried
            sums = sums - np.repeat(before, np.diff(np.append(starts, n)))
            last, carried = keys[-1], sums[-1]
            arrays = [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    from pyspark.sql import Window

    rows = checkpointed(ranged.mapInArrow(run, schema))
    by = [group] if group else []
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = (
        rows.groupBy("_part", *by)
        .agg(F.max("_run").alias("_share"))
        .select("_part", *by, F.coalesce(F.sum("_share").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = rows.join(shares, ["_part", *by])
    return joined.withColumn(total, F.col("_before") + F.col("_run")).drop("_part", "_run", "_before")
