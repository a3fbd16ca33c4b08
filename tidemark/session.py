"""Session settings the operators expect, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings a result or a plan depends on. Shuffle partition counts, memory and executor counts
# belong to the cluster; AQE sizes shuffles at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting falls
    back to a folder of this machine; on a cluster a missing setting is an error, because a
    machine-local folder would be lost with the executor that wrote it.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(_CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(_CHECKPOINT_KEY, root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df):
    """Materialise ``df`` in the shared folder, so that later reads see one and the same set of rows.

    Needed where a result depends on how rows were spread over partitions, such as positions in a sort.
    Reliable files, not executor-local blocks: they outlive the executors that wrote them.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def small_frame(spark: SparkSession, rows: list[tuple], schema: str):
    """A frame of driver-side rows (verdicts, dates, settings) that the planner sees with its real size."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    struct = StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)
