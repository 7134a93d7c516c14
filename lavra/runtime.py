"""Shared plumbing: where intermediate tables live, how small models reach the workers."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a model may have before it is joined instead of broadcast.
BROADCAST_ROWS = 400_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one of our own on a local master."""
    set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if set_dir.isDefined():
        return set_dir.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lavra-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/lavra-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> pa.Table | None:
    """``df`` on the driver if it has at most ``rows`` rows, else None; the caller then joins."""
    got = df.limit(rows + 1).toArrow()
    return got if got.num_rows <= rows else None


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked to be sent whole if a count shows at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``fn``: iterator of tuples of column lists (one per column of ``df``) to iterator of column lists of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        lists = (tuple(c.to_pylist() for c in b.columns) for b in batches)
        for out in fn(lists):
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)
