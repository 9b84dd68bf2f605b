"""Tables in the shared folder of the cluster, to cut lineage and to read a result more than once."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from reelspark.session import checkpoint_dir

#: Bytes of one Arrow batch at most (one row at least), so that long texts don't fill a task's memory.
ARROW_BYTES = 4 << 20


_SHIPPED: set[str] = set()


def task_session(spark: SparkSession) -> SparkSession:
    """Gives the executors this library, and bounds what goes to a Python task at once by bytes, not only by rows."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        # Spark serves the archive to the executors from here; it holds code only.
        archive = shutil.make_archive(os.path.join(os.path.realpath(tempfile.mkdtemp()), "reelspark"), "zip", root, "reelspark")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes ``df`` once and returns a frame that reads it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
