"""SparkSession settings the models rely on.

Correctness settings (always applied):

* ``spark.sql.session.timeZone=UTC``: ``to_date`` / month truncation of a
  timestamp depend on the session zone.
* ``spark.sql.ansi.enabled=true``: failed casts raise instead of silently
  producing NULL, so every lenient cast is spelled ``try_cast``.

Performance settings (applied only when the caller has not set them, so a
cluster's own tuning wins): AQE with partition coalescing and skew-join
splitting, runtime broadcast conversion bounded by a size threshold.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CORRECTNESS_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

PERFORMANCE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE converts a sort-merge join to a broadcast join only after the
    # shuffle stage has run and its real size is known to be under this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in CORRECTNESS_CONF.items():
        spark.conf.set(k, v)
    for k, v in PERFORMANCE_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "reelspark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**CORRECTNESS_CONF, **PERFORMANCE_DEFAULTS}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_FALLBACK: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this is the ``spark.checkpoint.dir`` the cluster names; it is
    read from the session and never overridden. Only where it is unset (local
    tests) a fallback is set, so lineage can still be cut with
    ``DataFrame.checkpoint()``.
    """
    app = spark.conf.get("spark.app.id", "")
    d = spark.conf.get("spark.checkpoint.dir", None) or _FALLBACK.get(app)
    if not d:
        if not fallback and not spark.conf.get("spark.master", "local").startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = fallback or tempfile.mkdtemp(prefix="reelspark-ckpt-")
        _FALLBACK[app] = d
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - a session may refuse runtime core confs
            pass
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a DataFrame reading it back.

    This cuts lineage like ``checkpoint()`` but costs one job instead of two
    (an eager reliable checkpoint of an unpersisted plan computes it twice),
    and the re-read carries file-size statistics for Catalyst's join choice.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"stored/{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # no job to find the schema


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    store, at = _place(spark, path)
    return store.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; of one that is not there, none."""
    store, at = _place(spark, path)
    return sorted(x.getPath().getName() for x in store.listStatus(at)) if store.exists(at) else []


def read_small(spark: SparkSession, path: str) -> str:
    """A small file (a record of this library's own) as text, without a Spark job."""
    store, at = _place(spark, path)
    source = store.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that must not be there yet: of two writers, one fails."""
    store, at = _place(spark, path)
    target = store.create(at, False)
    try:
        target.write(bytearray(text.encode()))
    finally:
        target.close()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate folder that this library has written and nothing reads any more."""
    store, at = _place(spark, path)
    store.delete(at, True)
