"""Tables on shared storage.

A table is a directory::

    {base}/{namespace}/{name}/versions/v00000001-<id>/  Parquet, one dir per staged write
    {base}/{namespace}/{name}/commits/00000001.json  commit record

Publishing writes a complete new version and only then appends a commit
record, so readers never see a half-written table, a failed write leaves the
current version untouched, and no plan ever overwrites a path it reads (a
static overwrite of an input path destroys the input). Restoring is
appending a commit that points at an older version (S20). A commit record is
one file that is never overwritten: of two writers of a sequence number, one
fails.
``namespace`` scopes dev / prod / ci outputs (S21).

A ``FactTable`` is a catalog table over such a version, partitioned (and
bucketed), whose partitions an increment replaces after its audit.

Every operation is a plain DataFrame or catalog operation, so it works on any
Hadoop-compatible file system the cluster uses.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import names_in, read_small, remove, write_new


class TableNotFound(LookupError):
    pass


class Table:
    """A versioned Parquet table."""

    def __init__(self, spark: SparkSession, base: str, name: str, namespace: str = "dev"):
        self.spark, self.name = spark, name
        self.root = f"{base.rstrip('/')}/{namespace}/{name}"

    # -------------------------------------------------------------- metadata
    def commits(self) -> list[dict]:
        """The commit log (one small record per publish/restore)."""
        return [self._record(name) for name in names_in(self.spark, f"{self.root}/commits") if name.endswith(".json")]

    def current(self) -> dict | None:
        """The newest commit."""
        names = [name for name in names_in(self.spark, f"{self.root}/commits") if name.endswith(".json")]
        return self._record(names[-1]) if names else None

    def _record(self, name: str) -> dict:
        return json.loads(read_small(self.spark, f"{self.root}/commits/{name}"))

    def _next(self) -> int:
        cur = self.current()
        return cur["seq"] + 1 if cur else 1

    def exists(self) -> bool:
        return self.current() is not None

    def version_path(self, version: str) -> str:
        return f"{self.root}/versions/{version}"

    # ----------------------------------------------------------------- reads
    def read(self, version: str | None = None) -> DataFrame:
        if version is None:
            cur = self.current()
            if cur is None:
                raise TableNotFound(self.root)
            version = cur["version"]
        return self.spark.read.parquet(self.version_path(version))

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def props(self) -> dict:
        cur = self.current()
        return cur["props"] if cur else {}

    # ---------------------------------------------------------------- writes
    def _commit(self, seq: int, version: str, op: str, props: dict | None) -> None:
        record = {"seq": seq, "version": version, "op": op, "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(), "props": props or {}}
        write_new(self.spark, f"{self.root}/commits/{seq:08d}.json", json.dumps(record, default=str))

    def stage(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write a complete new version without making it current (the
        'write' of write-audit-publish). Returns the version name."""
        seq = self._next()
        # unique per attempt: two writers staging at once never share files;
        # only one of them can then write the commit record for ``seq``
        version = f"v{seq:08d}-{uuid.uuid4().hex[:12]}"
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.version_path(version))
        return version

    def commit(self, version: str, props: dict | None = None, op: str = "publish") -> None:
        """Make a staged version current (the 'publish')."""
        seq = self._next()
        if not version.startswith(f"v{seq:08d}-"):
            raise RuntimeError(f"{self.root}: {version} was staged against an older log (next is {seq})")
        self._commit(seq, version, op, props)

    def commit_props(self, props: dict) -> None:
        """Records new properties of the current version, whose rows have changed in place."""
        self._commit(self._next(), self.current()["version"], "merge", props)

    def publish(self, df: DataFrame, partition_by: list[str] | None = None,
                props: dict | None = None) -> str:
        """Write a full new version, then make it current."""
        version = self.stage(df, partition_by)
        self.commit(version, props)
        return version

    def discard(self, version: str) -> None:
        """Removes a staged version that was not committed."""
        if version in {c["version"] for c in self.commits()}:
            raise ValueError(f"{self.root}: {version} has been committed")
        remove(self.spark, self.version_path(version))

    def restore(self, version: str) -> None:
        """Make an older version current again (no data is copied)."""
        log = self.commits()
        if version not in {c["version"] for c in log}:
            raise TableNotFound(f"{self.root}@{version}")
        self._commit(log[-1]["seq"] + 1, version, "restore", {"restored": version})


class FactTable(Table):
    """A fact in a catalog table, partitioned by one column and, if asked, bucketed and sorted by its keys within.

    A whole build is a version of its own, as in ``Table``. An increment changes partitions of the current version in
    place: it is staged in a folder beside it, audited there, and then replaces its partitions by dynamic partition
    overwrite. The catalog entry is made again where a session's catalog does not know it (the files say all).
    """

    def __init__(self, spark: SparkSession, base: str, name: str, namespace: str, column: str,
                 bucket_by: tuple[str, ...] = ()):
        super().__init__(spark, base, name, namespace)
        self.column, self.bucket_by = column, tuple(bucket_by)

    @classmethod
    def at(cls, spark: SparkSession, path: str, column: str, bucket_by: tuple[str, ...] = ()) -> "FactTable":
        """The table whose folder is ``path``."""
        base, namespace, name = path.rstrip("/").rsplit("/", 2)
        return cls(spark, base, name, namespace, column, bucket_by)

    def _entry(self, version: str) -> str:
        return "fact_" + hashlib.sha256(self.version_path(version).encode()).hexdigest()[:24]

    def stage_whole(self, df: DataFrame, buckets: int = 0, seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
        """Writes a whole new version, which ``commit`` makes current; ``seen`` may observe the rows as written."""
        version = f"v{self._next():08d}-{uuid.uuid4().hex[:12]}"
        if self.bucket_by:
            w = seen(df.repartition(buckets, *self.bucket_by)).write.bucketBy(buckets, *self.bucket_by).sortBy(*self.bucket_by)
        else:
            w = seen(df.hint("rebalance", self.column)).write
        (w.format("parquet").partitionBy(self.column).mode("errorifexists").option("path", self.version_path(version))
         .option("partitionOverwriteMode", "dynamic").saveAsTable(self._entry(version)))
        return version

    def discard(self, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(version)}")
        super().discard(version)

    def read(self, version: str | None = None) -> DataFrame:
        """The rows of the current version (or of another whole one)."""
        if version is None:
            cur = self.current()
            if cur is None:
                raise TableNotFound(self.root)
            version = cur["version"]
        return self.spark.table(self._known(version))

    def _known(self, version: str) -> str:
        entry, path = self._entry(version), self.version_path(version)
        if not self.spark.catalog.tableExists(entry):
            schema = self.spark.read.parquet(path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            buckets = self.props().get("buckets")
            keys = ", ".join(f"`{c}`" for c in self.bucket_by)
            by = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS" if keys else ""
            self.spark.sql(f"CREATE TABLE {entry} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
                           f"PARTITIONED BY (`{self.column}`) {by} LOCATION '{path}'")
            self.spark.sql(f"MSCK REPAIR TABLE {entry}")
        return entry

    def stage_parts(self, df: DataFrame, seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
        """Writes whole partitions beside the table; returns their folder. Spark sizes the files: small partitions
        share a task, a large one is split."""
        path = f"{self.root}/staged/{uuid.uuid4().hex}"
        seen(df.hint("rebalance", self.column)).write.partitionBy(self.column).parquet(path)
        return path

    def replace(self, staged: DataFrame, emptied: list, buckets: int = 0) -> None:
        """Publishes staged partitions in place of the current ones; ``emptied`` ones lose all rows."""
        entry = self._known(self.current()["version"])
        columns = self.spark.table(entry).columns
        rows = staged.select(*columns)
        rows = rows.repartition(buckets, *self.bucket_by) if self.bucket_by else rows.hint("rebalance", self.column)
        rows.write.insertInto(entry, overwrite=True)
        nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in rows.schema if f.name != self.column)
        for value in emptied:
            literal = f"'{value}'" if value is not None else "null"
            self.spark.sql(f"INSERT OVERWRITE TABLE {entry} PARTITION (`{self.column}` = {literal}) SELECT {nothing} WHERE false")
        self.spark.catalog.refreshTable(entry)


def replace_partitions(df: DataFrame, path: str, partition_col: str) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic mode).

    Spark stages the new files and swaps the touched partition directories at
    commit, so this is safe even when ``df`` was derived from ``path``. Spark
    sizes the files: small partitions share a task, a large one is split.
    """
    (df.hint("rebalance", partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def touched_values(df: DataFrame, col: str) -> list:
    """Distinct partition values of a batch (bounded by the partition count),
    used to prune the target read to the partitions a merge can change (X5)."""
    return [r[0] for r in df.select(col).distinct().collect()]
