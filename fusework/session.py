"""Session settings and staged tables."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fusework")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # no Python stack per column: building large expressions gets several times faster
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint folder.

    A temporary folder is made only in local mode, where driver and executors share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fusework-")
    return configured.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core, for work that is heavy on CPU and light on bytes.

    Meant for stored tables, whose partitions are known without running anything. A table with
    enough splits, as every large one, is left alone.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


class IntegrityError(RuntimeError):
    """A table broke a rule; it was not published."""


class StageStore:
    """Parquet tables of one run; writing a stage cuts its lineage and survives lost executors.

    A stage is written to a folder of its own and exists for readers once its manifest does: a small file that names the
    folder, the rows, the observed metrics and the ``fingerprint`` of what the run was made from. A run that is
    started again over the same root finds the stages that an earlier one published from the same inputs.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fingerprint: str = ""):
        self.spark = spark
        self.root = (root or f"{shared_dir(spark)}/fusework-{uuid.uuid4().hex}").rstrip("/")
        self.fingerprint = fingerprint

    def path(self, name: str) -> str:
        """The folder of a published stage, or the one that a table of this name would have by itself."""
        manifest = self._manifest(name)
        return manifest["folder"] if manifest else f"{self.root}/{name}"

    def save(
        self,
        df: DataFrame,
        name: str,
        partition_by: tuple[str, ...] = (),
        checks: Mapping[str, Column] | None = None,
        counts: Mapping[str, Column] | None = None,
        verify: Callable[[dict], Sequence[str]] | None = None,
        helpers: Sequence[str] = (),
    ) -> DataFrame:
        """Writes, checks and publishes a stage, in one pass over its rows.

        ``checks`` are aggregates that count violations, ``counts`` other numbers; both may use the columns ``helpers``, which
        are not written. ``verify`` gets all of them, and ``rows``, and names what is wrong. The numbers are
        observed at the write itself, where each task counts once. A violation raises and publishes nothing.
        """
        numbers = {**(checks or {}), **(counts or {})}
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in numbers.items()]).drop(*helpers)
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        writer = observed.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        metrics = dict(seen.get)
        wrong = [f"{n}: {metrics[n]}" for n in checks or () if metrics[n]]
        wrong += list(verify(metrics)) if verify else []
        if wrong:
            self._delete(folder)
            raise IntegrityError(f"{name} was not published; {'; '.join(wrong)}")
        before = self._manifest(name, any_input=True)
        self._publish(name, {"folder": folder, "fingerprint": self.fingerprint, "metrics": metrics, "schema": observed.schema.json()})
        if before:
            self._delete(before["folder"])
        # the schema is known, so reading back starts no inference job
        return self.spark.read.schema(observed.schema).parquet(folder)

    def load(self, name: str) -> DataFrame:
        """A published stage; a missing one is an error that names the path."""
        manifest = self._manifest(name)
        if not manifest:
            return self.spark.read.parquet(self.path(name))
        return self.spark.read.schema(StructType.fromJson(json.loads(manifest["schema"]))).parquet(manifest["folder"])

    def published(self, name: str) -> bool:
        """Whether the stage is there and was made from the same inputs."""
        return self._manifest(name) is not None

    def metrics(self, name: str) -> dict:
        """The numbers observed while the stage was written."""
        return self._manifest(name)["metrics"]

    def discard(self, name: str) -> None:
        """Takes back a stage and deletes its rows."""
        manifest = self._manifest(name, any_input=True)
        if manifest:
            self._delete(self._manifest_path(name))
            self._delete(manifest["folder"])

    def clear(self) -> None:
        """Deletes everything under the root."""
        self._delete(self.root)

    def _manifest_path(self, name: str) -> str:
        return f"{self.root}/_stages/{name.replace('/', '.')}.json"

    def _manifest(self, name: str, any_input: bool = False) -> dict | None:
        fs, path = file_system(self.spark, self._manifest_path(name))
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return found if any_input or found["fingerprint"] == self.fingerprint else None

    def _publish(self, name: str, manifest: dict) -> None:
        """Writes the manifest beside its place and moves it there: readers see the old one, none or the new one."""
        place = self._manifest_path(name)
        fs, draft = file_system(self.spark, f"{place}.{uuid.uuid4().hex}")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(manifest, default=str).encode()))
        finally:
            stream.close()
        _, path = file_system(self.spark, place)
        fs.delete(path, False)
        if not fs.rename(draft, path):
            raise OSError(f"{place} could not be written")

    def _delete(self, path: str) -> None:
        fs, place = file_system(self.spark, path)
        fs.delete(place, True)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it wants it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def input_fingerprint(*tables: DataFrame) -> str:
    """A digest of what tables are made from: their plans, and name, size and time of each file they read."""
    digest = hashlib.sha256()
    for df in tables:
        spark = df.sparkSession
        digest.update(df.schema.json().encode())
        files = sorted(df.inputFiles())
        if not files:
            # rows that come from no file can be told apart by their plan only
            digest.update(str(df.semanticHash()).encode())
        for name in files:
            fs, path = file_system(spark, name)
            status = fs.getFileStatus(path)
            digest.update(f"{name}|{status.getLen()}|{status.getModificationTime()}".encode())
    return digest.hexdigest()
