"""Session helpers: a sensible local session for tests, and reliable lineage cuts."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "recordflow", cpus: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", conf.pop("shuffle_partitions", "8"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        # scratch tables of the sink operators stay out of the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="recordflow-warehouse-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    folder would lose the data together with the executor that wrote it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="recordflow-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


class Scope:
    """Folders that a piece of work writes on its way: staged results and checkpoints."""

    def __init__(self, spark: SparkSession, outer: Scope | None):
        self.spark, self.outer = spark, outer
        self.paths: list[str] = []

    def owned_by(self, df: DataFrame) -> list[str]:
        """The folders of this scope that a frame reads its files from."""
        read = [_plain(f) for f in df.inputFiles()]
        return [p for p in self.paths if any(f.startswith(_plain(p) + "/") for f in read)]

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave what the frame reads in place when the scope ends; an outer scope then owns it."""
        for path in self.owned_by(df):
            self.paths.remove(path)
            if self.outer is not None:
                self.outer.paths.append(path)
        return df

    def take(self, paths: list[str]) -> None:
        """Own these folders from now on, instead of the outer scope."""
        for path in paths:
            if self.outer is not None and path in self.outer.paths:
                self.outer.paths.remove(path)
            self.paths.append(path)

    def free(self, df: DataFrame) -> None:
        """Remove now what the frame reads: its last reader is done."""
        for path in self.owned_by(df):
            self.paths.remove(path)
            _remove(self.spark, path)

    def close(self) -> None:
        while self.paths:
            _remove(self.spark, self.paths.pop())


_SCOPE: ContextVar[Scope | None] = ContextVar("recordflow_scope", default=None)


def _plain(path: str) -> str:
    """The path without its scheme, as one can be told from another."""
    return unquote(urlparse(path).path).rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Own the scratch folders that are made inside, and remove them at the end, also after an error.

    Frames are lazy: write the result inside the scope, to its own place or staged and passed to ``keep``.
    Without a scope, folders stay until whoever named the shared folder removes them.
    """
    scope = Scope(spark, _SCOPE.get())
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        scope.close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, so far unused folder below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{os.urandom(8).hex()}"
    if (scope := _SCOPE.get()) is not None:
        scope.paths.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage so that later reads see one fixed result."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    cut = df.checkpoint(eager=True)
    if (scope := _SCOPE.get()) is not None:
        file = cut._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            scope.paths.append(file.get())
    return cut
