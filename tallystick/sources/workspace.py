"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import atexit
import contextvars
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a scratch folder only for local masters."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallystick-"))
    return context.getCheckpointDir().rstrip("/")


# Shuffle files of a write go when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write_tidily(df: DataFrame, folder: str) -> None:
    """Write the frame and delete what its shuffles left on the executors' disks.

    Runs in a copy of the session, so the session's own settings stay as they are.
    """
    session = df.sparkSession
    copy = session._jsparkSession.cloneSession()
    copy.conf().set(_CLEANUP, "true")
    frame = session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(copy, df._jdf.logicalPlan())
    frame.write().option("compression", "zstd").parquet(folder)


_RUN = uuid.uuid4().hex
_ACTIVE: contextvars.ContextVar[Workspace | None] = contextvars.ContextVar("workspace", default=None)
_ALL: weakref.WeakSet[Workspace] = weakref.WeakSet()
_ROOTS: dict[str, Workspace] = {}


class Workspace:
    """The staged tables of one owner, below this run's folder in the shared one.

    ``with workspace:`` makes it the one that ``staged`` writes to. Releasing it leaves the
    tables of other owners alone; what is left of the run goes when the process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tallystick/run-{_RUN}"
        self._configuration = spark._jsc.hadoopConfiguration()
        self._jvm = spark._jvm
        self._folders: list[str] = []
        self._staged: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
        self._outer: list[contextvars.Token] = []
        _ALL.add(self)
        if self.root not in _ROOTS:
            _ROOTS[self.root] = self
            atexit.register(self._remove_quietly, self.root)

    def __enter__(self) -> Workspace:
        self._outer.append(_ACTIVE.set(self))
        return self

    def __exit__(self, *_) -> None:
        _ACTIVE.reset(self._outer.pop())

    def new_folder(self, label: str) -> str:
        folder = f"{self.root}/{label}-{uuid.uuid4().hex}"
        self._folders.append(folder)
        return folder

    def staged(self, df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
        """Write once, read many times.

        Cuts the lineage, survives the loss of executors, and keeps column pruning and
        size statistics for the plans that read it back. ``tidy`` deletes the shuffles that led
        here when the write ends.
        """
        folder = self.new_folder(label)
        if tidy:
            _write_tidily(df, folder)
        else:
            df.write.parquet(folder)
        staged = df.sparkSession.read.schema(df.schema).parquet(folder)
        self._staged[staged] = folder
        return staged

    def discard(self, staged: DataFrame) -> None:
        """Delete a table that ``staged`` returned, when nothing will read it any more."""
        folder = self._staged.pop(staged)
        self._folders.remove(folder)
        self._remove(folder)

    def release(self) -> None:
        """Delete this owner's tables; frames that still read them stop working."""
        while self._folders:
            self._remove(self._folders.pop())

    def _remove(self, folder: str) -> None:
        path = self._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self._configuration).delete(path, True)

    def _remove_quietly(self, folder: str) -> None:
        """At the end of the process the JVM may be gone already."""
        try:
            self._remove(folder)
        except Exception:  # noqa: BLE001
            pass


_DEFAULTS: weakref.WeakKeyDictionary[SparkSession, Workspace] = weakref.WeakKeyDictionary()


def _current(spark: SparkSession) -> Workspace:
    """The active workspace, else the session's own."""
    active = _ACTIVE.get()
    if active is not None:
        return active
    if spark not in _DEFAULTS:
        _DEFAULTS[spark] = Workspace(spark)
    return _DEFAULTS[spark]


def new_folder(spark: SparkSession, label: str) -> str:
    return _current(spark).new_folder(label)


def staged(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    return _current(df.sparkSession).staged(df, label, tidy)


def discard_staged(spark: SparkSession) -> None:
    """Delete what this process staged, whoever owns it."""
    for workspace in list(_ALL):
        workspace.release()
