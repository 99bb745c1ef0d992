"""Intermediates on the cluster's shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import threading
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from quill.session import ensure_checkpoint_dir

_made: dict[str, list[str]] = {}
_frames: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def scratch_path(spark: SparkSession) -> str:
    """A new path below the shared folder that the cluster names in
    ``spark.checkpoint.dir``. What lies there is deleted by :func:`clear`, at the latest
    when the driver's process ends in good order."""
    context = spark.sparkContext.applicationId
    if context not in _made:
        _made[context] = []
        atexit.register(_at_exit, spark)
    path = f"{ensure_checkpoint_dir(spark)}/quill-{uuid.uuid4().hex}"
    _made[context].append(path)
    return path


def written(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to a scratch path and read it back: computed once however
    many branches read it, columns pruned on reading, and lineage cut, so that a lost
    executor costs only the tasks that read the files again."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path, partitionBy=partition_by)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _frames[kept] = path
    return kept


def drop(*frames: DataFrame) -> None:
    """Deletes the files of frames that :func:`written` returned, when nothing that is still to be
    computed reads them. Other frames are left alone."""
    for df in frames:
        path, sc = _frames.pop(df, None), df.sparkSession.sparkContext
        if path is not None and path in _made.get(sc.applicationId, []):
            _made[sc.applicationId].remove(path)
            _delete(sc, path)


def _delete(sc, path: str) -> bool:
    path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def files_released(spark: SparkSession, every: float = 10.0) -> Iterator[None]:
    """Collects the driver's garbage every ``every`` seconds while the block runs, and at its end.
    Spark deletes shuffle files of data that nothing refers to only after a collection
    (``spark.cleaner.periodicGC.interval``, half an hour unless the session sets it), by when
    a long iterative job has filled the disks."""
    over, system = threading.Event(), spark.sparkContext._jvm.System

    def collect() -> None:
        while not over.wait(every):
            system.gc()

    thread = threading.Thread(target=collect, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        system.gc()


def _at_exit(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):                # the JVM may be gone already
        clear(spark)


def clear(spark: SparkSession) -> int:
    """Deletes every intermediate that this application has written; returns how many.
    Call it when no result that reads them is needed any more."""
    sc = spark.sparkContext
    if sc._jsc is None:                                 # stopped: nothing to delete with
        return 0
    paths, gone = _made.get(sc.applicationId, []), 0
    while paths:
        gone += _delete(sc, paths.pop())
    return gone
