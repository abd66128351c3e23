"""Cutting a plan's lineage through the folder that the cluster shares."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(session: SparkSession) -> str:
    """spark.checkpoint.dir. Where none is set, a folder of our own if all runs on this machine; a cluster must name one."""
    context = session.sparkContext
    if context.getCheckpointDir() is None:
        folder = session.conf.get("spark.checkpoint.dir", None)
        if folder is None and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="sommelix-"))
    return context.getCheckpointDir()


def shared_path(session: SparkSession, kind: str) -> str:
    """A new name in the shared folder."""
    return f"{shared_folder(session)}/{kind}-{uuid.uuid4().hex}"


def cut(frame: DataFrame) -> DataFrame:
    """The frame as a checkpoint in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def saved(frame: DataFrame) -> DataFrame:
    """The frame as a compressed table in the shared folder, which goes when the driver ends. Its size is known from then on, so
    joins with it are planned by what it is and not by what its plan might have given: for loops, and tables read repeatedly."""
    session = frame.sparkSession
    name = shared_path(session, "table")
    frame.write.parquet(name)
    atexit.register(remove, session, name)
    return session.read.parquet(name)


def remove(session: SparkSession, name: str) -> None:
    """Delete a folder, unless the session has ended."""
    context = session.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
