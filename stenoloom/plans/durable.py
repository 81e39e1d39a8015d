"""Lineage cuts that survive the loss of executors.

Everything is written below the shared folder named by ``spark.checkpoint.dir``, in one folder
of each session that is removed when the session's driver ends.  A folder of our own is set
only where the session names none and runs on one machine (unit tests).

:func:`cut` writes when it is called, so queries that use it run jobs while they are built.
"""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This session's folder in the folder all executors share.

    Raises where the session names no shared folder and has executors on other machines: they
    would write to disks of their own, and what is read back would lack rows without an error.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _folders:
        configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
        if not configured:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
            configured = "file://" + tempfile.mkdtemp(prefix="stenoloom-")
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{configured.rstrip('/')}/run-{uuid.uuid4().hex}")
        files = path.getFileSystem(sc._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _folders[sc.applicationId] = files.makeQualified(path).toString()
    return _folders[sc.applicationId]


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back, without its lineage.

    Unlike a checkpointed plan the table has true sizes, so the joins that follow are planned
    by what is there and an iteration's estimates don't multiply round by round.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def drop(*cuts: DataFrame | None) -> None:
    """Delete the tables behind ``cuts``, which must be needed no more."""
    for df in cuts:
        if path := getattr(df, "_cut_path", None):
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _put(spark: SparkSession, content: bytes, name: str) -> str:
    """Write ``content`` into the shared folder; its full path."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(conf).create(path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    return path.getFileSystem(conf).makeQualified(path).toString()


def shared_file(spark: SparkSession, content: bytes, name: str) -> str:
    """Put ``content`` into the shared folder and let Spark hand it to every executor.

    Returns the name under which ``SparkFiles.get`` finds it on a worker; an executor that
    takes the place of a lost one fetches it anew.
    """
    unique = f"{name}-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(_put(spark, content, unique))
    return unique


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the workers of a session, once, wherever they were started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    package = Path(__file__).resolve().parents[1]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(package.rglob("*")):
            if p.is_file() and "__pycache__" not in p.parts:
                z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(_put(spark, out.getvalue(), f"{package.name}-{uuid.uuid4().hex}.zip"))
    _shipped.add(app)
