"""Small files on the shared file system that only one writer can create, whole at once."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    """Hadoop's path and file system, and the path on this machine if that is where the file system keeps it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return at, system, at.toUri().getPath() if system.getUri().getScheme() == "file" else None


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    at, system, own = _place(spark, folder)
    if own is not None:
        return [n for n in os.listdir(own) if os.path.isfile(f"{own}/{n}")] if os.path.isdir(own) else []
    return [f.getPath().getName() for f in system.listStatus(at) if f.isFile()] if system.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """What `create_once` wrote."""
    own = _place(spark, path)[2]
    if own is not None:
        with open(own, encoding="ascii") as f:
            return f.read()
    return "".join(r[0] for r in spark.read.text(path).collect())


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with this text; False if there is one. A file system that is no
    local disk must refuse to create what exists, as HDFS does."""
    at, system, own = _place(spark, path)
    if own is not None:
        os.makedirs(os.path.dirname(own), exist_ok=True)
        aside = f"{os.path.dirname(own)}/.{uuid.uuid4().hex}"
        with open(aside, "x", encoding="ascii") as f:
            f.write(text)
        try:
            os.link(aside, own)  # whole at once, and only if there is none
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
        return True
    try:
        out = system.create(at, False)
    except Exception:
        if system.exists(at):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or a folder with all it holds, if it is there."""
    at, system, _ = _place(spark, path)
    system.delete(at, True)
