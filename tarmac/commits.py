"""Commit records: an empty file, made last, says that a folder of files is complete and current.

A record is named ``<name>@<save id>`` under ``root``/_commits; file listings of ``root`` pass over names that begin with "_".
Writers put each save in a folder of its own, so readers of an earlier save never see files go.
"""

from __future__ import annotations

import os
import time
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

COMMITS = "_commits"


def new_save_id() -> str:
    """Later saves sort after earlier ones."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _folder(spark: SparkSession, root: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, COMMITS))
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def commit(spark: SparkSession, root: str, name: str, save_id: str) -> None:
    at, fs = _folder(spark, root)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(at, f"{quote(name, safe='')}@{save_id}"), True).close()


def records(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(name, save id) of every record, earlier saves first: one listing, empty if there is none."""
    at, fs = _folder(spark, root)
    names = [x.getPath().getName().rpartition("@") for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(((unquote(n), s) for n, sep, s in names if sep), key=lambda x: x[1])


def committed(spark: SparkSession, root: str) -> dict[str, str]:
    """The latest committed save of each name."""
    return dict(records(spark, root))


def forget(spark: SparkSession, root: str, name: str, save_id: str) -> None:
    at, fs = _folder(spark, root)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at, f"{quote(name, safe='')}@{save_id}"), False)
