"""Versions of an output that are switched as a whole.

A run writes its parts below a version of its own; nothing that readers see changes until ``commit``
adds a pointer, an empty file whose name holds a running number and the version.  A file is created at
once or not at all on every store, so readers find the old version or the new one, whole.  A run that
fails leaves a version that no pointer names.  Pointers live in ``_current``, which listings skip.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

POINTERS = "_current"


def new_version() -> str:
    return uuid.uuid4().hex


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _folder(base: str, name: str) -> str:
    """Where the pointers of one upload are; its name may be a whole key."""
    return f"{base.rstrip('/')}/{POINTERS}/{re.sub('[^A-Za-z0-9._-]', lambda m: '%%%02X' % ord(m[0]), name)}"


def history(spark: SparkSession, base: str, name: str) -> list[str]:
    """Committed versions of ``name`` below ``base``, the current one last."""
    fs, at = _fs(spark, _folder(base, name))
    if not fs.exists(at):
        return []
    found = sorted(x.getPath().getName() for x in fs.listStatus(at))
    return [p.split("-", 1)[1] for p in found if re.fullmatch(r"\d{12}-.+", p)]


def current(spark: SparkSession, base: str, name: str) -> str | None:
    done = history(spark, base, name)
    return done[-1] if done else None


def commit(spark: SparkSession, base: str, name: str, version: str) -> None:
    """``version`` becomes the current one.  Of two commits at once the greater name wins, for all readers."""
    fs, at = _fs(spark, _folder(base, name))
    fs.mkdirs(at)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(at, f"{len(history(spark, base, name)) + 1:012d}-{version}")
    fs.create(pointer, False).close()


def drop_superseded(spark: SparkSession, base: str, name: str, folders: list[str]) -> None:
    """Remove the folders ``<base>/<folder>/version=<v>`` of versions that a later commit has replaced."""
    for version in history(spark, base, name)[:-1]:
        for folder in folders:
            fs, at = _fs(spark, f"{base.rstrip('/')}/{folder}/version={version}")
            if fs.exists(at):
                fs.delete(at, True)
