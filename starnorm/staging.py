"""Tables written once to shared storage so that several consumers can read them.

A staged table cuts the lineage behind it, survives the loss of executors and
gives Catalyst column pruning and exact file sizes, none of which a cached or
recomputed frame offers.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from starnorm.hadoop import delete_tree

# Staged tables are read a few times and deleted: small ones spare disk and network.
COMPRESSION = "zstd"

# Deletes the files of a query's shuffles when the query ends.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_FOLDERS: dict[str, str] = {}
# By session: open blocks of :func:`freed_shuffles`, and the setting before the first.
_FREEING: dict[str, tuple[int, str]] = {}
_FREEING_LOCK = threading.Lock()
# Tables staged in each open block of scratch work, the innermost last.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master within one process, which has no second machine, may fall
    back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", None) or ""):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS.setdefault(app, tempfile.mkdtemp(prefix="starnorm-"))
    return _LOCAL_FOLDERS[app]


def _app_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starnorm-{spark.conf.get('spark.app.id')}"


def staging_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other caller gets."""
    return f"{_app_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query that runs in this block has shuffled is deleted when the query ends.

    Otherwise the files of every shuffle stay until the driver's garbage collector finds
    the query unused, which may be after the last step of a job: the disk holds the shuffles
    of all steps at once. For queries whose result is stored: a frame that is collected
    twice would shuffle twice. Blocks of several threads may overlap; the session has its
    own setting again when the last is left.
    """
    session = spark._jsparkSession.sessionUUID()
    with _FREEING_LOCK:
        blocks, before = _FREEING.get(session, (0, None))
        if not blocks:
            before = spark.conf.get(_FREE_SHUFFLES, "false")
            spark.conf.set(_FREE_SHUFFLES, "true")
        _FREEING[session] = blocks + 1, before
    try:
        yield
    finally:
        with _FREEING_LOCK:
            blocks, before = _FREEING.pop(session)
            if blocks > 1:
                _FREEING[session] = blocks - 1, before
            else:
                spark.conf.set(_FREE_SHUFFLES, before)


def write_staged(df: DataFrame, label: str = "table") -> str:
    """Write ``df`` as Parquet under the shared folder; returns its path."""
    path = staging_path(df.sparkSession, label)
    for paths in _SCRATCH.get()[-1:]:
        paths.append(path)
    with freed_shuffles(df.sparkSession):
        df.write.option("compression", COMPRESSION).parquet(path)
    return path


def staged(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    return df.sparkSession.read.schema(df.schema).parquet(write_staged(df, label))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged in this block, by threads in a copy of its context, too.

    Only results that do not read staged tables any more may leave the block.
    """
    paths: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            delete_tree(spark, path)


@contextmanager
def lasting() -> Iterator[None]:
    """What is staged in this block outlives the scratch work around it."""
    token = _SCRATCH.set(_SCRATCH.get()[:-1])
    try:
        yield
    finally:
        _SCRATCH.reset(token)


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables; frames built on them become unreadable."""
    delete_tree(spark, _app_folder(spark))
