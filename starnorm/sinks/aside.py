"""A folder beside the table to be written, gone again whatever happens."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from starnorm.hadoop import delete_tree


@contextmanager
def written_aside(spark: SparkSession, target: str) -> Iterator[str]:
    """A path in the folder of ``target``, so that a rename moves no data.

    Its name is one that readers of the folder pass over, and no other writer gets it.
    """
    folder, _, name = target.rstrip("/").rpartition("/")
    path = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_tree(spark, path)
