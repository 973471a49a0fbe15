"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from urllib.parse import urlparse

import numpy as np
from pyspark.sql import DataFrame, GroupedData

from tidemark.session import scratch_path


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """Written once and read again, so that later steps neither repeat nor lose the work."""
    path = scratch_path(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


#: Arrays that a task keeps mapped; each holds a file open.
OPEN_ARRAYS = 64


def bucketed(rows: DataFrame, buckets: int, *keys: str) -> GroupedData:
    """``rows`` grouped by ``keys``, in a number of tasks that follows the number of buckets."""
    return rows.repartition(-(-buckets // 2), *keys).groupBy(*keys)


class Arrays:
    """Stored arrays, mapped when needed; the last used ones stay open."""

    def __init__(self, folder: str, limit: int = OPEN_ARRAYS) -> None:
        self.folder, self.limit = folder, limit
        self.open: OrderedDict[str, np.ndarray | None] = OrderedDict()

    def array(self, name: str) -> np.ndarray | None:
        """The array of this name, None where there is none.

        Its file is closed when it is no longer among the last used and the caller lets it go.
        """
        if name not in self.open:
            while len(self.open) >= self.limit:
                self.open.popitem(last=False)
            path = f"{self.folder}/{name}.npy"
            self.open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        self.open.move_to_end(name)
        return self.open[name]


def mounted(path: str) -> str:
    """``path`` as a plain file name, for arrays that workers map into memory.

    The shared folder must then be a mounted file system; object stores are refused.
    """
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: memory-mapped arrays need a mounted shared folder")
    return parts.path


def saved(folder: str, name: str, array: np.ndarray) -> None:
    """Written aside and renamed, so that a repeated task leaves one whole file."""
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(aside, "wb") as out:
        np.save(out, array)
    os.replace(aside, f"{folder}/{name}.npy")
