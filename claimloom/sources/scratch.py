"""The shared folder for tables that one job writes and another reads back."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """One fresh folder per application, under the folder the cluster names.

    Without that setting a local session gets a temporary folder. A cluster does not: its
    executors could not see each other's files, so that is an error instead of a wrong result.
    """
    app = spark.conf.get("spark.app.id", "session")
    if app not in _roots:
        shared = spark.conf.get(_SETTING, None)
        if shared is None:
            if not spark.conf.get("spark.master", "local").startswith("local"):
                raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")
            shared = tempfile.mkdtemp(prefix="claimloom-")
            warnings.warn(f"{_SETTING} is not set: intermediate tables go to {shared}, which only this machine can read", stacklevel=2)
        _roots[app] = f"{shared.rstrip('/')}/claimloom-{uuid.uuid4().hex}"
    return _roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, so nothing is ever overwritten or read half-written."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's own folder; frames that read its tables are of no use afterwards."""
    root = _roots.pop(spark.conf.get("spark.app.id", "session"), None)
    if root is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
