"""Where queries put files that they read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for a new folder in the one that ``spark.checkpoint.dir`` names; in local mode, where that is unset, in a
    temporary one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN.setdefault(app, "file://" + (tempfile.mkdtemp(prefix="freshet-") if app not in _OWN else ""))
    return f"{base.rstrip('/')}/freshet/{name}-{uuid.uuid4().hex}"


def on_disk(path: str) -> str:
    """The path of a ``file://`` URL for formats that are one file on a disk, which all machines then have to mount."""
    if not path.startswith("file:") and "://" in path:
        raise ValueError(f"{path} is not on a file system")
    return "/" + path.removeprefix("file:").lstrip("/")
