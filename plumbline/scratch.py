"""Where intermediate tables are written: the folder the session names for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Paths given out in this driver, for ``drop_scratch``.
_GIVEN: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a folder beside the warehouse's tables.

    The folder must be one that all executors see. A session of one machine (``local``) may use any; on a
    cluster without ``spark.checkpoint.dir`` a warehouse that is a local folder is refused.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    scheme = place.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one written table."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _GIVEN.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Removes the tables that this driver wrote on the way; results must have been fetched or written."""
    gone = 0
    while _GIVEN:
        place = spark._jvm.org.apache.hadoop.fs.Path(_GIVEN.pop())
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        gone += bool(files.exists(place) and files.delete(place, True))
    return gone
