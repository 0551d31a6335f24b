"""Shared scratch tables, and code for the Python workers.

Lineage is cut by writing a Parquet table under the folder that the cluster
names in ``spark.checkpoint.dir``: a lost executor then costs only the tasks
of the step that runs, and the table is read again as often as needed.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package also where only the driver has
    its folder on the path (a session started elsewhere on machines that see
    that folder). On a cluster the package must be installed on the executors,
    or shipped with ``--py-files`` as a zip of this folder's ``daypulse``."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; in plain local mode with none
    set, a fresh temporary folder, made known as the checkpoint folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="daypulse-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/daypulse-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the first of name_2, name_3, ... that no column of ``df``
    has (whatever the case)."""
    taken, n, found = {c.lower() for c in df.columns}, 1, name
    while found.lower() in taken:
        n += 1
        found = f"{name}_{n}"
    return found


def row_hash(df: DataFrame, seed: int = 0):
    """64 bits over all columns of a row (nulls included); tells rows with
    the same id apart. Columns without an order or hash (maps) count as text."""
    cols = [F.col(f"`{n}`").cast("string") if t.startswith(("map", "struct", "array", "variant")) else F.col(f"`{n}`")
            for n, t in df.dtypes]
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (c.isNull(), c)])
