"""Writing an intermediate result once, where all executors can read it again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session.

    Only a local session without one, such as in tests, gets a temporary folder, which goes at its end: on a cluster other machines
    would not see it, so there the setting is asked for.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="logsonde-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, name: str, path: str | None = None, options: Mapping[str, int] | None = None) -> DataFrame:
    """`df` written as Parquet (with the writer's `options`) and read back: computed once, and safe if an executor is lost."""
    path = path or f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fix_row(df: DataFrame) -> DataFrame:
    """A one-row frame of statistics, computed now and kept as a literal row.

    Everything that uses it afterwards plans it as a constant instead of computing it again.
    """
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row of statistics, got {len(rows)}")
    return df.sparkSession.createDataFrame(rows, df.schema)
