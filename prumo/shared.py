"""The folder that the driver and all executors share, for tables that one query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset and all runs on this machine (tests, benches), below a temporary folder
    that is removed at exit; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="prumo-")
            atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
        base = _LOCAL[app]
    return f"{base.rstrip('/')}/prumo-{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back, for what several parts of a plan read; survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that one task takes of tables dealt out by their number of rows.
ROWS_A_TASK = 500_000


def spread(df: DataFrame, *keys: str, rows: int = 0) -> DataFrame:
    """df dealt out by keys over spark.sql.shuffle.partitions tasks, or one for each ROWS_A_TASK of `rows` if these are more, for work in
    Python on rows that take little room: by their bytes Spark would put very many of them into one task. A later grouping by the
    same keys needs no other shuffle."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_TASK))
    return df.repartition(tasks, *keys)
