"""Session settings, the shared scratch folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build(app: str = "dayprints", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are planned for.

    Shuffle partitions are left to the cluster: AQE coalesces small ones and
    splits skewed join partitions, so the number only has to be large enough.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="dayprints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


_steps: list[str] = []  # paths handed out, so that jobs can delete their own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/dayprints/{name}-{uuid.uuid4().hex}"
    _steps.append(path)
    return path


@contextmanager
def own_steps(spark: SparkSession) -> Iterator[None]:
    """Deletes the steps written inside, once the job's result stands in its tables.

    Only for jobs that give no DataFrame away: what reads a step must be done with it. If the job
    fails, its steps stay, and the next run writes its own. Jobs of one driver process that run
    at the same time must not share this.
    """
    begin = len(_steps)
    yield
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in _steps[begin:]:
        at = hadoop.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    del _steps[begin:]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise as a table in the shared folder.

    Iterations then survive lost executors, and later steps read only the columns
    they need, with sizes that the optimiser knows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> DataFrame:
    """A small side of a join as a written table, so that its size is known.

    The optimiser then broadcasts it only if it is below its threshold, and joins
    by shuffle otherwise; the big side is not shuffled for nothing.
    """
    return cut_lineage(df)


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000) -> DataFrame:
    """Hint a broadcast only once the side is counted to be within ``max_rows``.

    Beyond it the side is returned as it is and the join shuffles. The count
    stops after ``max_rows + 1`` rows; use it for narrow lookup tables.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
