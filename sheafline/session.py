"""Session helpers: local sessions for tests, table access and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()


def local_session(cpus: int | str = 8, memory: str = "8g", app: str = "sheafline") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of a session, once: they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    # the driver serves the file to the workers; it needs no shared folder
    archive = Path(tempfile.mkdtemp(prefix="sheafline-code-")) / "sheafline_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f.relative_to(home.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``root`` (a file or a folder of part files)."""
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it lies in fewer pieces than there are cores, whatever its size.

    For stages that compute much on each row (regular expressions, pandas functions).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(cores) if pieces < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only where the setting is absent and everything runs on one machine (tests) a temporary folder is made; it is
    remembered by the session, so one session uses one folder. A cluster without the setting is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="sheafline-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def table_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan, in bytes; used to decide on broadcasts."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def env_cpus(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
