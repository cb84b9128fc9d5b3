"""Session helpers: a local session for tests and tables written to the shared folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may go to every executor (some 60 to 100 bytes each).
SENT_ROWS = 2_000_000
#: Paths of the tables that this driver has written.
_WRITTEN: list[str] = []


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").appName("scquarry").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    guard(spark)
    return spark


def guard(spark: SparkSession) -> None:
    """Send the package to the executors and keep unions from claiming a partitioning.

    Spark 4.1 takes a union of equally partitioned inputs as partitioned likewise; with adaptive execution that can leave the
    groups of a later aggregation in two parts. Without the claim there is one more exchange in such plans, and right counts.
    The setting holds for the whole session from then on, because results are lazy: plans made here run at any later time.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    ship(spark)


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per context: their Python workers need it, wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_scquarry", False):
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="scquarry-")  # the driver serves it to the executors as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = Path(folder) / "scquarry.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._scquarry = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Only a local session, whose executors are threads of the driver, gets a folder of its own where that is unset; it goes with
    the process. On a cluster an unset folder is an error: executors would not see what the driver's machine has.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="scquarry-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        named = "file://" + folder
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    This cuts the lineage and survives the loss of executors. The table stays until discard(), since lazy results may read it at
    any later time. A table that materialize() gave is returned as it is. The shuffle files of what was written are of no use
    then; Spark deletes them once the driver's JVM collects its garbage, which is asked for here, since it seldom would by itself.
    """
    if getattr(df, "_scquarry_written", False):
        return df
    spark = df.sparkSession
    guard(spark)
    path = f"{shared_dir(spark)}/scquarry-{name}-{os.getpid()}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._scquarry_written = True
    return out


def sent_if_small(df: DataFrame, rows: int = SENT_ROWS) -> DataFrame:
    """df, to be sent to every executor where it has so many rows or fewer; joins with larger tables stay as they are."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def discard(spark: SparkSession) -> int:
    """Delete the tables that this driver has written to the shared folder, once no result reads them any more; their number."""
    jvm, done = spark.sparkContext._jvm, 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return done


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the project's tables, by name."""
    guard(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
