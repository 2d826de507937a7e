"""Session helpers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "5000")  # candidate_edges ranks up to 2001 rows
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_library(spark)
    return spark


def ship_library(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, whatever their path; once per application."""
    context = spark.sparkContext
    if getattr(context, "_wavetide_shipped", None) == context.applicationId:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="wavetide-")) / "wavetide_library.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(target))
    context._wavetide_shipped = context.applicationId


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, so that lost executors cost no recomputation.

    The folder is the one in ``spark.checkpoint.dir``. Where none is set, a temporary one is used if the session runs in one
    local process (tests); on a cluster that is an error, as executors could not read one another's files.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wavetide-"))
    return df.checkpoint(eager=True)
