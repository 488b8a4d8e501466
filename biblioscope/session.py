"""Session helpers: building a session, cutting lineage, reading tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the executors once, where Python workers cannot import it by themselves.

    Nothing is done where PYTHONPATH names its folder. The archive is served by the driver, not read from a folder."""
    sc = spark.sparkContext
    home = Path(__file__).resolve().parent
    if str(home.parent) in (os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p):
        return spark
    if getattr(sc, "_biblioscope_shipped", None) != sc.applicationId:
        archive = Path(tempfile.mkdtemp(prefix="biblioscope-code-")) / f"{home.name}.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(home.rglob("*.py")):
                z.write(f, f.relative_to(home.parent))
        sc.addPyFile(str(archive))
        sc._biblioscope_shipped = sc.applicationId
    return spark


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session."""
    return ship(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("biblioscope")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The shared folder for what is cut off its lineage or written between two steps: the one the cluster names in
    ``spark.checkpoint.dir``. Only a local session without one gets a folder of its process, which goes with it; a cluster
    without one is an error, as its machines do not share theirs."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        named = tempfile.mkdtemp(prefix="biblioscope-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder and cut its lineage. The copy survives the loss of executors."""
    scratch(ship(df.sparkSession))
    return df.checkpoint(eager=True)
