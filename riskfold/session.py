"""Session helpers: local sessions for tests/bench and checkpoint handling."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "riskfold") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RISKFOLD_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; we read it
    from the session and never override it.  Only a bare local session (tests,
    bench) gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="riskfold-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession, always: bool = False) -> None:
    """Send this package to the workers, once a session, where their Python would not find it.

    Workers find it by themselves if its folder is on PYTHONPATH, or is the working folder of a local session;
    ``always`` sends it in any case.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    listed = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if not always and (root in listed or (sc.master.startswith("local") and os.getcwd() == root)):
        return
    if getattr(sc, "_riskfold_shipped", False):
        return
    name = os.path.join(tempfile.mkdtemp(prefix="riskfold-package-"), "riskfold_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(os.path.dirname(os.path.abspath(__file__))):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), root))
    sc.addPyFile(name)
    sc._riskfold_shipped = True


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` (the files are shared and survive a
    lost executor), but stays columnar: later readers scan the columns they use.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
