"""Session helpers: defaults for tests and benches, shipping the package to Python workers, tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
#: Used only by sessions on one machine that name no checkpoint folder (tests).
LOCAL_SHARED = "/tmp/foliant-shared"


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foliant")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers; only workers of this machine may have it from the driver's PYTHONPATH."""
    sc = spark.sparkContext
    paths = [os.path.realpath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    at_hand = sc.master.startswith("local") and str(ROOT) in paths
    if not at_hand and sc.applicationId not in _shipped:
        where = Path(tempfile.mkdtemp()) / "foliant.zip"
        with zipfile.ZipFile(where, "w") as z:
            for p in sorted((ROOT / "foliant").rglob("*.py")):
                z.write(p, p.relative_to(ROOT))
        sc.addPyFile(str(where))
        _shipped.add(sc.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset a local one on a single machine, else one in the warehouse."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_dir.isDefined():
            return set_dir.get()
        local = spark.sparkContext.master.startswith("local")
        where = LOCAL_SHARED if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/foliant-shared"
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/foliant/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and read it back.

    A lost executor costs only the tasks it ran; readers of the table never recompute ``df``.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._foliant_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    path = getattr(df, "_foliant_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        conf = df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        where.getFileSystem(conf).delete(where, True)
