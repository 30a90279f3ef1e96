"""Session helpers: a local session for tests and tools, and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import sys
import tempfile
import time
import zipfile
from pathlib import Path

from py4j.clientserver import DEFAULT_WORKER_SLEEP_TIME
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "agorasift", **conf: str) -> SparkSession:
    """A local session as the tests and the bench use it; a cluster brings its own session."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the one the session names, a temporary one only if none is named.

    A cluster sets ``spark.checkpoint.dir`` to a folder that all executors share; without it only a
    local session works, whose temporary folder goes when Python ends.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="agorasift-checkpoint-")
        atexit.register(shutil.rmtree, named, True)
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint, which survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the shuffle files go that nothing refers to any more, as those before a :func:`cut`.

    Spark removes them when the driver's JVM collects its garbage; until then they count as disk.
    """
    gc.collect()
    time.sleep(1.2 * DEFAULT_WORKER_SLEEP_TIME)  # py4j passes on what Python let go so often
    spark.sparkContext._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this session, unless they surely find it by themselves.

    A local session started beside the package, or with it on PYTHONPATH, needs nothing.
    """
    sc, package = spark.sparkContext, Path(__file__).parent
    root = str(package.parent)
    paths = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if getattr(sc, "_agorasift_shipped", False) or (sc.master.startswith("local[") and (os.getcwd() == root or root in paths)):
        return
    folder = tempfile.mkdtemp(prefix="agorasift-package-")  # read by the driver, which serves it to the executors
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(os.path.join(folder, "agorasift.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    here = list(sys.path)
    sc.addPyFile(os.path.join(folder, "agorasift.zip"))
    sys.path[:] = here  # the driver keeps using the files themselves
    sc._agorasift_shipped = True
