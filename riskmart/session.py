"""Session settings and the shared scratch area of the cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# What the operators count on: joins whose key holds a large part of the rows are split at run time,
# also where that costs a further exchange (several joins in a row on one key).
JOIN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# What the mart needs besides, so that a build keeps little on disk: the shuffle files of a query go when it ends, not when
# the driver happens to collect its garbage, and tables are written with the stronger codec.
MART_SETTINGS = {
    **JOIN_SETTINGS,
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

_unset_dirs: dict[str, str] = {}


def tune(spark: SparkSession, settings: Mapping[str, str] = JOIN_SETTINGS) -> SparkSession:
    """Apply settings where neither the cluster's configuration nor the session names them."""
    given, own = spark.sparkContext.getConf(), spark.conf.getAll
    for key, value in settings.items():
        if not given.contains(key) and key not in own:
            spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()
_shipping = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application: they need not have it installed.

    Tables are built side by side, and Spark refuses a second file of the same name, so one thread ships and the others
    wait for it."""
    context = spark.sparkContext
    with _shipping:
        if context.applicationId in _shipped:
            return
        folder, package = tempfile.mkdtemp(prefix="riskmart-"), Path(__file__).parent  # Spark fetches it from the driver
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder) / "riskmart.zip"
        with zipfile.ZipFile(path, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Without either a temporary folder serves a local master, whose one process sees it, until that
    process ends. On several machines that folder would differ from one to the next, so there it is
    an error.
    """
    context = spark.sparkContext
    configured = (context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
                  or context.getCheckpointDir())
    if configured:
        return configured.rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = context.applicationId
    if app not in _unset_dirs:
        _unset_dirs[app] = tempfile.mkdtemp(prefix="riskmart-")
        atexit.register(shutil.rmtree, _unset_dirs[app], ignore_errors=True)
    return _unset_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/riskmart/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Cuts the lineage so that a lost executor costs a re-read only, computes the table once for all
    its uses, and gives the planner its true size: a join broadcasts it if and only if it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    path = new_path(df.sparkSession, label)
    for held in _scratch:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scratch: list[list[str]] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` in this block are removed at its end; what is to stay is written elsewhere before."""
    own: list[str] = []
    _scratch.append(own)
    try:
        yield
    finally:
        _scratch.remove(own)
        for path in own:
            remove(spark, path)
