"""Session helpers: a tuned local session for tests/bench and the shared checkpoint folder.

On a cluster the session is built by the platform; ``ensure_checkpoint_dir`` only reads
``spark.checkpoint.dir`` there and sets a scratch folder when it is unset (local tests).
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces shuffle output at run time,
# skew join splits hot partitions, and partial aggregation stays on (map-side combine).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "riskspark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Where it is unset, a local session gets a scratch one (removed at exit);
    on a cluster that is an error, since a machine's own folder is not seen by the others."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        path = tempfile.mkdtemp(prefix="riskspark-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss; never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``riskspark`` importable in the Python workers (pandas UDFs and mapInPandas functions are
    pickled by module reference): zip the package once per application and ``addPyFile`` it, so
    executors on any machine fetch it from the driver."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix=f"riskspark-{os.getpid()}-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith((".py", ".sql")):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def shuffle_partitions(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        return 200
