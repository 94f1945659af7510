"""Session defaults and the shared scratch store used to cut lineage."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Most rows and bytes that an executor hands to a Python worker at once: both hold several copies of a batch.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2048, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
#: Most bytes of a result that ``gathered`` deals out, and bytes of each of its files.
FEW_BYTES, FILE_BYTES = 32 << 20, 4 << 20

#: Seconds at least between two collections of the driver's garbage.
SWEEP_S = 5

_FALLBACK: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []
_SHIPPED: set[str] = set()
_SWEPT: dict[str, float] = {}


def build_session(app: str = "kymo", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH``; smaller settings stay."""
    for key, most in BATCH.items():
        value = spark.conf.get(key, None)
        if value is None or not value.isdigit() or not 0 < int(value) <= most:
            spark.conf.set(key, most)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application; they may not have it installed."""
    small_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="kymo-ship-")) / "kymo.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder, in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="kymo-scratch-")
    return _FALLBACK[app]


def fresh_folder(spark: SparkSession, tag: str) -> str:
    """A path in the shared scratch store that nothing has used; ``release_scratch`` deletes what is there."""
    path = f"{scratch_root(spark)}/kymo-{uuid.uuid4().hex}/{tag}"
    _WRITTEN.append((spark, path))
    return path


def sweep(spark: SparkSession) -> None:
    """Collect the driver's garbage, if that was not just done.

    Plans that ended keep their broadcasts in the driver until then, and the
    heap grows around them; a full collection also gives memory back.
    """
    app = spark.sparkContext.applicationId
    if time.monotonic() - _SWEPT.get(app, -SWEEP_S) >= SWEEP_S:
        gc.collect()  # else plans stay that Python objects name
        spark.sparkContext._jvm.System.gc()
        _SWEPT[app] = time.monotonic()


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch store and read it back.

    The result has no lineage to recompute when an executor is lost, and its
    file sizes give the planner true statistics for later joins.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, tag)
    df.write.parquet(path)
    sweep(spark)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, width: int = 64) -> DataFrame:
    """``df``, of at most ``rows`` rows of some ``width`` bytes, dealt to few tasks before it is written, if that is little.

    Every file on a local disk costs its executor two processes (``chmod``), which
    share all of the JVM's memory while they start.  The work before stays where it
    is; what is larger than ``FEW_BYTES`` is left alone.
    """
    size = rows * width
    return df.repartition(1 + (rows > 1000) + size // FILE_BYTES) if size <= FEW_BYTES else df


def release_scratch() -> None:
    """Delete what ``cut`` wrote; safe only when no plan reads it any more."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm = spark.sparkContext._jvm
            hadoop_path = jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
        except Exception:  # the session may be gone at interpreter exit
            return


atexit.register(release_scratch)
