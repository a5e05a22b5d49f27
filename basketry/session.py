"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import contextlib
import io
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins from real shuffle sizes and
# splits skewed join partitions; both are on by default in Spark 4 but are set
# explicitly so a cluster profile that turned them off is corrected.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


MB = 1 << 20


MAX_SHUFFLE_PARTITIONS = 100_000


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * MB) -> dict:
    """Shuffle and scan sizing for an input of ``input_bytes``.

    Scans split files into ``target_partition_bytes`` pieces. Shuffled data is
    much smaller than the input (pruned columns, partial aggregates), so the
    initial shuffle width gives each reducer about 1 GB of *input* (between 200
    and 100k partitions); AQE coalesces small reducers and splits skewed ones
    at run time, so the width only has to be large enough, never exact. For
    100 TB this starts shuffles at 100k partitions.
    """
    width = int(min(MAX_SHUFFLE_PARTITIONS, max(200, input_bytes // (1024 * MB))))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(width),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "basketry", extra: dict | None = None,
                  driver_memory: str = "16g", input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied.

    ``driver_memory`` only matters in local mode, where the driver JVM is the
    whole engine; on a cluster it is set by the submit configuration.
    ``input_bytes`` (total size of the order-line input) sizes scans and
    shuffles through :func:`scale_conf`.
    """
    if input_bytes:
        extra = {**scale_conf(input_bytes), **(extra or {})}
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names this folder. Only a ``local`` session (one machine, as in
    tests) may go without: it gets a temporary folder. Anywhere else a missing
    setting is an error, because a machine-local folder would hold only the part
    files of one executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "basketry", name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers once per application.

    A zip in the shared folder is given to Spark's own file distribution
    (``addPyFile``), so the workers import the package wherever it is installed or
    not. Needed by operators that run Python in tasks.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = scratch_path(spark, f"code-{uuid.uuid4().hex}/basketry_code.zip")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_keepers: list[list[str]] = []


@contextlib.contextmanager
def written_paths():
    """Collects the folders that :func:`materialize` writes inside the block, so their owner can remove them later."""
    paths: list[str] = []
    _keepers.append(paths)
    try:
        yield paths
    finally:
        _keepers.pop()


def materialize(df, name: str):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Used where one large intermediate feeds several branches: the branches then
    scan a pruned columnar table instead of re-running (or re-planning) the
    joins and windows behind it, and the lineage is cut, so a lost executor
    costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if _keepers:
        _keepers[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
