"""PL5: one SparkSession builder for every job, no hard-coded master.

The reference pins ``local[*]`` in every job and leaves the session time zone
to the host. Here the master comes from spark-submit (or the caller), the time
zone is UTC (S4), and shuffle width is a parameter sized for the data.
"""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import zipfile
from contextlib import contextmanager
from pathlib import Path
from typing import Iterator, Mapping, Optional

from pyspark.sql import SparkSession

# Defaults chosen for scale: AQE re-plans shuffle width and splits skewed
# partitions at runtime; the session zone is pinned so that event_date and
# event_hour do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Remove reliable checkpoints (hot-key slices, audit input) once unused.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Settings that a table format needs before the session starts (Delta's public class names).
FORMAT_CONF = {
    "parquet": {},
    "delta": {
        "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
        "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
    },
}


def build_session(
    app_name: str = "tidewater",
    master: Optional[str] = None,
    shuffle_partitions: Optional[int] = None,
    conf: Optional[Mapping[str, str]] = None,
    checkpoint_dir: Optional[str] = None,
    table_format: str = "parquet",
) -> SparkSession:
    """Create or reuse a session.

    ``master`` is only set when given (tests, bench); under spark-submit the
    cluster manager decides. ``shuffle_partitions`` should be sized so that one
    shuffle partition is ~128-256 MB at the target scale (200 on the reference
    cluster, thousands at 100 TB; AQE coalesces small ones). ``checkpoint_dir``
    is used where ``spark.checkpoint.dir`` is unset. ``table_format="delta"``
    adds Delta's extension and catalog; its jars come from spark-submit.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **FORMAT_CONF[table_format]}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # getOrCreate may return an existing session: re-apply the SQL settings.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint_dir or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark, checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: Optional[str] = None) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. A folder of the caller's
    (``fallback``: tests, bench, the driver's entry in local mode) is used only
    where none is configured; without either this raises, so no job writes to
    a folder that other machines can't see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if target is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers of any cluster, once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewater_package", False):
        return
    root = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="tidewater-package-")).resolve()  # code, on the driver; Spark hands it out
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = folder / "tidewater_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tidewater_package = True


# Input bytes per shuffle partition when a job sizes its own shuffle width
# (AQE coalesces what turns out small).
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 ** 2


@contextmanager
def shuffle_width(spark: SparkSession, input_bytes: Optional[int]) -> Iterator[int]:
    """Run a job with enough shuffle partitions for ``input_bytes``.

    Sets ``spark.sql.shuffle.partitions`` to ceil(input / 256 MB), never below
    the session's value, and restores it afterwards.
    AQE then coalesces partitions that come out small, so the width is an
    upper bound that keeps each reduce task within executor memory at any
    input size (100 TB of input asks for about 400,000 partitions).
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    width = int(before)
    if input_bytes:
        width = max(width, math.ceil(input_bytes / BYTES_PER_SHUFFLE_PARTITION))
    spark.conf.set(key, str(width))
    try:
        yield width
    finally:
        spark.conf.set(key, before)
