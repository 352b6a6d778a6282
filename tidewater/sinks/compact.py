"""SNK8: merge small files, and cluster rows by chosen columns.

Three jobs, with Delta's ``OPTIMIZE`` and ``OPTIMIZE .. ZORDER BY`` in their
place where Delta is present:

- ``compact_table`` rewrites a table clustered by columns, in linear order or
  along a Z-order curve: every column is cut into ranges of about equal rows, and
  the bits of the range numbers are interleaved to one key, so a filter on any
  one of the columns leaves few files. Linear order serves filters on the first
  column only.
- ``merge_small_files`` leaves large files alone and packs the small ones of each
  folder first-fit-decreasing into bins of at most the target size. A bin is one
  file, or, above TASK_BYTES, one for each task that sorts a range of it.
- ``compact_bronze`` does the same over the folders of Bronze's micro-batches,
  and merges their metrics.

Range keys end with ``split_by`` columns (by default the event time and id where
present): a hot clustering value, say one user with a third of the rows, spreads
over many range partitions instead of one task.
"""

from __future__ import annotations

import math
import uuid
from typing import Iterable, List, Optional, Sequence, Tuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BRONZE_TABLE, LakeConfig
from ..session import ship_package
from .storage import latest_path, path_size, read_path, write_table
from .swap import list_names, recover, swap

TARGET_FILE_BYTES = 256 * 1024 * 1024
DEFAULT_SPLIT_BY = ("event_timestamp", "event_id")
#: Stored bytes that one task lays out: rows in memory are about ten times as large. More are cut along the order.
TASK_BYTES = 64 * 1024 * 1024
#: Rows whose values set the borders of a column's ranges. They shape the layout only; every row is written.
BORDER_ROWS = 20_000
#: Bits of a column's range number at most: 1,024 ranges.
MAX_BITS = 10


# ---------------------------------------------------------------------------
# Z-order
# ---------------------------------------------------------------------------


def range_borders(df: DataFrame, columns: Sequence[str], bits: int) -> List[list]:
    """For each column 2**bits - 1 ascending borders, quantiles of BORDER_ROWS rows chosen by a hash."""
    rows = df.select(*columns).orderBy(F.xxhash64(*columns, F.monotonically_increasing_id())).limit(BORDER_ROWS).collect()
    out = []
    for i in range(len(columns)):
        values = sorted(r[i] for r in rows if r[i] is not None)
        n = 1 << bits
        out.append([values[min(len(values) - 1, len(values) * j // n)] for j in range(1, n)] if values else [])
    return out


def zorder_key(df: DataFrame, columns: Sequence[str], bits: int, name: str = "_z") -> DataFrame:
    """``df`` with the Morton key of ``columns``: the bits of their range numbers, interleaved.

    A value's range number is found by binary search over the borders, one
    projection for each bit; NULL is in range 0.
    """
    places = [f"{name}{i}" for i in range(len(columns))]
    for column, place, borders in zip(columns, places, range_borders(df, columns, bits)):
        df = df.withColumn(place, F.lit(0))
        if not borders:
            continue
        known = F.array(*[F.lit(b) for b in borders])
        for j in range(bits - 1, -1, -1):
            beyond = F.col(column) >= F.element_at(known, F.col(place) + (1 << j))
            df = df.withColumn(place, F.col(place) + F.when(beyond, 1 << j).otherwise(0))
    key: Column = F.lit(0).cast("long")
    for j in range(bits):
        for i, place in enumerate(places):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(F.col(place).cast("long"), j).bitwiseAND(F.lit(1)), j * len(columns) + i))
    return df.withColumn(name, key).drop(*places)


def compact_table(
    spark: SparkSession,
    cfg: LakeConfig,
    table_path: str,
    cluster_by: Sequence[str],
    target_files: Optional[int] = None,
    partition_by: Sequence[str] = (),
    split_by: Optional[Sequence[str]] = None,
    order: str = "linear",
) -> str:
    """Rewrite a table as about ``target_files`` files clustered by
    ``cluster_by`` (``order`` linear or zorder); returns the new version path. Rows are unchanged.

    A file is what one task sorts, so there are more files where a share would be above TASK_BYTES.
    """
    if order not in ("linear", "zorder"):
        raise ValueError(f"order must be linear or zorder, not {order}")
    if cfg.table_format == "delta":
        # Delta doesn't take partition columns here: their folders separate them already.
        cols = ", ".join(c for c in cluster_by if c not in partition_by)
        spark.sql(f"OPTIMIZE delta.`{table_path}` ZORDER BY ({cols})")
        return table_path
    df = read_path(spark, cfg, table_path)
    columns = df.columns
    size = path_size(spark, latest_path(spark, table_path))
    target_files = max(target_files or math.ceil(size / TARGET_FILE_BYTES), math.ceil(size / TASK_BYTES), 1)
    if split_by is None:
        split_by = [c for c in DEFAULT_SPLIT_BY if c in columns]
    inner = [c for c in cluster_by if c not in partition_by]
    if order == "zorder" and len(inner) > 1:
        # Four ranges for each file's share of a column, so that files end near borders.
        bits = min(MAX_BITS, max(2, math.ceil(math.log2(max(2, target_files)) / len(inner)) + 2))
        df, inner = zorder_key(df, inner, bits), ["_z"]
    # Partition columns lead the range key so each task covers few directories.
    keys = list(dict.fromkeys([*partition_by, *inner, *split_by]))
    laid_out = df.repartitionByRange(int(target_files), *keys).sortWithinPartitions(*keys).select(*columns)
    return write_table(laid_out, cfg, table_path, partition_by=partition_by)


# The clustering the lake documents for its two most-read tables (fixed values). Silver's
# event_date is a folder already, so within a date only the user is left to order by.
DEFAULT_CLUSTERING = {
    ("silver", "user_events"): {"cluster_by": ("user_id", "event_date"), "partition_by": ("event_date",)},
    ("gold", "user_session_summary"): {"cluster_by": ("country_code", "device_type"), "partition_by": (), "order": "zorder"},
}


def compact_lake(spark: SparkSession, cfg: LakeConfig, target_files: Optional[int] = None) -> dict:
    """SNK8 for the lake: Silver by (user_id, event_date), the session Gold
    table by (country_code, device_type). Returns table -> new version path."""
    return {
        f"{layer}.{name}": compact_table(spark, cfg, cfg.path(layer, name), target_files=target_files, **spec)
        for (layer, name), spec in DEFAULT_CLUSTERING.items()
    }


# ---------------------------------------------------------------------------
# Bin packing
# ---------------------------------------------------------------------------


def first_fit_decreasing(sizes: Sequence[int], capacity: int) -> List[int]:
    """Bin of each size: from the largest down, each goes to the first bin with room.

    The bins' free room is kept in a tree of maxima, so n sizes take n log n steps.
    No two of the bins would fit into one.
    """
    n = max(1, len(sizes))
    leaves = 1 << (n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = 1
        while at < leaves:
            at = 2 * at if room[2 * at] >= sizes[i] else 2 * at + 1
        out[i] = at - leaves
        room[at] -= sizes[i]
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return out


#: Name of the files that packing has written: such files are not packed with each other again.
PACKED = "packed-"


def plan_bins(files: DataFrame, capacity: int) -> DataFrame:
    """(folder, file, size, bin) of the files to rewrite, from (folder, file, size) of small files.

    Each folder's files are packed in a task of their own. A bin of one file, or
    of packed files only, stays as it is.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("file").reset_index(drop=True)
        bins = pd.Series(first_fit_decreasing(group["size"].tolist(), capacity), name="bin")
        fresh = ~group["file"].str.rsplit("/", n=1).str[-1].str.startswith(PACKED)
        worth = (bins.groupby(bins).transform("size") > 1) & fresh.groupby(bins).transform("any")
        return group.assign(bin=bins)[worth]

    ship_package(files.sparkSession)
    return files.groupBy("folder").applyInPandas(pack, "folder string, file string, size long, bin int")


def _pack_files(spark: SparkSession, root: str, df: DataFrame, folder: Column, into, target_bytes: int, sort_by: Sequence[str], drop: Sequence[str]) -> Tuple[List[str], List[Tuple[str, str]], str]:
    """Writes the packed files of the table at ``root`` to a staging folder.

    ``folder`` says which files may be packed together, ``into(files)`` in which
    folder the result belongs. Returns (files to delete, (staged, name) to add,
    staging folder), all below ``root``.
    """
    tail = f"/{root.rstrip('/').rsplit('/', 1)[-1]}/"
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # a URI
    rows = df.select("*", F.substring_index(path, tail, -1).alias("_file"), F.col("_metadata.file_size").alias("_size"))
    # The condition on the size prunes large files before anything is read.
    rows = rows.filter(F.col("_metadata.file_size") < target_bytes)
    found = rows.select("_file", "_size").distinct().select(folder.alias("folder"), F.col("_file").alias("file"), F.col("_size").alias("size"))
    plan = plan_bins(found, target_bytes).collect()  # one row for each file, as in any listing
    bins: dict = {}
    filled: dict = {}
    for r in plan:
        bins.setdefault((r["folder"], r["bin"]), []).append(r["file"])
        filled[r["folder"], r["bin"]] = filled.get((r["folder"], r["bin"]), 0) + r["size"]
    if not bins:
        return [], [], ""
    staging = f"_staging-{uuid.uuid4().hex}"
    number = {f: i for i, files in enumerate(bins.values()) for f in files}
    assigned = spark.createDataFrame(list(number.items()), "_file string, _bin int")
    out = rows.join(assigned, "_file").drop("_file", "_size", *drop)
    if max(filled.values()) <= TASK_BYTES:  # whole bins, of about as many rows in each task
        out = out.repartitionByRange(len(bins), "_bin").sortWithinPartitions("_bin", *sort_by)
    else:  # a large bin is written by several tasks, as a file of each
        keys = list(dict.fromkeys(["_bin", *sort_by, *(c for c in DEFAULT_SPLIT_BY if c in out.columns)]))
        out = out.repartitionByRange(math.ceil(sum(filled.values()) / TASK_BYTES), *keys).sortWithinPartitions(*keys)
    out.write.mode("errorifexists").partitionBy("_bin").parquet(f"{root}/{staging}")
    delete, add, run = [], [], uuid.uuid4().hex[:8]
    for i, files in enumerate(bins.values()):
        for part in list_names(spark, f"{root}/{staging}/_bin={i}"):
            if part.endswith(".parquet"):
                place = into(files)
                add.append((f"{staging}/_bin={i}/{part}", f"{place + '/' if place else ''}{PACKED}{run}-{i}-{part}"))
        delete += files
    return delete, add, staging


def merge_small_files(
    spark: SparkSession, cfg: LakeConfig, table_path: str, target_bytes: int = TARGET_FILE_BYTES, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()
) -> int:
    """Packs the files below ``target_bytes`` of each folder; returns how many files went.

    Files at or above the target are neither read nor moved. Readers see the old
    files or the new ones (``sinks.swap``).
    """
    if cfg.table_format == "delta":
        spark.sql(f"OPTIMIZE delta.`{table_path}`")
        return 0
    root = latest_path(spark, table_path)
    df = read_path(spark, cfg, table_path)
    parent = F.when(F.instr("_file", "/") > 0, F.regexp_replace("_file", "/[^/]*$", "")).otherwise("")
    delete, add, staging = _pack_files(spark, root, df, parent, lambda files: files[0].rpartition("/")[0], target_bytes, sort_by, partition_by)
    if delete:
        swap(spark, root, delete, add, staging)
    return len(delete)


def compact_bronze(spark: SparkSession, cfg: LakeConfig, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Packs the small files of Bronze's micro-batches and merges the batches' metrics; files gone.

    A stream can replay its last batch, which is found by its folder: the last
    batch of each stream stays as it is. A packed file goes to the folder of its
    latest batch, so a reader of batches beyond that one skips it.
    """
    from ..sources.tables import read_bronze_batches
    from ..streaming.bronze import METRICS_FOLDER, stored_metrics

    root = cfg.path("bronze", BRONZE_TABLE)
    if cfg.table_format == "delta":
        spark.sql(f"OPTIMIZE delta.`{root}`")
        return 0
    recover(spark, root)
    folders = {q: sorted(int(b.split("=")[1]) for b in list_names(spark, f"{root}/{q}") if b.startswith("batch=")) for q in list_names(spark, root) if q.startswith("query=")}
    last = {q.split("=")[1]: b[-1] for q, b in folders.items() if b}
    older = F.lit(False)
    for q, b in last.items():
        older = older | ((F.col("query") == q) & (F.col("batch") < b))
    df = read_bronze_batches(spark, cfg).filter(older)

    def into(files: Iterable[str]) -> str:
        return max((f.rpartition("/")[0] for f in files), key=lambda f: int(f.rsplit("batch=", 1)[1]))

    delete, add, staging = _pack_files(spark, root, df, F.substring_index("_file", "/", 1), into, target_bytes, ("kafka_partition", "kafka_offset"), ("query", "batch"))
    if not delete:
        return 0
    kept = {name.rpartition("/")[0] for _, name in add}
    gone = []
    for q, batches in folders.items():
        old = [f"{q}/batch={b}" for b in batches[:-1]]
        if not old:
            continue
        # The stream's metrics, up to its last batch, in one file.
        home = max((f for f in kept if f.startswith(f"{q}/")), key=lambda f: int(f.rsplit("=", 1)[1]), default=None)
        if home is None:
            continue
        metrics = stored_metrics(spark, root).filter((F.col("query") == q.split("=")[1]) & (F.col("batch") < batches[-1]))
        place = f"{staging}/_metrics-{q.split('=')[1]}"
        metrics.coalesce(1).write.parquet(f"{root}/{place}")
        add.append((place, f"{home}/{METRICS_FOLDER}"))
        for f in old:
            left = {f"{f}/{n}" for n in list_names(spark, f"{root}/{f}") if n.endswith(".parquet")} - set(delete)
            if left or f in kept:
                gone += [f"{f}/{METRICS_FOLDER}"] if f != home else []
            else:
                gone.append(f)  # nothing but its metrics is left of this batch
    swap(spark, root, [*delete, *gone], add, staging)
    return len(delete)
