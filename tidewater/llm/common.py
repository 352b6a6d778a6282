"""Helpers shared by the operators: input normalisation, tables in the shared
folder, contract columns and a bounded cache for Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path
from typing import Callable, Iterable, Iterator, List, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sinks.storage import filesystem

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Whitespace of the word definitions: space, tab, LF, VT, FF, CR.
ASCII_SPACE = "[\\x20\\x09-\\x0D]+"


#: Rows of an Arrow batch: 2,000 texts of 100 KB are 200 MB, 2,000 usual ones a few MB.
ROWS_PER_BATCH = 2_000


def ship(spark: SparkSession) -> None:
    """Makes the package importable in the Python workers of any cluster, once per context,
    and bounds the rows that one Arrow batch of whole texts may hold."""
    sc = spark.sparkContext
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    if getattr(sc, "_tidewater_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    folder = Path(tempfile.mkdtemp(prefix="tidewater-code-")).resolve()  # on the driver; Spark hands the copy out
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = folder / "tidewater.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tidewater_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only, so other columns never clash with an operator's own;
    a null text becomes the empty text."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path under the folder that the cluster names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def saved(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the
    lineage, survives lost executors, and pins non-deterministic columns."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table of the shared folder that nothing reads any more."""
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def fold_of(id_col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as fold 1 (used for learning, never held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod, F.lit(1))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def partition_bases(counts: DataFrame, part: str, n: str) -> DataFrame:
    """(part, base): running total of ``n`` over partitions in order of ``part``.

    One row per Spark partition reaches the driver, however many rows each holds.
    """
    rows = sorted((r[0], r[1]) for r in counts.select(part, n).collect())
    out: List[tuple] = []
    base = 0
    for p, k in rows:
        out.append((p, base))
        base += k
    return counts.sparkSession.createDataFrame(out, f"{part} int, base long")


def without(docs: DataFrame, gone: DataFrame, rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows whose (id, text) is in ``gone`` (doc_id, row_hash), and each (id, text) once.

    ``rows`` has the (doc_id, row_hash) of all rows that stay: only where it holds
    one twice, which ids that name documents never do, are whole rows compared
    (collapsed in the map tasks first, however often a row is repeated).
    """
    own = docs.withColumns({"_row_hash": row_hash(F.coalesce(F.col(text_col), F.lit(""))), "_row_id": F.col(id_col).cast("long")})
    if not rows.groupBy("doc_id", "row_hash").count().filter("count > 1").isEmpty():
        own = own.dropDuplicates(["_row_hash", "_row_id"])
    same = (F.col("own._row_hash") == F.col("gone.row_hash")) & F.col("own._row_id").eqNullSafe(F.col("gone.doc_id"))
    return own.alias("own").join(gone.alias("gone"), same, "left_anti").select(*docs.columns)


def row_hash(text: Column) -> Column:
    """What tells rows with the same id apart."""
    return F.xxhash64(text)


class WorkerCache(dict):
    """``cache[key]``, filled by ``make``; emptied by ``trim`` beyond ``size`` entries.

    It lives as long as the Python worker, so its memory is bounded whatever
    the number of distinct keys in the input.
    """

    def __init__(self, make: Callable, size: int = 400_000):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.size:
            self.clear()


#: Bytes of text that a worker splits into words at a time.
SLICE_BYTES = 12 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``size`` bytes of ``column`` or one row."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield b.slice(at, to - at)
            at = to


def split_words(text: pa.Array) -> Tuple[np.ndarray, np.ndarray, List[str]]:
    """Words between ASCII white space: (code of each word, offsets by row, distinct words)."""
    lists = pc.ascii_split_whitespace(text.cast(pa.large_string()))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    coded = flat.dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    offsets = offsets - offsets[0]
    if "" in words:  # at the ends of texts
        keep = codes != words.index("")
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return codes, offsets, words


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0]..starts[0]+lengths[0]-1, starts[1].. and so on."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
