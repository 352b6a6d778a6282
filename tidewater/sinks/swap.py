"""Replacing files or partitions of a Parquet table so that a stop at any moment loses nothing.

New data is written to a staging folder first. A small intent file then names
what goes and what comes; only after it is durable are old paths deleted and
staged ones renamed into place. A run that stops in between is finished by
``recover``, which every reader and the next writer call first: rolling forward
is the same whether nothing, half or all of it was done. With Delta none of
this is used (its log does it).
"""

from __future__ import annotations

import json
import uuid
from typing import Iterable, List, Optional, Tuple

from pyspark.sql import DataFrame, SparkSession

from .storage import filesystem

INTENT = "_swap.json"
#: Directory name of a NULL partition value (fixed by the Hive layout).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def list_names(spark: SparkSession, path: str) -> List[str]:
    """Names directly under ``path``, none where it doesn't exist."""
    fs, p = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears whole or not at all: written beside its place, then renamed."""
    fs, p = filesystem(spark, path)
    beside = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, p):
        raise RuntimeError(f"could not write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _finish(spark: SparkSession, root: str, intent: dict) -> None:
    fs, _ = filesystem(spark, root)
    for name in intent["delete"]:
        fs.delete(_path(spark, f"{root}/{name}"), True)
    for staged, name in intent["add"]:
        source, target = _path(spark, f"{root}/{staged}"), _path(spark, f"{root}/{name}")
        if not fs.exists(source):
            continue  # renamed by the run that stopped
        if fs.exists(target):
            fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise RuntimeError(f"could not move {source} to {target}")
    fs.delete(_path(spark, f"{root}/{INTENT}"), False)
    if intent.get("staging"):
        fs.delete(_path(spark, f"{root}/{intent['staging']}"), True)


def recover(spark: SparkSession, root: str) -> bool:
    """Finishes a replacement that was begun under ``root``; True if there was one."""
    root = root.rstrip("/")
    fs, p = filesystem(spark, f"{root}/{INTENT}")
    if not fs.exists(p):
        return False
    _finish(spark, root, json.loads(_read_text(spark, f"{root}/{INTENT}")))
    return True


def swap(spark: SparkSession, root: str, delete: Iterable[str], add: Iterable[Tuple[str, str]], staging: Optional[str] = None) -> None:
    """Deletes ``delete`` and renames each (staged, name) of ``add``; all are paths under ``root``.

    A path may be deleted and added: the old content goes first. ``staging`` is
    removed at the end.
    """
    root = root.rstrip("/")
    intent = {"delete": list(delete), "add": [list(a) for a in add], "staging": staging}
    # A path that comes again must not be deleted on a second roll-forward.
    again = {name for _, name in intent["add"]}
    intent["delete"] = [d for d in intent["delete"] if d not in again]
    _write_text(spark, f"{root}/{INTENT}", json.dumps(intent))
    _finish(spark, root, intent)


def partition_name(column: str, value) -> str:
    return f"{column}={NULL_PARTITION if value is None else value}"


def replace_partitions(df: DataFrame, root: str, column: str, values: Iterable, fmt: str = "parquet") -> None:
    """Dynamic partition overwrite: the partitions ``values`` of the table at ``root`` hold
    exactly the rows of ``df`` afterwards; a value without rows loses its partition.

    ``df`` may read the table itself: its files stay until the new ones are complete.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if fmt == "delta":
        parts = [f"{column} IS NULL" if v is None else f"{column} = '{v}'" for v in values]
        df.write.format("delta").mode("overwrite").option("replaceWhere", " OR ".join(parts)).save(root)
        return
    recover(spark, root)
    staging = f"_staging-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(column).format(fmt).save(f"{root}/{staging}")
    wanted = {partition_name(column, v) for v in values}
    come = [n for n in list_names(spark, f"{root}/{staging}") if n.startswith(f"{column}=")]
    if not wanted.issuperset(come):
        raise ValueError(f"rows outside the partitions to replace: {sorted(set(come) - wanted)[:5]}")
    swap(spark, root, wanted, [(f"{staging}/{n}", n) for n in come], staging)
