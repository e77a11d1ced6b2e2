"""Tables kept up to date from change streams: copy-on-write buckets and manifests.

A table's rows lie in buckets by a hash of their keys.  An update reads and rewrites only
the buckets of the keys it changes, into a folder of its own, and then writes a manifest
that lists the files' folders of all buckets.  A manifest appears whole, by a rename, and
files are never changed, so a reader sees one version from its first to its last file.

Manifests that have been out of date for a while go, and with them the files that no
other manifest lists.  Choose the while longer than any batch can last: readers of that
age lose nothing.  The folder must be on storage that all executors share.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
BUCKET = "__bucket"
DAY_S = 86_400


@dataclass(frozen=True)
class Manifest:
    """``files``: bucket -> folder of its rows, below the table's; empty ones are absent."""

    number: int
    keys: list[str]
    buckets: int
    schema: dict
    files: dict[str, str]

    def bucket(self) -> Column:
        return bucket_of(self.keys, self.buckets)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    texts = [F.col(k).cast("string") for k in keys]
    return F.pmod(F.xxhash64(*texts), F.lit(buckets)).cast("int")


# -- files -----------------------------------------------------------------------


def _fs(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names in a folder and when they were written (seconds)."""
    fs, path = _fs(spark, folder)
    found = fs.listStatus(path) if fs.exists(path) else []
    return [(f.getPath().getName(), f.getModificationTime() // 1000) for f in found]


def _delete(spark: SparkSession, name: str) -> None:
    fs, path = _fs(spark, name)
    fs.delete(path, True)


def _numbers(spark: SparkSession, folder: str) -> dict[int, int]:
    """Numbers of the manifests and when they were written, in order."""
    found = {
        int(name.removesuffix(".json")): at
        for name, at in _listed(spark, f"{folder}/manifests")
        if name.endswith(".json")
    }
    return dict(sorted(found.items()))


def _read_manifest(spark: SparkSession, folder: str, number: int) -> Manifest:
    text = spark.read.text(f"{folder}/manifests/{number}.json", wholetext=True).first()[0]
    return Manifest(**json.loads(text))


def _write_manifest(spark: SparkSession, folder: str, manifest: Manifest) -> None:
    name = f"{folder}/manifests/{manifest.number}"
    fs, path = _fs(spark, f"{name}.json")
    _, part = _fs(spark, f"{name}-{uuid.uuid4()}.part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(asdict(manifest)).encode()))
    out.close()
    fs.delete(path, False)  # of an earlier try of the same batch
    if not fs.rename(part, path):
        raise OSError(f"cannot write {path}")


def _write_buckets(rows: DataFrame, folder: str, manifest: Manifest) -> dict[str, str]:
    """The folders of the buckets that rows have. A large bucket is written by many tasks."""
    spark, part = rows.sparkSession, f"data/{manifest.number}-{uuid.uuid4()}"
    placed = rows.withColumn(BUCKET, manifest.bucket()).hint("rebalance", BUCKET)
    placed.write.partitionBy(BUCKET).parquet(f"{folder}/{part}")
    names = [name for name, _ in _listed(spark, f"{folder}/{part}")]
    return {
        name.split("=")[1]: f"{part}/{name}" for name in names if name.startswith(BUCKET)
    }


def _rows(spark: SparkSession, folder: str, manifest: Manifest, files: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(manifest.schema)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/{f}" for f in files])


# -- tables ----------------------------------------------------------------------


def write_table(
    rows: DataFrame, folder: str, keys: Sequence[str], buckets: int = BUCKETS
) -> None:
    """The first version of a table, number -1."""
    schema = json.loads(rows.schema.json())
    manifest = Manifest(-1, list(keys), buckets, schema, {})
    files = _write_buckets(rows, folder, manifest)
    _write_manifest(rows.sparkSession, folder, replace(manifest, files=files))


def read_table(
    spark: SparkSession, folder: str, before: int | None = None
) -> DataFrame | None:
    """The latest version (below ``before``), None if there is none."""
    numbers = [n for n in _numbers(spark, folder) if before is None or n < before]
    if not numbers:
        return None
    manifest = _read_manifest(spark, folder, numbers[-1])
    return _rows(spark, folder, manifest, list(manifest.files.values()))


def update_table(
    folder: str,
    changes: DataFrame,
    apply: Callable[[DataFrame, DataFrame], DataFrame],
    number: int,
) -> list[int]:
    """Version ``number``: ``apply(rows, changes)`` on the buckets that changes touch.

    ``changes`` hold the table's keys, and ``apply`` must leave other keys alone; it is
    given the rows of the touched buckets only.  A repeated call for a number starts
    from the version before it again.  Returns the touched buckets.
    """
    spark = changes.sparkSession
    numbers = [n for n in _numbers(spark, folder) if n < number]
    if not numbers:
        raise ValueError(f"no first version under {folder}")
    before = _read_manifest(spark, folder, numbers[-1])
    after = replace(before, number=number)
    touched = sorted(r[0] for r in changes.select(before.bucket()).distinct().collect())
    if touched:
        names = {str(b) for b in touched}
        old = [f for b, f in before.files.items() if b in names]
        rows = apply(_rows(spark, folder, before, old), changes)
        columns = T.StructType.fromJson(before.schema).names
        kept = {b: f for b, f in before.files.items() if b not in names}
        written = _write_buckets(rows.select(*columns), folder, after)
        if not written.keys() <= names:
            raise ValueError("apply made rows of keys that are not in the changes")
        after = replace(after, files=kept | written)
    _write_manifest(spark, folder, after)
    return touched


def expire(
    spark: SparkSession, folder: str, older_than_s: float = DAY_S, now: float | None = None
) -> None:
    """Delete what has been out of date for so long: manifests, and files none lists."""
    limit = (time.time() if now is None else now) - older_than_s
    numbers = _numbers(spark, folder)
    order = list(numbers)
    # a version is out of date from the time the next one was written
    gone = [n for n, later in zip(order, order[1:]) if numbers[later] < limit]
    for number in gone:
        _delete(spark, f"{folder}/manifests/{number}.json")
    listed = {
        f.split("/")[1] + "/" + f.split("/")[2]
        for n in order
        if n not in gone
        for f in _read_manifest(spark, folder, n).files.values()
    }
    for part, at in _listed(spark, f"{folder}/data"):
        if at >= limit:
            continue  # of an update that may still be under way, too
        names = [name for name, _ in _listed(spark, f"{folder}/data/{part}")]
        used = [name for name in names if f"{part}/{name}" in listed]
        if not used:
            _delete(spark, f"{folder}/data/{part}")
            continue
        for name in names:
            if name.startswith(BUCKET) and name not in used:
                _delete(spark, f"{folder}/data/{part}/{name}")
