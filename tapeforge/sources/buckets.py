"""Tables in buckets by key, of which a change rewrites or extends only the buckets that it touches.

A table is a folder with ``data`` (one folder a change, in it one a bucket) and ``manifests``: numbered JSON files, each of
which names the folders that make up every bucket of one version. Files are never overwritten. A version comes to be when its
manifest is renamed to the next number, which fails where that number exists: of two writers one wins, and the other does
its change again, only for the buckets that the winner changed too. So readers, crashes and rivals never see or lose half a change.

The rename must be atomic and refuse to replace a file, as on HDFS and on local disks (there a hard link does it).
A bucket holds keys by their hash, so it has about rows / buckets of them; the number of buckets is fixed when a table is made.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import stored

#: Buckets of a new table, tries of a writer that loses to others, and the folders from which a bucket is written anew.
BUCKETS, TRIES, FOLDERS = 64, 20, 16
_BUCKET = "_bucket"


@dataclass
class Manifest:
    """A version: its number, the key's columns, the folders of each bucket, and the last batch that each writer has applied."""

    number: int
    keys: list[str]
    buckets: int
    schema: str
    folders: dict[int, list[str]] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)


class Conflict(RuntimeError):
    """Others were quicker again and again."""


def _fs(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _child(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([parts[0].rstrip("/"), *parts[1:]]))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all versions, oldest first."""
    fs, _ = _fs(spark, path)
    folder = _child(spark, path, "manifests")
    names = [x.getPath().getName() for x in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> Manifest | None:
    """A version, the newest unless said otherwise; none where there is no table."""
    if number is None:
        number = (versions(spark, path) or [None])[-1]
    if number is None:
        return None
    fs, _ = _fs(spark, path)
    stream = fs.open(_child(spark, path, "manifests", f"{number:010d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(text)
    return Manifest(number, held["keys"], held["buckets"], held["schema"], {int(b): f for b, f in held["folders"].items()}, held["applied"])


def commit(spark: SparkSession, path: str, new: Manifest) -> bool:
    """Whether ``new`` has become the version of its number; False if there is one."""
    jvm = spark.sparkContext._jvm
    fs, _ = _fs(spark, path)
    draft, final = (_child(spark, path, "manifests", n) for n in (f"_draft-{uuid.uuid4().hex}", f"{new.number:010d}.json"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"keys": new.keys, "buckets": new.buckets, "schema": new.schema, "folders": new.folders, "applied": new.applied}), "utf-8"))
    out.close()
    draft, final = fs.makeQualified(draft), fs.makeQualified(final)
    try:
        if final.toUri().getScheme() == "file":
            local = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (final, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, final, none)
        return True
    except Exception as error:
        if "AlreadyExists" in str(error) and fs.exists(final):
            return False
        raise
    finally:
        fs.delete(draft, False)


def bucket_of(keys: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str, of: Manifest, wanted: list[int] | None = None) -> DataFrame:
    """The rows of some or all buckets."""
    folders = [f"{path.rstrip('/')}/data/{f}" for b, held in sorted(of.folders.items()) if wanted is None or b in set(wanted) for f in held]
    schema = T.StructType.fromJson(json.loads(of.schema))
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, wanted: list[int] | None = None, number: int | None = None) -> DataFrame | None:
    """The table, or some of its buckets; none where there is no table."""
    found = manifest(spark, path, number)
    return None if found is None else _read(spark, path, found, wanted)


def touched(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets of rows: never more than there are."""
    return sorted(r[0] for r in rows.select(bucket_of([F.col(k) for k in keys], buckets).alias("b")).distinct().collect())


def read_of_keys(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame | None:
    """The buckets that hold the keys of ``rows``, whose columns are named as the table's keys."""
    found = manifest(spark, path)
    if found is None:
        return None
    return _read(spark, path, found, touched(rows, found.keys, found.buckets))


def _written(df: DataFrame, path: str, keys: list[Column], buckets: int) -> dict[int, list[str]]:
    """df in a folder of its own: the folder of each bucket that has rows."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    at = f"{path.rstrip('/')}/data/{name}"
    rows = df.withColumn(_BUCKET, bucket_of(keys, buckets)).repartition(_BUCKET).sortWithinPartitions(_BUCKET, *keys)
    rows.write.partitionBy(_BUCKET).parquet(at)
    fs, folder = _fs(spark, at)
    names = [x.getPath().getName() for x in fs.listStatus(folder)]
    return {int(n.partition("=")[2]): [f"{name}/{n}"] for n in names if n.startswith(f"{_BUCKET}=")}


def _roots(wrote: dict[int, list[str]]) -> set[str]:
    """The folders of changes that the buckets' folders are in."""
    return {f.partition("/")[0] for held in wrote.values() for f in held}


def _discard(spark: SparkSession, path: str, roots: set[str]) -> None:
    for f in roots:
        fs, folder = _fs(spark, f"{path.rstrip('/')}/data/{f}")
        fs.delete(folder, True)


def change(new: DataFrame, path: str, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame] | None, buckets: int = BUCKETS, writer: str | None = None, batch: int = 0) -> list[int]:
    """Changes the buckets that ``new`` touches, and returns them: ``combine(old, new)`` gives their rows, of whole buckets.

    Without ``combine`` new rows are added to what there is, in files of their own, until a bucket has FOLDERS of them. A ``writer``
    whose ``batch`` has been applied, or a later one, changes nothing. ``keys``: names of columns, also within structs.
    """
    spark, cols = new.sparkSession, [F.col(k) for k in keys]
    new = stored(new)  # it is read at each try
    base = manifest(spark, path)
    count = buckets if base is None else base.buckets
    own = touched(new, keys, count)
    wrote: dict[int, list[str]] = {}  # by bucket: what this change makes of it
    seen: dict[int, list[str]] = {}  # and what that was made from
    for _ in range(TRIES):
        if base is not None and base.keys != keys:
            raise ValueError(f"the table's keys are {base.keys}")
        if base is not None and writer is not None and base.applied.get(writer, -1) >= batch:
            return []
        now = base or Manifest(-1, keys, count, new.schema.json())
        full = [b for b in own if combine is not None or len(now.folders.get(b, [])) >= FOLDERS]
        before = _roots(wrote)
        for b in [b for b in wrote if (b in full) != (b in seen)]:  # others have filled it or written it anew
            del wrote[b]
            seen.pop(b, None)
        plain = [b for b in own if b not in full and b not in wrote]
        late = [b for b in full if b not in wrote or seen.get(b) != now.folders.get(b, [])]
        if late:
            some = new.filter(bucket_of(cols, count).isin(late)) if len(late) < count else new
            old = _read(spark, path, now, late)
            made = _written((combine or DataFrame.unionByName)(old, some), path, cols, count)
            wrote |= {b: made.get(b, []) for b in late}
            seen |= {b: now.folders.get(b, []) for b in late}
        if plain:
            made = _written(new.filter(bucket_of(cols, count).isin(plain)) if late else new, path, cols, count)
            wrote |= {b: made.get(b, []) for b in plain}
        _discard(spark, path, before - _roots(wrote))
        folders = now.folders | {b: wrote[b] if b in full else [*now.folders.get(b, []), *wrote[b]] for b in own}
        applied = now.applied if writer is None else now.applied | {writer: batch}
        if commit(spark, path, Manifest(now.number + 1, keys, count, now.schema, {b: f for b, f in folders.items() if f}, applied)):
            return own
        base = manifest(spark, path)
        if base.buckets != count:
            raise Conflict(f"{path} was made with {base.buckets} buckets meanwhile")
    _discard(spark, path, _roots(wrote))
    raise Conflict(f"{path} has changed {TRIES} times while it was being changed")


def replace(df: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """The whole table anew."""
    spark = df.sparkSession
    folders = _written(df, path, [F.col(k) for k in keys], buckets)
    for _ in range(TRIES):
        last = manifest(spark, path)
        if commit(spark, path, Manifest(last.number + 1 if last else 0, keys, buckets, df.schema.json(), folders, last.applied if last else {})):
            return
    _discard(spark, path, _roots(folders))
    raise Conflict(f"{path} has changed {TRIES} times while it was being replaced")


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes all but the newest versions and the buckets' folders that only those had; jobs that still read an older one need it kept."""
    numbers = versions(spark, path)
    old, held = numbers[: -max(1, keep)], numbers[-max(1, keep) :]
    used = {f for n in held for fs in manifest(spark, path, n).folders.values() for f in fs}
    gone = {f for n in old for fs in manifest(spark, path, n).folders.values() for f in fs} - used
    for n in old:
        fs, _ = _fs(spark, path)
        fs.delete(_child(spark, path, "manifests", f"{n:010d}.json"), False)
    for f in gone:
        fs, folder = _fs(spark, f"{path.rstrip('/')}/data/{f}")
        fs.delete(folder, True)
