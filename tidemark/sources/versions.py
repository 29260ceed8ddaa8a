"""Tables that change by whole versions: parts written apart, then shown by one small manifest.

A version says which folders hold each part's rows. A run writes the parts it changes
into folders of its own, may test the result, and becomes visible when its manifest gets
the next number; that name can be taken once only. A run that fails or is killed before leaves
the last version as it was, and the folders of other parts are never opened for writing. Readers of an
older version keep their files until ``expire``. The file system needs a rename that does not replace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.quality import Check, RowCheck, run_suite

#: Column and folder prefix of a row's part; rows without a part are one part too.
PART = "_part"
MANIFESTS = "_versions"


class Version(NamedTuple):
    """``number`` is 0 before the first run; ``about`` is what writers keep with the table."""

    number: int
    about: dict
    parts: dict[str | None, list[str]]


class Conflict(RuntimeError):
    """Another run has published the next version meanwhile."""


Tests = Callable[[DataFrame], Sequence[Check | RowCheck]]


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The published versions, ascending."""
    fs, there = _files(spark, f"{path}/{MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(there)] if fs.exists(there) else []
    return sorted(int(n[1:]) for n in names if n[0] == "v")


def version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The given version, or the latest."""
    number = number if number is not None else max(numbers(spark, path), default=0)
    if number == 0:
        return Version(0, {}, {})
    fs, there = _files(spark, f"{path}/{MANIFESTS}/v{number:010}")
    stream = fs.open(there)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Version(number, found["about"], {p: folders for p, folders in found["parts"]})


def read(spark: SparkSession, path: str, schema: StructType, of: Version | None = None, parts: Sequence[str | None] | None = None) -> DataFrame:
    """The rows of a version, of the latest by default, or of some of its parts; a table without folders is empty."""
    of = of or version(spark, path)
    folders = [f"{path}/{f}" for p, own in of.parts.items() if parts is None or p in set(parts) for f in own]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def part_of(part: Column) -> Column:
    """A part as the text that names its folder; nothing and the empty text are one part."""
    return F.nullif(part.cast("string"), F.lit(""))


def parts_in(df: DataFrame, part: Column) -> list[str | None]:
    """The distinct parts of some rows; a table has as many parts as its writer chose, not as its rows."""
    return [r[0] for r in df.select(part_of(part).alias("p")).distinct().collect()]


def stage(rows: DataFrame, path: str, part: Column) -> dict[str | None, str]:
    """Write rows into new folders of the table, one for each part, which no version names yet.

    A part's rows are dealt to as many tasks as their size asks for.
    """
    run = f"run-{uuid.uuid4().hex}"
    marked = rows.withColumn(PART, part_of(part)).hint("rebalance", PART)
    marked.write.partitionBy(PART).parquet(f"{path}/{run}")
    fs, there = _files(rows.sparkSession, f"{path}/{run}")
    names = [s.getPath().getName() for s in fs.listStatus(there) if s.isDirectory()]
    found = {}
    for name in names:
        value = unquote(name.removeprefix(f"{PART}="))
        found[None if value == "__HIVE_DEFAULT_PARTITION__" else value] = f"{run}/{name}"
    return found


def publish(spark: SparkSession, path: str, after: Version, about: dict, parts: dict[str | None, list[str]]) -> Version:
    """Make the version after ``after`` visible by one rename; Conflict if another run was faster."""
    new = Version(after.number + 1, about, {p: own for p, own in parts.items() if own})
    text = json.dumps({"about": new.about, "parts": list(new.parts.items())})
    fs, apart = _files(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    stream = fs.create(apart, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    sc = spark.sparkContext
    rename = sc._jvm.org.apache.hadoop.fs.Options.Rename
    files = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(apart.toUri(), sc._jsc.hadoopConfiguration())
    _, target = _files(spark, f"{path}/{MANIFESTS}/v{new.number:010}")
    try:
        files.rename(apart, target, sc._gateway.new_array(rename, 0))
    except Exception as e:
        fs.delete(apart, False)
        if "FileAlreadyExistsException" in str(e):
            raise Conflict(f"version {new.number} of {path} is there already") from e
        raise
    return new


def replace_parts(
    rows: DataFrame,
    path: str,
    part: Column,
    *,
    touched: Sequence[str | None] | None = None,
    add: bool = False,
    tests: Tests | None = None,
    about: dict | None = None,
    after: Version | None = None,
) -> Version:
    """Publish a version in which the touched parts hold just ``rows``; without ``touched``, the whole table.

    With ``add`` the rows join what their parts hold. ``tests`` gets the new version's rows and returns checks;
    if one of severity 'error' fails, or anything else does, the run's folders go and no version is published.
    """
    spark = rows.sparkSession
    after = after or version(spark, path)
    new = stage(rows, path, part)
    kept = after.parts if add else {} if touched is None else {p: own for p, own in after.parts.items() if p not in set(touched)}
    if not add and touched is not None and (stray := set(new) - set(touched)):
        raise ValueError(f"rows of parts that are not replaced: {sorted(map(str, stray))[:5]}")
    parts = {p: [*kept.get(p, []), *([new[p]] if p in new else [])] for p in {**kept, **new}}
    try:
        if tests is not None:
            run_suite(tests(read(spark, path, rows.schema, Version(-1, {}, parts))))
        return publish(spark, path, after, after.about | (about or {}), parts)
    except Exception:
        for folder in new.values():
            fs, there = _files(spark, f"{path}/{folder}")
            fs.delete(there, True)
        raise


def expire(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the latest ``keep`` versions, and the folders that no remaining version names; how many went.

    No run may be writing meanwhile: its folders are not named yet.
    """
    there = numbers(spark, path)
    used = {f for n in there[-keep:] for own in version(spark, path, n).parts.values() for f in own}
    fs, root = _files(spark, path)
    for n in there[:-keep]:
        fs.delete(_files(spark, f"{path}/{MANIFESTS}/v{n:010}")[1], False)
    gone = 0
    for run in fs.listStatus(root) if fs.exists(root) else []:
        name = run.getPath().getName()
        if not name.startswith("run-"):
            continue
        for folder in fs.listStatus(run.getPath()):
            if folder.isDirectory() and f"{name}/{folder.getPath().getName()}" not in used:
                fs.delete(folder.getPath(), True)
                gone += 1
        if not any(s.isDirectory() for s in fs.listStatus(run.getPath())):
            fs.delete(run.getPath(), True)
    return gone
