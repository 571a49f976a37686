"""Tables published in versions: a load writes new folders, and one manifest, written last, makes all of them visible at once.

A table lives in folders ``load=<number>-<mark>/<month>=<value>``. The manifest of a version says, per table, which load holds each month.
A reader takes the newest manifest and keeps to it: it never sees half a load, and a load that fails leaves nothing a reader looks at. Months
a load doesn't bring stay where they are; nothing is rewritten or listed for them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.schema import PARTITION_COLUMN, stored_schema
from shelfwise.sources.sinks import months_side_by_side

MANIFESTS = "_manifests"
#: Month of a table without months.
WHOLE = ""


class PublishConflict(RuntimeError):
    """Another load was published meanwhile; this one has changed nothing and can be run again."""


@dataclass(frozen=True)
class Table:
    """Where a table's rows are: month (or ``WHOLE``) to load, and the schema as stored."""

    months: dict[str, str]
    schema: str
    month_column: str | None = None


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    #: What a load wants remembered with its version, as text by name.
    notes: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        tables = {n: {"months": t.months, "schema": t.schema, "month_column": t.month_column} for n, t in sorted(self.tables.items())}
        return json.dumps({"version": self.number, "tables": tables, "notes": self.notes}, indent=1)

    @staticmethod
    def of(text: str) -> Version:
        found = json.loads(text)
        return Version(found["version"], {n: Table(**t) for n, t in found["tables"].items()}, found["notes"])


class _Files:
    """The few file operations of the driver: small files and names, never data."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self.root = folder.rstrip("/")
        self._system = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        at = self.path(name)
        return [s.getPath().getName() for s in self._system.listStatus(at)] if self._system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._system.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """Write a file under another name, then give it its own; false if that exists."""
        draft = self.path(f"{MANIFESTS}/.{uuid.uuid4().hex}")
        stream = self._system.create(draft, True)
        stream.write(text.encode())
        stream.close()
        target = self.path(name)
        done = not self._system.exists(target) and self._system.rename(draft, target)
        if not done:
            self._system.delete(draft, False)
        return done

    def delete(self, name: str) -> None:
        self._system.delete(self.path(name), True)


def _manifest(number: int) -> str:
    return f"{MANIFESTS}/{number:012d}.json"


def version_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Published versions, oldest first."""
    return sorted(int(n[:-5]) for n in _Files(spark, folder).names(MANIFESTS) if n.endswith(".json") and n[0] != ".")


def read_version(spark: SparkSession, folder: str, number: int | None = None) -> Version:
    """A published version, by default the newest; version 0, without tables, where nothing has been published."""
    known = version_numbers(spark, folder)
    if number is None and not known:
        return Version()
    if number is not None and number not in known:
        raise FileNotFoundError(f"no version {number} in {folder}")
    return Version.of(_Files(spark, folder).read(_manifest(number or known[-1])))


def read_table(spark: SparkSession, folder: str, version: Version, name: str, months: list[str] | None = None) -> DataFrame:
    """A table of a version: one scan over its folders, of which month filters open only those they need. ``months`` narrows it beforehand."""
    table = version.tables[name]
    schema = T.StructType.fromJson(json.loads(table.schema))
    chosen = {m: load for m, load in table.months.items() if months is None or m in months}
    if not chosen:
        return spark.createDataFrame([], schema)
    place = (lambda m, load: f"load={load}/{table.month_column}={m}") if table.month_column else (lambda m, load: f"load={load}")
    paths = [f"{folder.rstrip('/')}/{name}/{place(m, load)}" for m, load in sorted(chosen.items())]
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).option("basePath", f"{folder.rstrip('/')}/{name}")
    return rows.parquet(*paths).select(*schema.names)


def publish(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], month_columns: Mapping[str, str] | None = None,
            base: Version | None = None, whole: bool = True, drop: Mapping[str, list[str]] | None = None,
            notes: Mapping[str, str] | None = None, threads: int = 4, by_month: Collection[str] = ()) -> Version:
    """Publish tables as the next version and return it.

    With ``whole`` a table is replaced; else its months in the frame are replaced and the others stay (a table without months is always
    replaced); columns then take the types the table has. ``drop`` names months to take away. Tables not given stay. ``base`` is the version the load started from, by default the newest;
    if another has been published since, ``PublishConflict`` is raised and nothing changes. Month columns are those of the big facts
    unless given. ``by_month`` names tables whose rows come straight from month folders; they are written as they come, without a shuffle or a sort.
    """
    files = _Files(spark, folder)
    base = base or read_version(spark, folder)
    load = f"{base.number + 1}-{uuid.uuid4().hex[:8]}"
    columns = {**{t: c for t, (c, _) in PARTITION_COLUMN.items()}, **(month_columns or {})}

    def write(name: str) -> Table:
        df, month = tables[name], columns.get(name)
        if not whole and name in base.tables:
            # months that stay are read with the same types
            known = T.StructType.fromJson(json.loads(base.tables[name].schema))
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known.fields])
        path = f"{folder.rstrip('/')}/{name}/load={load}"
        if month is None:
            df.write.parquet(path)
            return Table({WHOLE: load}, df.schema.json())
        order = [PARTITION_COLUMN[name][1]] if name in PARTITION_COLUMN else []
        if name not in by_month:
            df = df.hint("rebalance", month).sortWithinPartitions(month, *order)
        df.write.partitionBy(month).parquet(path, compression="zstd")
        brought = {n.split("=", 1)[1]: load for n in files.names(f"{name}/load={load}") if n.startswith(f"{month}=")}
        stay = {} if whole or name not in base.tables else base.tables[name].months
        months = {m: at for m, at in {**stay, **brought}.items() if m not in (drop or {}).get(name, ())}
        fields = [f for f in df.schema.fields if f.name != month] + [df.schema[month]]
        return Table(months, T.StructType(fields).json(), month)

    with months_side_by_side(spark, bool(by_month)), ThreadPoolExecutor(threads) as pool:
        written = dict(zip(tables, pool.map(write, tables), strict=True))
    then = Version(base.number + 1, {**base.tables, **written}, {**base.notes, **(notes or {})})
    newest = version_numbers(spark, folder)
    if (newest and newest[-1] != base.number) or not files.write_new(_manifest(then.number), then.text()):
        raise PublishConflict(f"{folder} has gone beyond version {base.number}")
    return then


def expire(spark: SparkSession, folder: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions and the folders none of the kept ones needs; the numbers removed.

    Folders of loads that never got a manifest go as well, so it must not run beside a load, nor beside readers of versions it removes.
    """
    files = _Files(spark, folder)
    numbers = version_numbers(spark, folder)
    kept = [read_version(spark, folder, n) for n in numbers[-keep:]]
    gone = numbers[:-keep]
    # manifests first: a version whose manifest is there always has its files
    for n in gone:
        files.delete(_manifest(n))
    for name in files.names(""):
        used = {at for v in kept if name in v.tables for at in v.tables[name].months.values()}
        for found in files.names(name) if name != MANIFESTS else []:
            if found.startswith("load=") and found[5:] not in used:
                files.delete(f"{name}/{found}")
    return gone


def changed_months(before: Version, now: Version, name: str) -> tuple[list[str], list[str]]:
    """Months of a table that were brought or rewritten since a version, and months taken away; told by the manifests alone."""
    old = before.tables[name].months if name in before.tables else {}
    new = now.tables[name].months if name in now.tables else {}
    return sorted(m for m, at in new.items() if old.get(m) != at), sorted(set(old) - set(new))


def read_star(spark: SparkSession, folder: str, number: int | None = None):
    """The star of one published version; all its tables are of that version, whatever is published meanwhile."""
    from shelfwise.sources.star import Star

    version = read_version(spark, folder, number)

    def read(name: str) -> DataFrame:
        rows = read_table(spark, folder, version, name)
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored_schema(name).fields])

    return Star(spark, read)


def is_published(spark: SparkSession, folder: str) -> bool:
    return bool(version_numbers(spark, folder))

