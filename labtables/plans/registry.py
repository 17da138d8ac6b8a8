"""Named tables that are built once, with their dependencies, and then read.

A built table has a record beside it: a fingerprint of what it was built from, and a stamp of the build.
The fingerprint covers the definition's version, the names, sizes and times of its raw files and the
stamps of the tables it depends on, so whatever is built anew makes all that follows from it stale.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtables.config import is_complete, matches, read_small, swap_small
from labtables.sinks.layout import read_bucketed, write_bucketed


@dataclass(frozen=True)
class TableDef:
    """``build`` gets the session and a dict of the tables named in ``deps``.

    ``inputs`` are the raw files and folders it reads, ``version`` stands for its parameters and code.
    ``metrics`` are aggregates that are taken while the table is written, such as counts by reason.
    ``buckets`` (key, number) keeps the table in sorted hash buckets; it needs the schema.
    """

    name: str
    build: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    deps: tuple[str, ...] = ()
    large: bool = False
    schema: T.StructType | None = None
    inputs: tuple[str, ...] = ()
    version: str = ""
    metrics: tuple[tuple[str, Column], ...] = ()
    buckets: tuple[str, int] | None = None


def file_state(spark: SparkSession, path: str) -> str:
    """Number of the files below a path or pattern and a sum over their names, sizes and times; no content
    is read."""
    if not matches(spark, path):
        return "absent"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    return str(found.select(one.alias("h")).agg(F.count("h"), F.sum("h")).first())


@dataclass
class Registry:
    spark: SparkSession
    tables_path: str
    large_path: str
    defs: dict[str, TableDef] = field(default_factory=dict)

    def add(self, *tables: TableDef) -> Registry:
        for t in tables:
            self.defs[t.name] = t
        return self

    def path(self, name: str) -> str:
        base = self.large_path if self._def(name).large else self.tables_path
        return f"{base.rstrip('/')}/{name}"

    def _def(self, name: str) -> TableDef:
        if name not in self.defs:
            raise KeyError(f"unknown table {name!r}; known: {', '.join(sorted(self.defs))}")
        return self.defs[name]

    def order(self, names: Iterable[str]) -> list[str]:
        """The tables and all they depend on, dependencies first."""
        done: list[str] = []

        def visit(name: str, above: tuple[str, ...]) -> None:
            if name in above:
                raise ValueError(f"tables depend on each other: {' > '.join((*above, name))}")
            for dep in self._def(name).deps:
                visit(dep, (*above, name))
            if name not in done:
                done.append(name)

        for name in names:
            visit(name, ())
        return done

    def read(self, name: str) -> DataFrame:
        table = self._def(name)
        if table.buckets:
            return read_bucketed(self.spark, self.path(name), table.schema, *table.buckets)
        return self.spark.read.parquet(self.path(name))

    def _record_path(self, name: str) -> str:
        base, table = self.path(name).rsplit("/", 1)
        return f"{base}/_builds/{table}.json"

    def record(self, name: str) -> dict | None:
        """Fingerprint and stamp of the last build; null for a table that was put there by other means."""
        text = read_small(self.spark, self._record_path(name))
        return json.loads(text) if text else None

    def metrics(self, name: str) -> dict:
        """What was counted while the table was written; nothing is read again."""
        return (self.record(name) or {}).get("metrics", {})

    def fingerprint(self, name: str) -> str:
        """What the table would be built from now."""
        table = self._def(name)
        stamps = [(d, (self.record(d) or {}).get("stamp", "")) for d in table.deps]
        files = [(p, file_state(self.spark, p)) for p in table.inputs]
        return hashlib.sha256(json.dumps([name, table.version, files, stamps, table.buckets]).encode()).hexdigest()

    def is_fresh(self, name: str) -> bool:
        """The table is complete and was built from what is there now; one without a record counts as such."""
        if not is_complete(self.spark, self.path(name)):
            return False
        record = self.record(name)
        return record is None or record["fingerprint"] == self.fingerprint(name)

    def stale(self, names: Iterable[str] | None = None) -> list[str]:
        """The tables, of those named (default: all) and what they depend on, that a build would write."""
        found: list[str] = []
        for step in self.order(list(names) if names is not None else list(self.defs)):
            if any(d in found for d in self._def(step).deps) or not self.is_fresh(step):
                found.append(step)
        return found

    def dependents(self, names: Iterable[str]) -> list[str]:
        """The tables that follow from the named ones, in building order, without these."""
        reached = set(names)
        after = []
        for step in self.order(list(self.defs)):
            if step not in reached and reached.intersection(self._def(step).deps):
                reached.add(step)
                after.append(step)
        return after

    def _write(self, name: str) -> None:
        table = self._def(name)
        # taken before the build: a file that changes meanwhile makes the table stale
        fingerprint = self.fingerprint(name)
        df = table.build(self.spark, {d: self.read(d) for d in table.deps})
        if table.schema is not None:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        seen = Observation(f"{name} {uuid.uuid4().hex}")
        if table.metrics:
            df = df.observe(seen, *[value.alias(metric) for metric, value in table.metrics])
        # a folder without its success marker is left from a failed write and is replaced
        if table.buckets:
            write_bucketed(df, self.path(name), *table.buckets)
        else:
            df.write.mode("overwrite").parquet(self.path(name))
        record = {"fingerprint": fingerprint, "stamp": uuid.uuid4().hex, "metrics": seen.get if table.metrics else {}}
        swap_small(self.spark, self._record_path(name), json.dumps(record))

    def get_or_create(self, name: str) -> DataFrame:
        return self.build([name])[name]

    def build(self, names: Iterable[str] | None = None, overwrite: bool = False) -> dict[str, DataFrame]:
        """Build the named tables (all by default) and what they depend on, where absent or stale.

        ``overwrite`` writes the named ones in any case.
        """
        wanted = list(names) if names is not None else list(self.defs)
        for step in self.order(wanted):
            if (overwrite and step in wanted) or not self.is_fresh(step):
                self._write(step)
        return {n: self.read(n) for n in wanted}

    def rebuild(self, names: Iterable[str]) -> list[str]:
        """Write the named tables anew, then all built tables that follow from them; the names written."""
        wanted = list(names)
        after = [n for n in self.dependents(wanted) if is_complete(self.spark, self.path(n))]
        written = []
        for step in self.order([*wanted, *after]):
            if step in wanted or not self.is_fresh(step):
                self._write(step)
                written.append(step)
        return written


def preview(df: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """First rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def summary(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group, largest first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *keys)
