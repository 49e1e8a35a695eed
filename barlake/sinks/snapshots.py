"""Tables as file groups under a snapshot manifest.

A write makes one file group: a new folder, clustered by month and sorted by day
inside, so that its files follow the data's size and not the number of days and
venues. Nothing sees the group until a manifest names it. A manifest is one small
JSON file; the greatest readable version is the table's state. It holds for each
group which (day, venue) keys are live, so replacing a day writes one new group,
marks the day dead in the older ones and switches one pointer. A reader keeps the
files of the version it began with; the files of versions before the last
``KEEP_VERSIONS`` are removed.

The driver holds the keys only: days x venues of each group.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.exprs import TEMPORAL_TYPES

MODES = ("dynamic_overwrite", "append", "overwrite")
KEEP_VERSIONS = 2
CODEC = "zstd"  # of Parquet files
_GROUP, _MONTH, _NO_MONTH = "_group", "_month", "__HIVE_DEFAULT_PARTITION__"

Key = tuple  # (day text, venue, ...)


def render_dates_as_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Temporal columns as ``yyyy-MM-dd`` text (JSON payload contract), but for
    those in ``keep``; other columns untouched."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TEMPORAL_TYPES) and f.name not in keep:
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def observed(observation: Observation) -> dict:
    """What was observed; nothing where the optimizer found the input empty and
    ran no plan with the observation in it."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


class _Files:
    """The few file operations a manifest needs, by Hadoop's file system of the path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails where the file exists."""
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass
class Snapshot:
    version: int
    schema: T.StructType
    fmt: str
    day: str | None
    below: list[str]
    groups: dict[str, dict]  # id -> {"live": [key...], "dead": [key...]}
    note: object = None

    @classmethod
    def parse(cls, text: str) -> "Snapshot":
        d = json.loads(text)
        groups = {g: {k: [tuple(x) for x in v] for k, v in keys.items()} for g, keys in d["groups"].items()}
        return cls(d["version"], T.StructType.fromJson(d["schema"]), d["fmt"], d["day"], d["below"], groups, d["note"])

    def render(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "fmt": self.fmt, "day": self.day,
                           "below": self.below, "groups": self.groups, "note": self.note})

    def keys(self) -> list[Key]:
        found = {k for g in self.groups.values() for k in g["live"]}
        return sorted(found, key=lambda k: tuple(x or "" for x in k))


@dataclass
class Staged:
    """A file group that no manifest names yet."""
    table: "SnapshotTable"
    group: str
    schema: T.StructType
    rows: int
    keys: list[Key]
    measures: dict = field(default_factory=dict)

    def read(self) -> DataFrame:
        if not self.rows:
            return self.table.spark.createDataFrame([], self.schema)
        return self.table._frame(self.schema, {self.group: {"live": self.keys, "dead": []}})

    def discard(self) -> None:
        self.table.files.delete(f"data/{_GROUP}={self.group}")

    def days(self) -> list[str]:
        return sorted({k[0] for k in self.keys if k[0] is not None})


class SnapshotTable:
    """A table at ``path``. With ``day`` its keys are the days of that column and
    the values of the ``below`` columns, and a write can replace the keys it
    brings; without, a write replaces the table."""

    def __init__(self, spark: SparkSession, path: str, day: str | None = None, below: Sequence[str] = (),
                 fmt: str = "parquet"):
        self.spark, self.path = spark, path.rstrip("/")
        self.day, self.below, self.fmt = day, list(below), fmt
        self.files = _Files(spark, self.path)

    # -- versions ------------------------------------------------------------
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names("_snapshots") if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> Snapshot | None:
        """The newest readable manifest: one that a lost writer left incomplete
        doesn't parse and isn't the state."""
        for version in reversed(self.versions()):
            try:
                return Snapshot.parse(self.files.text(self._manifest(version)))
            except (ValueError, KeyError):
                continue
        return None

    @staticmethod
    def _manifest(version: int) -> str:
        return f"_snapshots/{version:010d}.json"

    # -- writing -------------------------------------------------------------
    def stage(self, df: DataFrame, sort: Sequence[str] = (), measures: Mapping[str, Column] | None = None, *,
              clustered: bool = False) -> Staged:
        """Write ``df`` as a file group. Rows, keys and ``measures`` (aggregates of
        bounded size) are observed by the write itself. A failed write leaves no
        group. ``clustered``: ``df`` reads another group row by row and keeps its months,
        so its scan tasks are written as they are, without a shuffle."""
        aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (measures or {}).items()]]
        out = df
        if self.day is not None:
            out = out.withColumn(self.day, F.to_date(self.day))
            aggregates.append(F.collect_set(F.struct(*[
                F.col(c).cast("string").alias(c) for c in (self.day, *self.below)])).alias("keys"))
        if self.fmt == "json":
            out = render_dates_as_text(out, keep=(self.day,))
        schema = out.schema
        seen = Observation(f"write_{uuid.uuid4().hex}")
        out = out.observe(seen, *aggregates)
        if self.day is not None:
            out = out.withColumn(_MONTH, F.date_format(self.day, "yyyy-MM"))
            out = (out if clustered else out.hint("rebalance", _MONTH)).sortWithinPartitions(_MONTH, self.day, *sort)
        staged = Staged(self, uuid.uuid4().hex, schema, 0, [])
        writer = out.write.format(self.fmt).mode("errorifexists")
        if self.fmt == "json":
            writer = writer.option("ignoreNullFields", "false")
        else:
            writer = writer.option("compression", CODEC)
        try:
            (writer if self.day is None else writer.partitionBy(_MONTH)).save(f"{self.path}/data/{_GROUP}={staged.group}")
        except BaseException:
            staged.discard()
            raise
        got = observed(seen)
        staged.rows = int(got.get("rows") or 0)
        staged.keys = sorted((tuple(k) for k in got.get("keys") or []), key=lambda k: tuple(x or "" for x in k))
        staged.measures = {n: got.get(n) for n in measures or {}}
        return staged

    def publish(self, staged: Staged, mode: str = "dynamic_overwrite", note: object = None) -> int:
        """Switch to a manifest with the staged group. ``dynamic_overwrite`` replaces the
        keys it holds (without keys: the table), ``append`` keeps older rows of them,
        ``overwrite`` drops all other groups. Two writers can't publish the same version: the later fails."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        now = self.current()
        groups: dict[str, dict] = {}
        if now is not None and self.day is None and mode == "append":
            groups.update(now.groups)
        elif now is not None and self.day is not None and mode != "overwrite":
            replaced = set(staged.keys) if mode == "dynamic_overwrite" else set()
            for group, keys in now.groups.items():
                live = [k for k in keys["live"] if k not in replaced]
                if live:
                    groups[group] = {"live": live, "dead": keys["dead"] + [k for k in keys["live"] if k in replaced]}
        if staged.rows:
            groups[staged.group] = {"live": staged.keys, "dead": []}
        else:
            staged.discard()
        version = max(self.versions(), default=0) + 1
        state = Snapshot(version, staged.schema, self.fmt, self.day, self.below, groups, note)
        self.files.create(self._manifest(version), state.render())
        self._clean()
        return version

    def compact(self, first: str | None = None, last: str | None = None) -> int | None:
        """Rewrite the live rows of a span of days as one group."""
        frame = self.read(first, last)
        return None if frame is None else self.publish(self.stage(frame))

    def _clean(self) -> None:
        versions = self.versions()
        if len(versions) <= KEEP_VERSIONS:
            return

        def groups(version: int) -> set[str]:
            try:
                return set(Snapshot.parse(self.files.text(self._manifest(version))).groups)
            except (ValueError, KeyError):
                return set()

        kept = set().union(*map(groups, versions[-KEEP_VERSIONS:]))
        for version in versions[:-KEEP_VERSIONS]:
            for group in groups(version) - kept:
                self.files.delete(f"data/{_GROUP}={group}")
            self.files.delete(self._manifest(version))

    # -- reading -------------------------------------------------------------
    def read(self, first: str | None = None, last: str | None = None) -> DataFrame | None:
        """The live rows of the newest version (None before the first), of the days
        from ``first`` up to and with ``last``: other months' folders aren't named."""
        now = self.current()
        if now is None:
            return None
        self.day, self.below, self.fmt = now.day, now.below, now.fmt
        frame = self._frame(now.schema, now.groups, first, last)
        for bound, keep in ((first, lambda d, b: d >= b), (last, lambda d, b: d <= b)):
            if bound is not None and now.day is not None:
                frame = frame.where(keep(F.col(now.day), F.lit(bound).cast("date")))
        return frame

    def _frame(self, schema: T.StructType, groups: Mapping[str, dict], first: str | None = None,
               last: str | None = None) -> DataFrame:
        paths, dead = [], []
        for group, keys in sorted(groups.items()):
            folder = f"{self.path}/data/{_GROUP}={group}"
            if self.day is None or (first is None and last is None):
                paths.append(folder)
                dead += [(group, *k) for k in keys["dead"]]
                continue
            # months with a live day in the span; the span itself is filtered by the caller
            days = {k[0] for k in keys["live"] if k[0] is not None and (first or "") <= k[0] <= (last or "9999-12-31")}
            months = {d[:7] for d in days}
            paths += [f"{folder}/{_MONTH}={m}" for m in sorted(months)]
            dead += [(group, *k) for k in keys["dead"] if (k[0] or _NO_MONTH)[:7] in months]
        if not paths:
            return self.spark.createDataFrame([], schema)
        extra = [_GROUP] if self.day is None else [_GROUP, _MONTH]
        full = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in extra]])
        frame = self.spark.read.format(self.fmt).schema(full).option("basePath", f"{self.path}/data").load(paths)
        if dead:
            names = ["_dead_group", *[f"_dead_{i}" for i in range(1 + len(self.below))]]
            gone = self.spark.createDataFrame(dead, ", ".join(f"{n} string" for n in names))
            same = [F.col(_GROUP) == F.col(names[0])] + [
                F.col(c).cast("string").eqNullSafe(F.col(n)) for c, n in zip([self.day, *self.below], names[1:])]
            frame = frame.join(F.broadcast(gone), same, "left_anti")
        return frame.select(*schema.fieldNames())


def is_table(spark: SparkSession, path: str) -> bool:
    return bool(_Files(spark, path).names("_snapshots"))
