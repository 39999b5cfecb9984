"""Tables as Parquet folders under a versioned manifest.

``data/segment=<id>/<date column>=<date>/`` folders are written once and never
changed.  A version is a file ``versions/<n>.json`` that lists the folders
("parts") of the table with their rows, first and last time and rows by hour.
Creating that file is the commit: until then a write has changed nothing, from
then on every new reader sees all of it, and readers of an earlier version go
on with the folders they have.  Folders that no kept version names are deleted
by :meth:`VersionedTable.vacuum`, later and separately.

The manifest holds a line for each date and segment, not for files or rows;
:meth:`VersionedTable.compact` brings it back to one a date.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import micros
from .files import Files

HOURS = 24


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version that this one was to be."""


@dataclass(frozen=True)
class Part:
    """One date folder of one segment: its rows and times (microseconds, UTC)."""
    path: str
    date: str | None
    rows: int
    first: int | None = None
    last: int | None = None
    hours: tuple[int, ...] = field(default=())

    @property
    def segment(self) -> str:
        return self.path.split("/")[1]


@dataclass
class VersionedTable:
    """``date`` and ``time``: names of the date folders' column and of the time column.

    ``sort``: order of rows within a file, after the date; ``bloom``: columns
    with a bloom filter in each file.
    """
    spark: SparkSession
    root: str
    schema: T.StructType
    date: str
    time: str
    sort: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    max_records_per_file: int = 5_000_000

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.files = Files(self.spark, self.root)

    # -------------------------------------------------------------- versions

    def version(self) -> int:
        """Number of the newest version; 0 before the first commit."""
        return max((int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json") and n[:-5].isdigit()),
                   default=0)

    def _manifest(self, version: int | None) -> dict:
        version = self.version() if version is None else version
        return json.loads(self.files.read(f"versions/{version}.json")) if version else {"parts": [], "note": {}}

    def parts(self, version: int | None = None) -> list[Part]:
        return [Part(**{**p, "hours": tuple(p["hours"])}) for p in self._manifest(version)["parts"]]

    def note(self, version: int | None = None) -> dict:
        """What writers have left with the version (such as how far they have come)."""
        return self._manifest(version)["note"]

    def commit(self, add: list[Part], remove: list[Part], base: int, note: dict | None = None) -> int:
        """Version ``base + 1``: the parts of ``base`` without ``remove`` and with ``add``; ``note`` adds to its note."""
        gone = {p.path for p in remove}
        kept = [p for p in self.parts(base) if p.path not in gone]
        if len(kept) != len(self.parts(base)) - len(gone):
            raise ConcurrentCommit("a part to be removed is not in the base version")
        text = json.dumps({"parts": [vars(p) for p in [*kept, *add]], "note": {**self.note(base), **(note or {})}})
        if not self.files.create(f"versions/{base + 1}.json", text):
            raise ConcurrentCommit(f"version {base + 1} of {self.root} exists")
        return base + 1

    # -------------------------------------------------------------- writing

    def stage(self, df: DataFrame, balance: bool = True) -> list[Part]:
        """Write ``df`` as a new segment, not yet part of the table, and return its parts.

        With ``balance`` rows of a date come together in as many files as their
        bytes need: a rebalance that the runtime plan splits for busy dates and
        merges for quiet ones, so the number of files follows bytes and not
        tasks times dates.
        """
        segment = f"data/segment={uuid.uuid4().hex[:12]}"
        out = df.select(*self.schema.names).withColumn(self.date, F.to_date(self.time))
        if balance:
            out = out.hint("rebalance", F.col(self.date))
        writer = (out.sortWithinPartitions(self.date, *self.sort).write.mode("error")
                  .option("maxRecordsPerFile", self.max_records_per_file))
        for column in self.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.partitionBy(self.date).parquet(f"{self.root}/{segment}")
        return self._measure(segment)

    def _measure(self, segment: str) -> list[Part]:
        """Rows and times of a written segment, from its time column alone."""
        hour = F.hour(self.time)
        written = self._scan([f"{self.root}/{segment}"])
        rows = written.groupBy(self.date).agg(
            F.count("*").alias("rows"), F.unix_micros(F.min(self.time)).alias("first"),
            F.unix_micros(F.max(self.time)).alias("last"),
            F.array(*[F.count_if(hour == h) for h in range(HOURS)]).alias("hours")).collect()   # a row a date
        names = {r[self.date]: "__HIVE_DEFAULT_PARTITION__" if r[self.date] is None else r[self.date].isoformat()
                 for r in rows}
        return [Part(f"{segment}/{self.date}={names[r[self.date]]}",
                     None if r[self.date] is None else r[self.date].isoformat(),
                     r["rows"], r["first"], r["last"], tuple(r["hours"]))
                for r in sorted(rows, key=lambda r: str(r[self.date]))]

    def append(self, df: DataFrame, note: dict | None = None) -> int:
        """Add rows: written first, committed on top of whatever the newest version is then."""
        parts = self.stage(df)
        while True:
            base = self.version()
            try:
                return self.commit(parts, [], base, note)
            except ConcurrentCommit:
                if self.version() == base:
                    raise

    # -------------------------------------------------------------- reading

    def _scan(self, paths: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("segment", T.StringType()),
                               T.StructField(self.date, T.DateType())])
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/data")
                .parquet(*paths).drop("segment"))

    def of_parts(self, parts: list[Part]) -> DataFrame:
        """Rows of some parts, with the date column."""
        if not parts:
            empty = T.StructType([*self.schema.fields, T.StructField(self.date, T.DateType())])
            return self.spark.createDataFrame([], empty)
        return self._scan([f"{self.root}/{p.path}" for p in parts])

    def read(self, version: int | None = None, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """The table, or the parts of it that can hold rows from ``start`` to ``end``.

        The manifest's times choose the folders, the date predicate prunes
        partitions and the time predicate reaches the row groups.
        """
        parts = self.parts(version)
        if start is not None:
            parts = [p for p in parts if p.last is not None and p.last >= micros(start)]
        if end is not None:
            parts = [p for p in parts if p.first is not None and p.first <= micros(end)]
        df = self.of_parts(parts)
        for bound, op in ((start, ">="), (end, "<=")):
            if bound is not None:
                day, at = F.lit(bound.date()), F.lit(bound).cast("timestamp")
                df = df.where((F.col(self.date) >= day) & (F.col(self.time) >= at) if op == ">="
                              else (F.col(self.date) <= day) & (F.col(self.time) <= at))
        return df

    # -------------------------------------------------------------- upkeep

    def compact(self, least_parts: int = 2) -> int:
        """Rewrite dates of ``least_parts`` or more parts as one part each; return the version."""
        base = self.version()
        by_date: dict[str | None, list[Part]] = {}
        for p in self.parts(base):
            by_date.setdefault(p.date, []).append(p)
        old = [p for ps in by_date.values() if len(ps) >= least_parts for p in ps]
        if not old:
            return base
        return self.commit(self.stage(self.of_parts(old)), old, base)

    def vacuum(self, keep_versions: int = 1, least_age_seconds: float = 86_400) -> list[str]:
        """Delete versions but the newest ``keep_versions``, and folders that none of these names.

        Folders younger than ``least_age_seconds`` stay, since a writer may be about to
        commit them.  Returns the deleted folders.
        """
        newest = self.version()
        kept = [n for n in range(max(1, newest - keep_versions + 1), newest + 1)]
        named = {p.path for n in kept for p in self.parts(n)}
        before = time.time() * 1000 - least_age_seconds * 1000
        gone = []
        for segment in self.files.names("data"):
            folders = [f for f in self.files.names(f"data/{segment}") if "=" in f]
            old = [p for p in (f"data/{segment}/{f}" for f in folders)
                   if p not in named and self.files.modified(p) <= before]
            for path in old:
                self.files.delete(path)
            if len(old) == len(folders) and (old or self.files.modified(f"data/{segment}") <= before):
                self.files.delete(f"data/{segment}")
            gone += old
        for name in self.files.names("versions"):
            if name[:-5].isdigit() and int(name[:-5]) not in kept and int(name[:-5]) <= newest:
                self.files.delete(f"versions/{name}")
        return gone

