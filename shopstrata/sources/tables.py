"""Stored tables: Parquet directories with a pointer to the current set of partitions.

A replaced partition is written under a new snapshot number beside the old one; a small
pointer file then names the directories that make up the table.  Readers therefore never
see half a write, a failed job leaves the table as it was, and no path is overwritten while
it is being read.  Only partitions that change are rewritten, emptied ones are dropped.

    <root>/<table>/snap=<n>/part=<period>/*.parquet
    <root>/<table>/_pointer/<n>.json        {"parts": {"2026-09": {"base": "<n>", "deltas": [...]}}}

A small merge writes no partition anew.  It adds a delta: the rows that change, filed by their
period, and a mark in the period that a row has left.  Readers put deltas over the base by key;
``compact`` makes a base of both.  An index of (key, filing date, update time), filed by a hash of
the key in layers of its own, tells a merge which stored version a row meets without reading a
single partition.  Partitions, deltas and index change together with the pointer.

Append-only tables are filed by period below a directory for each append, which counts from the
moment its entry is published, as a whole or not at all:

    <root>/<table>/rows/add=<id>/part=<period>/*.parquet
    <root>/<table>/_log/<id>.json           {"dir": "add=<id>", "parts": [...]}
    <root>/<table>/_log/merged-<n>.json     the same, and the entries that it stands for

Appends never wait for each other and never share a directory.  An append that is given a name
happens once, however often it is tried.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from datetime import date
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import BROADCAST_ROWS
from ..operators.merge import latest_by_key
from ..schemas import TABLES, TableSpec, conform

Result = TypeVar("Result")

#: Date patterns of a partition period, by grain.
GRAINS = {"day": ("yyyy-MM-dd", "%Y-%m-%d"), "month": ("yyyy-MM", "%Y-%m"), "year": ("yyyy", "%Y")}
WHOLE = "all"
#: Up to this many periods rows are written without being moved to tasks by period first.
FEW_PARTS = 4
UNDATED = "undated"
#: A period is made anew from its base and deltas when it has more deltas, or (beyond some rows) a larger share of rows in them.
MOST_DELTAS, DELTA_SHARE, FEW_ROWS = 8, 0.25, 10_000
#: Keys in one bucket of an index, and layers after which a bucket is written as one.
BUCKET_KEYS, MOST_LAYERS = 1_000_000, 8
#: Columns of a delta beside the table's: its number, whether the row has left the period, the period, the date before.
SEQ, GONE, PART, OLD_DAY = "_seq", "_gone", "_part", "_old_day"
#: Columns of an index beside the key: filing date, update time.
DAY, TS, BUCKET = "_day", "_ts", "bucket"


DELTA_FIELDS = [
    T.StructField(SEQ, T.LongType()), T.StructField(GONE, T.BooleanType()), T.StructField(PART, T.StringType()),
    T.StructField(OLD_DAY, T.DateType()),
]


class ConcurrentWrite(RuntimeError):
    """Another writer has replaced the table in the meantime."""


class _Files:
    """The few file-system calls needed, on whatever file system the root lives on."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Create ``path`` with its full content, or fail if it exists."""
        folder, name = path.rsplit("/", 1)
        self._fs.mkdirs(self._path(folder))
        draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(draft), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        try:
            self._context.rename(self._path(draft), self._path(path), self._no_options)
        except Exception as problem:
            self._fs.delete(self._path(draft), False)
            raise ConcurrentWrite(path) from problem

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@dataclass(frozen=True)
class Part:
    """A period: its base directory, the deltas over it in their order, and how many rows they hold."""

    base: str | None = None
    deltas: tuple[str, ...] = ()
    rows: int = 0
    delta_rows: int = 0
    #: What a derived period was made from, in words of its maker.
    made_from: str = ""

    @staticmethod
    def of(value: str | dict) -> Part:
        if isinstance(value, str):
            return Part(value)
        return Part(value["base"], tuple(value["deltas"]), value["rows"], value["delta_rows"], value.get("made_from", ""))

    @property
    def content(self) -> str:
        """Names the rows of a period: equal as long as nothing was merged into it."""
        return "+".join([self.base or "", *self.deltas])


@dataclass(frozen=True)
class Index:
    """Where keys are filed: for each bucket its layers, later ones over earlier ones."""

    buckets: int
    keys: int
    layers: dict[int, tuple[str, ...]]


@dataclass(frozen=True)
class _Pointer:
    number: int
    parts: dict[str, Part]
    index: Index | None = None

    def text(self) -> str:
        index = self.index and {**asdict(self.index), "layers": {str(b): list(x) for b, x in self.index.layers.items()}}
        return json.dumps({"parts": {p: asdict(x) for p, x in sorted(self.parts.items())}, "index": index})

    @staticmethod
    def of(number: int, text: str) -> _Pointer:
        held = json.loads(text)
        index = held.get("index")
        if index:
            index = Index(index["buckets"], index["keys"], {int(b): tuple(x) for b, x in index["layers"].items()})
        return _Pointer(number, {p: Part.of(x) for p, x in held["parts"].items()}, index or None)


@dataclass(frozen=True)
class Entries:
    """What an append-only table consists of: the last merged entry, if any, and the appends since."""

    merged: dict | None
    number: int
    appends: dict[str, dict]

    @property
    def all(self) -> list[dict]:
        return [*([self.merged] if self.merged else []), *self.appends.values()]


class Warehouse:
    """All tables below one root directory on a shared file system.

    ``grain`` is the period of a partition of dated tables: ``month`` by default, ``day``
    where a day holds many gigabytes.
    """

    def __init__(self, spark: SparkSession, root: str, *, grain: str = "month") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._spark_pattern, self._python_pattern = GRAINS[grain]
        self._files = _Files(spark, self.root)

    # ---- reading -------------------------------------------------------------------------

    def _dir(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _pointer(self, name: str) -> _Pointer:
        numbers = [int(n[:-5]) for n in self._files.names(f"{self._dir(name)}/_pointer") if n[:-5].isdigit()]
        return self._pointer_of(name, max(numbers)) if numbers else _Pointer(0, {})

    def _pointer_of(self, name: str, number: int) -> _Pointer:
        return _Pointer.of(number, self._files.read_text(f"{self._dir(name)}/_pointer/{number}.json"))

    def period(self, day: date) -> str:
        return day.strftime(self._python_pattern)

    def _load(self, spec: TableSpec, parts: dict[str, Part]) -> DataFrame:
        base = self._dir(spec.name)
        paths = [f"{base}/snap={x.base}/part={p}" for p, x in sorted(parts.items()) if x.base]
        rows = self.spark.read.schema(spec.schema).parquet(*paths) if paths else self.spark.createDataFrame([], spec.schema)
        changed = {p: x for p, x in parts.items() if x.deltas}
        if not changed:
            return rows
        # the last word on each key of a period; what the base says of it no longer counts
        last = latest_by_key(self._deltas(spec, changed), [PART, *spec.key], ts=SEQ)
        overruled = last.select(F.col(PART), *spec.key)
        if sum(x.delta_rows for x in changed.values()) <= BROADCAST_ROWS:
            overruled = F.broadcast(overruled)
        kept = rows.withColumn(PART, self.part_column(spec)).join(overruled, [PART, *spec.key], "left_anti")
        return kept.select(*spec.columns).unionByName(last.where(~F.col(GONE)).select(*spec.columns))

    def _deltas(self, spec: TableSpec, parts: dict[str, Part]) -> DataFrame:
        schema = T.StructType([*spec.schema.fields, *DELTA_FIELDS])
        paths = [f"{self._dir(spec.name)}/snap={n}/part={p}" for p, x in sorted(parts.items()) for n in x.deltas]
        return self.spark.read.schema(schema).parquet(*paths)

    @staticmethod
    def names() -> set[str]:
        return set(TABLES)

    def exists(self, name: str) -> bool:
        return bool(self._pointer(name).parts)

    def read(self, name: str, *, since: date | None = None, end: date | None = None) -> DataFrame:
        """A table, empty if nothing was written yet.

        ``since`` and ``end`` only choose which partitions are listed; rows outside the range
        may still come along from the first and last period.
        """
        spec = TABLES[name]
        parts = self._pointer(name).parts
        if since is not None:
            parts = {p: n for p, n in parts.items() if p >= self.period(since)}
        if end is not None:
            parts = {p: n for p, n in parts.items() if p <= self.period(end) or p == UNDATED}
        return self._load(spec, parts)

    def version(self, name: str) -> _Pointer:
        """The current state of a table; a write that is given it fails if another one came between."""
        return self._pointer(name)

    def read_at(self, name: str, at: _Pointer) -> DataFrame:
        return self._load(TABLES[name], at.parts)

    def read_parts(self, name: str, parts: Iterable[str], at: _Pointer | None = None) -> DataFrame:
        wanted = set(parts)
        held = (at or self._pointer(name)).parts
        return self._load(TABLES[name], {p: n for p, n in held.items() if p in wanted})

    def parts(self, name: str) -> list[str]:
        return sorted(self._pointer(name).parts)

    @staticmethod
    def retried(work: Callable[[], Result], tries: int = 10) -> Result:
        """``work`` reads a table and writes it back; it is done again while other writers come between."""
        for left in range(tries - 1, -1, -1):
            try:
                return work()
            except ConcurrentWrite:
                if not left:
                    raise
        raise AssertionError

    def part_column(self, spec: TableSpec):
        if spec.filed_as:
            return F.col(spec.filed_as)
        if not spec.dated_by:
            return F.lit(WHOLE)
        return self.period_column(spec.filing_date())

    def period_column(self, day):
        """The period that a date is filed under."""
        return F.coalesce(F.date_format(day, self._spark_pattern), F.lit(UNDATED))

    # ---- replacing -----------------------------------------------------------------------

    def replace(
        self, name: str, df: DataFrame, parts: Sequence[str] | None = None, *, at: _Pointer | None = None,
        made_from: Mapping[str, str] | None = None,
    ) -> None:
        """Replace ``parts`` (all by default) by the rows of ``df``.

        ``at`` is the version that ``df`` was made from; if the table has moved on since, nothing
        is published and ``ConcurrentWrite`` is raised.

        A partition of ``parts`` that ``df`` has no row for disappears.  Rows for many periods
        are rebalanced by period first, which splits a period that holds most of them over
        several files; for a few periods every task just writes to each of them.
        """
        spec = TABLES[name]
        before = at or self._pointer(name)
        attempt, target = self._attempt(name, before)
        filed = conform(df, spec.schema).withColumn("part", self.part_column(spec))
        if (spec.dated_by or spec.filed_as) and (parts is None or len(parts) > FEW_PARTS):
            filed = filed.hint("rebalance", "part")
        written = self._write_parts(filed, target, spec.merged_by_key)
        unexpected = [] if parts is None else sorted(set(written) - set(parts))
        if unexpected:
            raise ValueError(f"{name}: rows outside the replaced partitions: {unexpected[:5]}")
        kept = {} if parts is None else {p: x for p, x in before.parts.items() if p not in set(parts)}
        # an index is made anew by the next small merge; until then the partitions speak for themselves
        fresh = {p: Part(attempt, rows=n, made_from=(made_from or {}).get(p, "")) for p, n in written.items()}
        if made_from:  # a period without rows is still made from something
            fresh = {**{p: Part(made_from=text) for p, text in made_from.items()}, **fresh}
        self._publish(name, _Pointer(before.number + 1, {**kept, **fresh}))

    def _attempt(self, name: str, before: _Pointer) -> tuple[str, str]:
        attempt = f"{before.number + 1:06d}-{uuid.uuid4().int % 10**9:09d}"
        return attempt, f"{self._dir(name)}/snap={attempt}"

    def _write_parts(self, filed: DataFrame, target: str, counted: bool = True) -> dict[str, int]:
        """Writes rows filed by ``part``; the periods that have any, and how many (0 if not counted)."""
        filed.write.partitionBy("part").parquet(target)
        names = [n[5:] for n in self._files.names(target) if n.startswith("part=")]
        return {**dict.fromkeys(names, 0), **(self._rows_of(target) if counted and names else {})}

    def _rows_of(self, target: str) -> dict[str, int]:
        """Rows of each period, from the footers of its files."""
        schema = T.StructType([T.StructField("part", T.StringType())])
        return {r.part: r["count"] for r in self.spark.read.schema(schema).parquet(target).groupBy("part").count().collect()}

    def _publish(self, name: str, pointer: _Pointer) -> None:
        self._files.publish(f"{self._dir(name)}/_pointer/{pointer.number}.json", pointer.text())

    # ---- small merges ---------------------------------------------------------------------

    def index(self, name: str, at: _Pointer) -> _Pointer:
        """The pointer with an index of its keys; made from the key columns of all periods if there is none, or too coarse."""
        rows = sum(x.rows + x.delta_rows for x in at.parts.values())
        if at.index and at.index.keys <= 2 * BUCKET_KEYS * at.index.buckets:
            return at
        spec, buckets = TABLES[name], max(16, -(-rows // BUCKET_KEYS))
        attempt, _ = self._attempt(name, at)
        stored = self._load(spec, at.parts).select(*spec.key, spec.filing_date().alias(DAY), F.col("updated_at").alias(TS))
        layers = self._write_layer(name, stored.withColumn(SEQ, F.lit(at.number)), attempt, buckets)
        return replace(at, index=Index(buckets, rows, {b: (attempt,) for b in layers}))

    def bucket(self, spec: TableSpec, buckets: int):
        return F.pmod(F.xxhash64(*spec.bucket_key), F.lit(buckets)).cast("int")

    def _write_layer(self, name: str, rows: DataFrame, attempt: str, buckets: int) -> list[int]:
        target = f"{self._dir(name)}/_index/layer={attempt}"
        filed = rows.withColumn(BUCKET, self.bucket(TABLES[name], buckets)).repartition(BUCKET)
        filed.write.partitionBy(BUCKET).parquet(target)
        return [int(n.partition("=")[2]) for n in self._files.names(target) if n.startswith(BUCKET)]

    def read_index(self, name: str, at: _Pointer, buckets: Iterable[int]) -> DataFrame:
        """``key, _day, _ts, _seq`` of the keys in some buckets; of several rows of a key the highest ``_seq`` counts."""
        spec = TABLES[name]
        fields = [spec.schema[c] for c in spec.key]
        schema = T.StructType([
            *fields, T.StructField(DAY, T.DateType()), T.StructField(TS, spec.schema["updated_at"].dataType),
            T.StructField(SEQ, T.LongType()),
        ])
        paths = [
            f"{self._dir(name)}/_index/layer={n}/{BUCKET}={b}" for b in sorted(set(buckets)) for n in at.index.layers.get(b, ())
        ]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def with_index(self, name: str) -> _Pointer:
        """The current version with an index, published if it had to be made."""
        at = self._pointer(name)
        indexed = self.index(name, at)
        if indexed is at:
            return at
        try:
            self._publish(name, replace(indexed, number=at.number + 1))
        except ConcurrentWrite:
            return indexed  # good for the version it was made from
        return replace(indexed, number=at.number + 1)

    def put_delta(
        self, name: str, changes: DataFrame, at: _Pointer, before: Callable[[DataFrame], None] | None = None
    ) -> None:
        """Publish ``changes`` (table columns, ``_gone``, ``_part``, ``_old_day``) over the version ``at``, which has an index.

        ``before`` is given the delta as it was written, before any reader sees it.  A period without a
        base takes its rows as one.
        """
        spec = TABLES[name]
        attempt, target = self._attempt(name, at)
        number = at.number + 1
        columns = [*spec.columns, SEQ, GONE, PART, OLD_DAY]
        written = self._write_parts(changes.withColumn(SEQ, F.lit(number)).select(*columns, F.col(PART).alias("part")), target)
        delta = self._deltas(spec, {p: Part(deltas=(attempt,)) for p in written}) if written else changes.limit(0)
        parts = dict(at.parts)
        for p, n in written.items():
            held = parts.get(p)
            parts[p] = Part(attempt, rows=n) if held is None else replace(
                held, deltas=(*held.deltas, attempt), delta_rows=held.delta_rows + n
            )
        index = at.index
        if written:
            present = delta.where(~F.col(GONE))
            rows = present.select(*spec.key, spec.filing_date().alias(DAY), F.col("updated_at").alias(TS), SEQ)
            layers = dict(index.layers)
            for b in self._write_layer(name, rows, attempt, index.buckets):
                layers[b] = (*layers.get(b, ()), attempt)
            index = replace(index, keys=index.keys + sum(written.values()), layers=layers)
        if before and written:
            before(delta)
        self._publish(name, _Pointer(number, parts, index))

    def overdue(self, at: _Pointer) -> list[str]:
        """Periods whose deltas have grown too many or too large."""
        return sorted(
            p for p, x in at.parts.items()
            if len(x.deltas) > MOST_DELTAS or x.delta_rows > max(FEW_ROWS, DELTA_SHARE * x.rows)
        )

    def compact(self, name: str, parts: Iterable[str] | None = None) -> list[str]:
        """Make one base of base and deltas in ``parts`` (all that have deltas), and one layer of long index buckets.

        The rows stay as they are, so the index does.  If another writer comes between, nothing changes.
        """
        spec, at = TABLES[name], self._pointer(name)
        chosen = sorted(p for p, x in at.parts.items() if x.deltas and (parts is None or p in set(parts)))
        long = [b for b, x in (at.index.layers if at.index else {}).items() if len(x) > (MOST_LAYERS if parts is not None else 1)]
        if not chosen and not long:
            return []
        attempt, target = self._attempt(name, at)
        held, index = dict(at.parts), at.index
        if chosen:
            rows = self._load(spec, {p: at.parts[p] for p in chosen}).withColumn("part", self.part_column(spec))
            written = self._write_parts(rows.hint("rebalance", "part") if len(chosen) > FEW_PARTS else rows, target)
            held = {p: x for p, x in held.items() if p not in chosen} | {p: Part(attempt, rows=n) for p, n in written.items()}
        if long:
            last = latest_by_key(self.read_index(name, at, long), spec.key, ts=SEQ)
            self._write_layer(name, last, attempt, index.buckets)
            index = replace(index, layers={**index.layers, **{b: (attempt,) for b in long}})
        try:
            self._publish(name, _Pointer(at.number + 1, held, index))
        except ConcurrentWrite:
            return []
        return chosen

    def expire(self, name: str, keep: int = 2) -> int:
        """Delete directories and entries that none of the last ``keep`` versions needs."""
        base = self._dir(name)
        numbers = sorted(int(n[:-5]) for n in self._files.names(f"{base}/_pointer") if n[:-5].isdigit())
        gone = self._expire_log(name)
        recent = [self._pointer_of(name, n) for n in numbers[-keep:]]
        if not recent:
            return gone
        live = {f"snap={n}/part={p}" for at in recent for p, x in at.parts.items() for n in (x.base, *x.deltas) if n}
        live |= {
            f"_index/layer={n}/{BUCKET}={b}" for at in recent if at.index for b, x in at.index.layers.items() for n in x
        }
        for top, folders in (("", self._files.names(base)), ("_index/", self._files.names(f"{base}/_index"))):
            for folder in (n for n in folders if n.startswith(("snap=", "layer="))):
                if int(folder.partition("=")[2].partition("-")[0]) > numbers[-1]:
                    continue  # being written
                for part in (n for n in self._files.names(f"{base}/{top}{folder}") if "=" in n):
                    if f"{top}{folder}/{part}" not in live:
                        self._files.delete(f"{base}/{top}{folder}/{part}")
                        gone += 1
        for n in numbers[:-keep]:
            self._files.delete(f"{base}/_pointer/{n}.json")
        return gone

    # ---- append-only tables --------------------------------------------------------------

    def append(self, name: str, df: DataFrame, *, once: str | None = None) -> bool:
        """Add rows as one entry.  ``once`` names it: a later append of that name adds nothing and returns False."""
        spec, base = TABLES[name], self._dir(name)
        entry = once or uuid.uuid4().hex
        if once is not None and self._files.exists(f"{base}/_log/{entry}.json"):
            return False
        folder = f"add={uuid.uuid4().hex}"
        filed = conform(df, spec.schema).withColumn("part", self.part_column(spec))
        filed.write.partitionBy("part").parquet(f"{base}/rows/{folder}")
        parts = sorted(n[5:] for n in self._files.names(f"{base}/rows/{folder}") if n.startswith("part="))
        if not parts and once is None:
            self._files.delete(f"{base}/rows/{folder}")
            return True
        try:
            self._files.publish(f"{base}/_log/{entry}.json", json.dumps({"dir": folder, "parts": parts}))
        except ConcurrentWrite:
            self._files.delete(f"{base}/rows/{folder}")
            return False
        return True

    def entries(self, name: str) -> Entries:
        folder = f"{self._dir(name)}/_log"
        names = [n[:-5] for n in self._files.names(folder) if n.endswith(".json") and not n.startswith(".")]
        number = max((int(n[7:]) for n in names if n.startswith("merged-")), default=0)
        read = lambda n: json.loads(self._files.read_text(f"{folder}/{n}.json"))
        merged = read(f"merged-{number}") if number else None
        done = set(merged["absorbed"]) if merged else set()
        return Entries(merged, number, {n: read(n) for n in sorted(names) if not n.startswith("merged-") and n not in done})

    def read_log(self, name: str, *, since: date | None = None) -> DataFrame:
        """An append-only table, empty if nothing was written yet; ``since`` leaves out earlier periods."""
        return self._read_entries(name, self.entries(name).all, since)

    def read_summary(self, name: str) -> tuple[DataFrame | None, DataFrame]:
        """What the last merge made of the entries it stands for, if it did, and the rows appended since."""
        found = self.entries(name)
        summary = found.merged.get("summary") if found.merged else None
        if summary is None:
            return None, self._read_entries(name, found.all, None)
        return self.spark.read.parquet(f"{self._dir(name)}/rows/{summary}"), self._read_entries(name, [*found.appends.values()], None)

    def _read_entries(self, name: str, entries: Iterable[dict], since: date | None) -> DataFrame:
        spec = TABLES[name]
        least = "" if since is None else self.period(since)
        paths = [f"{self._dir(name)}/rows/{e['dir']}/part={p}" for e in entries for p in e["parts"] if p >= least]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        return self.spark.read.schema(spec.schema).parquet(*paths)

    def merge_log(
        self, name: str, resolve: Callable[[DataFrame], DataFrame] | None = None,
        summarise: Callable[[DataFrame], DataFrame] | None = None,
    ) -> bool:
        """Put all entries together in one, optionally ``resolve`` d to fewer rows of the same meaning.

        ``summarise`` makes a small table of all rows, kept beside them for ``read_summary``.  Appends go on
        meanwhile; if another merge comes first, this one changes nothing.
        """
        spec, base = TABLES[name], self._dir(name)
        found = self.entries(name)
        if not found.appends:
            return False
        label = f"{found.number + 1:06d}-{uuid.uuid4().hex}"
        rows = self._read_entries(name, found.all, None)
        rows = conform(resolve(rows) if resolve else rows, spec.schema)
        rows.withColumn("part", self.part_column(spec)).repartition("part").write.partitionBy("part").parquet(
            f"{base}/rows/add={label}"
        )
        entry = {
            "dir": f"add={label}", "absorbed": sorted({*found.appends, *(found.merged or {}).get("absorbed", ())}),
            "parts": sorted(n[5:] for n in self._files.names(f"{base}/rows/add={label}") if n.startswith("part=")),
        }
        if summarise:
            entry["summary"] = f"summary={label}"
            merged = self._read_entries(name, [entry], None)
            summarise(merged).coalesce(1).write.parquet(f"{base}/rows/{entry['summary']}")
        try:
            self._files.publish(f"{base}/_log/merged-{found.number + 1}.json", json.dumps(entry))
        except ConcurrentWrite:
            return False
        return True

    def _expire_log(self, name: str) -> int:
        """Directories of appends that a merged entry stands for.  Their names are kept, so no append happens twice."""
        base, found, gone = self._dir(name), self.entries(name), 0
        if found.merged is None:
            return 0
        live = {e["dir"] for e in found.all} | {found.merged.get("summary")}
        past = set(found.merged["absorbed"])
        named = {json.loads(self._files.read_text(f"{base}/_log/{n}.json"))["dir"] for n in past}
        named |= {
            x for n in range(1, found.number) if self._files.exists(f"{base}/_log/merged-{n}.json")
            for e in [json.loads(self._files.read_text(f"{base}/_log/merged-{n}.json"))] for x in (e["dir"], e.get("summary")) if x
        }
        for folder in self._files.names(f"{base}/rows"):
            if folder in named - live:
                self._files.delete(f"{base}/rows/{folder}")
                gone += 1
        return gone

    # ---- staging -------------------------------------------------------------------------

    def stage(self, df: DataFrame, label: str) -> Staged:
        """Write an intermediate result once and read it back, which cuts its lineage.

        It goes to the shared checkpoint directory of the session, so it outlives lost
        executors; where none is set, below the warehouse, which is shared as well.
        """
        shared = self.spark.conf.get("spark.checkpoint.dir", None) or f"{self.root}/_stage"
        path = f"{shared.rstrip('/')}/shopstrata-{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return Staged(self.spark.read.schema(df.schema).parquet(path), path, _Files(self.spark, path))


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    path: str
    files: _Files

    def drop(self) -> None:
        self.files.delete(self.path)
