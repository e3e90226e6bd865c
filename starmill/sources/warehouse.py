"""Versioned Parquet tables with all-or-nothing publishing.

Layout under ``<root>/<mart>/``::

    manifest/run=<n>/     the data that makes up every table as of run n, see ``manifest``
    <table>/v<n>-<id>/    data written by run n

A run writes new folders only, then one list that names the data of all tables. The list becomes
visible in one step that fails if that run number is taken. So readers see the whole run or nothing of
it, and a run that dies leaves folders nobody reads and blocks nothing. Of two runs that start together
one is published; the other takes its changes over to the newer tables (``Run.again``) and follows.

The fact is a set of files of about ``rows_per_file`` rows. A load finds the files that hold a key of
its batch by three steps, each of which reads only what the one before let pass: ranges in the
manifest, key filters (``filters``), the key column. Replaced rows are deleted by position and the
batch is written beside them; only files with less than half their rows left are written anew, as are
the emptiest where a limit is set (``max_deletes``) and a reader would have to know more positions.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from starmill.config import MartConfig
from starmill.contracts import Table
from starmill.sources import codes, filters, shared
from starmill.sources.filters import FILE, ROW
from starmill.sources.manifest import Data, Listing, Manifest, Part


class RunTaken(RuntimeError):
    """Another run was published first; this one is not, and can go on with ``again``."""


class Warehouse:
    """The published tables of one mart."""

    def __init__(self, spark: SparkSession, config: MartConfig):
        self.spark = spark
        self.config = config
        self.base = f"{config.root}/{config.mart}"
        self.manifest = Manifest(spark, self.base, config.commit)

    def published(self) -> tuple[int, Listing]:
        """Newest complete run and its list."""
        return self.manifest.newest()

    def files(self, table: Table) -> tuple[Data, ...]:
        """Files of the published fact."""
        _, listing = self.published()
        return tuple(self.manifest.entries(listing.parts.get(self.config.table(table.name), ())))

    def folder(self, name: str) -> str | None:
        """Folder of a published table, also of one that no contract describes."""
        _, listing = self.published()
        return listing.folders.get(self.config.table(name))

    def read(self, table: Table) -> DataFrame:
        """The published rows of a table; empty before the first run."""
        _, listing = self.published()
        name = self.config.table(table.name)
        if name in listing.folders:
            return self.whole(table, listing.folders[name])
        return self.scan(table, self.manifest.entries(listing.parts.get(name, ())))

    def whole(self, table: Table, folder: str) -> DataFrame:
        return self.spark.read.schema(table.schema).parquet(folder)

    def nothing(self, table: Table) -> DataFrame:
        return self.spark.range(0).select(*[F.lit(None).cast(c.dtype).alias(c.name) for c in table.columns])

    def scan(self, table: Table, files: Sequence[Data]) -> DataFrame:
        """Live rows of files of a fact. Files without deleted rows are read as they are."""
        intact = [d.path for d in files if not d.deletes]
        others = [d for d in files if d.deletes]
        found = []
        if intact:
            found.append(self.spark.read.schema(table.schema).parquet(*intact))
        if others:
            found.append(self.placed(table, others, table.names).select(*table.names))
        if not found:
            return self.nothing(table)
        return found[0].unionByName(found[1]) if len(found) > 1 else found[0]

    def placed(self, table: Table, files: Sequence[Data], columns: Sequence[str]) -> DataFrame:
        """Live rows with the file and position of each. Rows stay in their tasks, where bitmaps of the
        deleted positions, at most a bit for each row, are looked up."""
        fields = T.StructType([f for f in table.schema if f.name in columns])
        place = [F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(ROW)]
        rows = self.spark.read.schema(fields).parquet(*[d.path for d in files]).select(*columns, *place)
        if deletes := sorted({path for d in files for path in d.deletes}):
            gone = self.spark.read.schema(f"{FILE} STRING, {ROW} LONG").parquet(*deletes)
            rows = filters.marked(rows, filters.mark(gone), inside=False)
        return rows

    def holding(self, table: Table, files: Sequence[Data], keys: DataFrame, rows: int, low: int, high: int) -> list[Data]:
        """Files that may hold a key of ``rows`` rows, by range and then by filter."""
        near = [d for d in files if d.first <= high and d.last >= low]
        if near and rows <= filters.LOOKED_UP:
            by_size: dict[int, list[Data]] = {}
            for d in near:
                by_size.setdefault(_buckets(d), []).append(d)
            near = [d for n, own in by_size.items() for d in filters.may_hold(self.spark, own, keys, table.key, n)]
        return near

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the last ``keep`` runs: their lists, and data that only they or failed runs
        wrote. Data of a run that may still be in progress, which has a higher number than any
        published one, stays. Call when no reader is older than the runs kept."""
        kept: list[tuple[int, Listing]] = []
        runs = self.manifest.runs()
        for run in runs:
            if len(kept) < keep and (listing := self.manifest.listing(run)) is not None:
                kept.append((run, listing))
        if not kept:
            return []
        newest, oldest = kept[0][0], kept[-1][0]
        used: set[str] = set()
        for _, listing in kept:
            parts = [p for own in listing.parts.values() for p in own]
            entries = self.manifest.entries(parts)
            used.update(listing.folders.values(), (p.path for p in parts), (d.path for d in entries))
            used.update((path for d in entries for path in d.deletes), (d.filter for d in entries if d.filter))
        used = {shared.place(p) for p in used}
        with_used = {p.rsplit("/", 1)[0] for p in used}
        dead = [self.manifest.path(run) for run in runs if run < oldest]
        for table in shared.children(self.spark, self.base):
            for name in shared.children(self.spark, f"{self.base}/{table}"):
                written = re.fullmatch(r"v(\d+)-\w+", name)
                path = f"{self.base}/{table}/{name}"
                if not written or int(written[1]) > newest or shared.place(path) in used:
                    continue
                if shared.place(path) in with_used:
                    files = [f"{path}/{f}" for f in shared.children(self.spark, path) if f.endswith(".parquet")]
                    dead += [f for f in files if shared.place(f) not in used]
                else:
                    dead.append(path)
        for path in dead:
            shared.discard(self.spark, path)
        return sorted(dead)

    def start(self, rebuild: bool = False) -> Run:
        """Begin a run on top of the published tables, or of none of them.

        Its number is above that of any list found, also of one that was never completed.
        """
        _, listing = self.published()
        return Run(self, max(self.manifest.runs(), default=0) + 1, Listing() if rebuild else listing, rebuild)


@dataclass(frozen=True)
class Change:
    """What a batch does to the files of a fact, told apart from the state it was worked out on."""

    low: int
    high: int
    known: frozenset[str] = frozenset()  # files whose keys were looked up
    removed: tuple[Data, ...] = ()  # files written anew, or without a row left
    hits: dict[str, int] = field(default_factory=dict)  # other files, and how many of their rows are replaced
    replaced: str | None = None  # table of the replaced rows with their positions
    added: tuple[Data, ...] = ()


class Run:
    """One load: writes data, then publishes it together."""

    def __init__(self, warehouse: Warehouse, number: int, listing: Listing, rebuild: bool = False):
        self.warehouse = warehouse
        self.config = warehouse.config
        self.manifest = warehouse.manifest
        self.number = number
        self.before = listing
        self.rebuild = rebuild
        self.folders = dict(listing.folders)
        self.parts = dict(listing.parts)
        self.changes: dict[str, Change] = {}
        self.earlier: dict[str, Change] = {}
        self.tag = f"v{number}-{uuid.uuid4().hex[:8]}"

    def again(self) -> Run:
        """The same run on top of what has been published since, with the changes worked out so far."""
        run = self.warehouse.start(self.rebuild)
        run.earlier = self.earlier | self.changes
        return run

    def current(self, table: Table) -> DataFrame | None:
        """Rows of a whole table before this run; None if there is no table."""
        folder = self.before.folders.get(self.config.table(table.name))
        return None if folder is None else self.warehouse.whole(table, folder)

    def write(self, table: Table, df: DataFrame) -> DataFrame:
        """Write a whole table and read it back."""
        return self.warehouse.whole(table, self.write_side(table.name, df.select(*table.names)))

    def write_side(self, name: str, df: DataFrame) -> str:
        """Write rows that no contract describes, such as rejects; the folder is part of the run."""
        path = self._path(name)
        df.write.option("compression", shared.COMPRESSION).parquet(path)
        self.folders[self.config.table(name)] = path
        return path

    def merge(
        self, table: Table, batch: DataFrame, rows: int, measures: Sequence[str] = (), dims: Mapping[str, DataFrame] | None = None
    ) -> Change:
        """Update or insert the ``rows`` rows of a written batch by key. The rows they replace are kept
        with their position, key and ``measures``. Names of written ``dims`` move as numbers."""
        name = self.config.table(table.name)
        earlier = self.earlier.get(name)
        if earlier and self._still_holds(table, earlier, batch, rows):
            change = earlier
        else:
            change = self._merged(table, batch, rows, measures, dims or {})
        self.changes[name] = change
        self.parts[name] = self._applied(name, change)
        return change

    def publish(self) -> int:
        """Make the run visible. Raises ``RunTaken`` if a run of this number is there already."""
        if not self.manifest.commit(self.number, Listing(self.folders, self.parts)):
            raise RunTaken(f"run {self.number} of {self.warehouse.base} was published by another load")
        return self.number

    def _path(self, name: str) -> str:
        return f"{self.warehouse.base}/{self.config.table(name)}/{self.tag}"

    @property
    def _half(self) -> int:
        return self.config.rows_per_file // 2

    def _parts(self, name: str, low: int, high: int) -> list[Part]:
        """Parts that may know a file of these keys, or that have a file or themselves half empty."""
        half = self.config.entries_per_part // 2
        return [p for p in self.before.parts.get(name, ()) if p.meets(low, high) or p.least < self._half or p.files < half]

    def _merged(
        self, table: Table, batch: DataFrame, rows: int, measures: Sequence[str], dims: Mapping[str, DataFrame]
    ) -> Change:
        name, key, spark = self.config.table(table.name), table.key, self.warehouse.spark
        low, high = batch.agg(F.min(key), F.max(key)).first()
        if low is None:
            return Change(0, 0)
        known = self.manifest.entries(self._parts(name, low, high))
        near = self.warehouse.holding(table, known, batch, rows, low, high)
        replaced, counts = None, {}
        if near:
            replaced = self._path(f"{table.name}_replaced")
            columns = [key, *table.insert_only, *[m for m in measures if m not in (key, *table.insert_only)]]
            met = self.warehouse.placed(table, near, [key]).join(batch.select(key), key, "left_semi")
            hit = filters.marked(self.warehouse.placed(table, near, columns), filters.mark(met))
            hit.write.option("compression", shared.COMPRESSION).parquet(replaced)
            gone = spark.read.parquet(replaced)
            counts = {r[FILE]: r["count"] for r in gone.groupBy(FILE).count().collect()}
        left = {d.path: d.live - counts.get(d.name, 0) for d in known}
        removed = {d.path: d for d in known if left[d.path] < self._half}
        deleted, most = sum(p.deleted for p in self.before.parts.get(name, ())) + sum(counts.values()), self.config.max_deletes
        for d in sorted(known, key=lambda d: left[d.path] / d.rows):
            if most is None or deleted <= most:
                break
            if left[d.path] < d.rows:
                removed[d.path] = d
                deleted -= d.rows - left[d.path]
        incoming = batch
        if counts and table.insert_only:
            kept = gone.select(key, *[F.col(c).alias(f"_kept_{c}") for c in table.insert_only])
            columns = [F.coalesce(f"_kept_{c}", c).alias(c) if c in table.insert_only else F.col(c) for c in batch.columns]
            incoming = batch.join(kept, key, "left").select(*columns)
        moved = [d for d in removed.values() if left[d.path]]
        if moved:
            stay = self.warehouse.placed(table, moved, table.names)
            if counts:
                stay = filters.marked(stay, filters.mark(gone), inside=False)
            incoming = incoming.unionByName(stay.select(*incoming.columns))
        return Change(
            low,
            high,
            frozenset(left),
            tuple(removed.values()),
            {d.path: counts[d.name] for d in known if d.name in counts and d.path not in removed},
            replaced,
            self._write_files(table, incoming, rows + sum(left[d.path] for d in moved), dims),
        )

    def _write_files(
        self, table: Table, df: DataFrame, rows: int, dims: Mapping[str, DataFrame] | None = None
    ) -> tuple[Data, ...]:
        """Write rows in ranges of the key, then read their keys once for ranges, counts and filters."""
        if not rows:
            return ()
        path, filter_path, key = self._path(table.name), self._path(f"{table.name}_filter"), table.key
        files = -(-rows // self.config.rows_per_file)
        df = df.select(*table.names)
        if files > 1:
            names = codes.of(table, dims or {})
            dealt = names.restored(names.shortened(df).repartitionByRange(files, key))
        else:
            dealt = df.repartition(1)
        dealt.sortWithinPartitions(key).write.option("compression", shared.COMPRESSION).parquet(path)
        written = self.warehouse.spark.read.schema(table.schema).parquet(path).select(key, F.col("_metadata.file_name").alias(FILE))
        n = filters.buckets(self.config.rows_per_file)
        made = filters.build(written, key, n).sortWithinPartitions("bucket")
        made.write.option("compression", "zstd").parquet(f"{filter_path}/{n}")
        stats = self.warehouse.spark.read.parquet(f"{filter_path}/{n}").groupBy(FILE)
        found = stats.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("rows").alias("rows")).collect()
        return tuple(Data(f"{path}/{r[FILE]}", r["first"], r["last"], r.rows, filter=f"{filter_path}/{n}") for r in found)

    def _still_holds(self, table: Table, change: Change, batch: DataFrame, rows: int) -> bool:
        """Whether a change worked out on an older state can be applied to this one: the files it
        rewrote are as they were, those it deletes from are there, and no other file has its keys."""
        if not change.added:
            return True
        name = self.config.table(table.name)
        now = {d.path: d for d in self.manifest.entries(self._parts(name, change.low, change.high))}
        if any(now.get(d.path) != d for d in change.removed) or any(path not in now for path in change.hits):
            return False
        new = [d for path, d in now.items() if path not in change.known]
        near = self.warehouse.holding(table, new, batch, rows, change.low, change.high)
        if not near:
            return True
        return self.warehouse.placed(table, near, [table.key]).join(batch.select(table.key), table.key, "left_semi").isEmpty()

    def _applied(self, name: str, change: Change) -> tuple[Part, ...]:
        """Parts after a change: those with a changed entry, or less than half full, are written anew."""
        parts = self.before.parts.get(name, ())
        if not change.added and not change.removed and not change.hits:
            return parts
        removed, loaded = {d.path for d in change.removed}, self._parts(name, change.low, change.high)
        entries = self.manifest.by_part(loaded)
        half = self.config.entries_per_part // 2
        anew = [p for p, own in entries.items() if p.files < half or any(d.path in removed or d.path in change.hits for d in own)]
        files = [d for p in anew for d in entries[p] if d.path not in removed]
        files = [d.without(change.hits[d.path], change.replaced) if d.path in change.hits else d for d in files]
        folder = f"{self.warehouse.base}/parts/{self.tag}"
        written = self.manifest.write_parts([*files, *change.added], folder, self.config.entries_per_part)
        return (*[p for p in parts if p not in anew], *written)


def _buckets(d: Data) -> int:
    """Bitmaps of a file's filter, which its table is named after."""
    return int(d.filter.rsplit("/", 1)[-1]) if d.filter else 1
