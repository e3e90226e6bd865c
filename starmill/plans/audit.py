"""The contract of a published mart, checked by reading only files no earlier audit has read (K1-K5).

An audit keeps what it found out about every file of the fact: how many rows violate each test (K2, K4),
and how many carry each foreign-key value (K3). Sums over files give the fact's counts, and only values,
not rows, meet the dimensions. Rows that are deleted later can end a violation but not begin one, so a
file without violations need not be read again however many of its rows are deleted; one with violations
is read again if rows were deleted since. For K1 the keys of new files are compared among themselves and
with the files that may hold one of them, by range and key filter. Dimensions are small and written whole
by each load; they are checked whole.

Layout under ``<root>/<mart>/audits/<fact>-<contract>/``: folders of tables, and small files ``<n>`` that name
the folder of audit n. The state only saves work: without it, or under another contract, all files are
read. Of two audits at one time the state of one stays. The state of the audit before the newest is kept
for results that are still to be read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmill.contracts import Table
from starmill.operators import checks
from starmill.plans.loads import Mart
from starmill.sources import shared
from starmill.sources.filters import FILE
from starmill.sources.manifest import Data
from starmill.sources.warehouse import Warehouse

COUNTS, VALUES, REPEATED = "counts", "values", "repeated"


@dataclass(frozen=True)
class _State:
    """Tables of an audit: (file, deleted, constraint, column, n_violations, sample_key), (file, column,
    value, n_rows), and the keys that more than one row has."""

    number: int
    folder: str | None
    counts: DataFrame
    values: DataFrame
    repeated: DataFrame

    def known(self) -> dict[str, int]:
        """Files that were read, and how many of their rows were deleted then."""
        return {r[FILE]: r.deleted for r in self.counts.select(FILE, "deleted").distinct().collect()}


class Auditor:
    """Audits of one fact under one list of row tests."""

    def __init__(self, warehouse: Warehouse, table: Table, dims: Mapping[str, DataFrame], tests: list[checks.Test] | None = None):
        self.warehouse, self.spark, self.table, self.dims = warehouse, warehouse.spark, table, dims
        self.tests = checks.declared_tests(table) if tests is None else tests
        self.refs = checks.references(table, dims)
        contract = hashlib.sha256(repr((table.key, self.tests, sorted(self.refs.items()))).encode()).hexdigest()[:16]
        self.base = f"{warehouse.base}/audits/{warehouse.config.table(table.name)}-{contract}"

    def audit(self) -> DataFrame:
        """K1-K4 of the fact, a row for each constraint, as ``checks`` counts them on all its rows."""
        state = self._advanced()
        nothing = checks.tally(self.warehouse.nothing(self.table), self.table.key, self.tests)
        counted = nothing.unionByName(state.counts.drop(FILE, "deleted")).groupBy("constraint", "column")
        rows = counted.agg(F.sum("n_violations").alias("n_violations"), F.min("sample_key").cast("string").alias("sample_key"))
        used = state.values.groupBy("column", "value").agg(F.sum("n_rows").alias("n_rows"))
        orphaned = checks.unknown_values(used, self.table, self.dims)
        found = [checks.count_repeated(state.repeated, self.table.key), rows, checks.count_references(orphaned, list(self.refs))]
        return reduce(DataFrame.unionByName, found)

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in shared.children(self.spark, self.base) if n.isdigit())

    def _named(self, number: int) -> str | None:
        """Folder of an audit; None if its name was not written to the end."""
        text = shared.read_text(self.spark, f"{self.base}/{number}") or ""
        return text.strip() if text.endswith("\n") else None

    def _newest(self) -> _State:
        numbers = self._numbers()
        for number in reversed(numbers):
            if folder := self._named(number):
                return self._state(numbers[-1], folder)
        columns = [F.lit(None).cast("string").alias(FILE), F.lit(0).cast("long").alias("deleted")]
        nothing = self.warehouse.nothing(self.table).select(*columns, *self.table.names)
        counts = checks.tally(nothing, self.table.key, self.tests, [FILE, "deleted"])
        values = checks.referring_values(nothing, self.table, self.dims, [FILE])
        return _State(numbers[-1] if numbers else 0, None, counts, values, nothing.select(self.table.key))

    def _state(self, number: int, folder: str) -> _State:
        return _State(number, folder, *[self.spark.read.parquet(f"{folder}/{name}") for name in (COUNTS, VALUES, REPEATED)])

    def _stale(self, state: _State, changed: Sequence[str]) -> set[str]:
        """Of files with rows deleted since they were read, those with a violation then or by now. At most
        one name per file comes to the driver."""
        if not changed:
            return set()
        violating = state.counts.filter("n_violations > 0").select(FILE)
        orphaned = checks.unknown_values(state.values, self.table, self.dims).select(FILE)
        found = violating.union(orphaned).distinct().join(self._names(changed), FILE, "left_semi")
        return {r[FILE] for r in found.collect()}

    def _names(self, names: Sequence[str]) -> DataFrame:
        return self.spark.createDataFrame([(n,) for n in names], f"{FILE} STRING")

    def _advanced(self) -> _State:
        """The state of the published files: what is known of them, and the others read."""
        state, files = self._newest(), {d.name: d for d in self.warehouse.files(self.table)}
        known = state.known()
        unread = [d for name, d in files.items() if name not in known]
        changed = [name for name, d in files.items() if name in known and known[name] != d.deleted]
        stale = self._stale(state, changed)
        fresh = [*unread, *[files[name] for name in sorted(stale)]]
        kept = [name for name in files if name in known and name not in stale]
        repeated = not state.repeated.isEmpty()
        if not fresh and not repeated and len(kept) == len(known) and state.folder:
            return state
        columns = list(dict.fromkeys([self.table.key, *[column for _, column, _ in self.tests], *self.refs]))
        counts, values = ([t.join(F.broadcast(self._names(kept)), FILE, "left_semi")] if kept else [] for t in (state.counts, state.values))
        if fresh or not kept:
            rows = self._read(fresh, columns)
            counts.append(checks.tally(rows, self.table.key, self.tests, [FILE, "deleted"]))
            values.append(checks.referring_values(rows, self.table, self.dims, [FILE]))
        held = [d for name, d in files.items() if name in known]
        tables = {
            COUNTS: reduce(DataFrame.unionByName, counts),
            VALUES: reduce(DataFrame.unionByName, values),
            REPEATED: self._repeated(state, unread, held, repeated),
        }
        return self._write(state.number + 1, tables)

    def _read(self, files: Sequence[Data], columns: Sequence[str]) -> DataFrame:
        """Live rows of files with their file and how many of its rows are deleted."""
        if not files:
            place = [F.lit(None).cast("string").alias(FILE), F.lit(0).cast("long").alias("deleted")]
            return self.warehouse.nothing(self.table).select(*place, *columns)
        deleted = self.spark.createDataFrame([(d.name, d.deleted) for d in files], f"{FILE} STRING, deleted LONG")
        return self.warehouse.placed(self.table, files, columns).join(F.broadcast(deleted), FILE)

    def _repeated(self, state: _State, unread: Sequence[Data], held: Sequence[Data], before: bool) -> DataFrame:
        """Keys of more than one live row (K1): such keys are those of files not read so far, or were
        repeated before, so other files matter only where they may hold one of these."""
        key, none = self.table.key, self.warehouse.nothing(self.table).select(self.table.key)
        new = self.warehouse.placed(self.table, unread, [key]).select(key) if unread else none
        asked = new.unionByName(state.repeated) if before else new
        rows = new
        if held and (unread or before):
            low, high, n = asked.agg(F.min(key), F.max(key), F.count("*")).first()
            if near := self.warehouse.holding(self.table, held, asked, n, low, high):
                others = self.warehouse.placed(self.table, near, [key]).select(key)
                rows = new.unionByName(others.join(asked, key, "left_semi"))
        return checks.repeated_keys(rows, key)

    def _write(self, number: int, tables: dict[str, DataFrame]) -> _State:
        folder = shared.unused(f"{self.base}/state")
        for name, rows in tables.items():
            rows.write.parquet(f"{folder}/{name}")
        if shared.create_text(self.spark, f"{self.base}/{number}", f"{folder}\n"):
            for old in self._numbers():
                if old < number - 1:
                    if own := self._named(old):
                        shared.discard(self.spark, own)
                    shared.discard(self.spark, f"{self.base}/{old}")
        return self._state(number, folder)


def audit(warehouse: Warehouse, mart: Mart) -> DataFrame:
    """The whole contract of a published mart, row for row what ``checks.audit`` finds."""
    dims = {t.name: warehouse.read(t) for t in mart.dims}
    found = [Auditor(warehouse, mart.fact, dims).audit()]
    for table in mart.dims:
        found += [checks.check_unique(dims[table.name], table.key), checks.check_rows(dims[table.name], table)]
    return reduce(DataFrame.unionByName, found)
