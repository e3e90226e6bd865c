"""Names as short numbers while whole rows move between tasks.

A row of a fact is half names, and an exchange sends each of them in full. A column whose dimension has up
to ``LOOKED_UP`` names crosses as a number instead, and the numbers of a row as few 64-bit ones. A name that
has no number, and any column of a larger dimension, crosses as it is. So no row depends on what the
dimension knows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starmill.contracts import Table

# Names of a column that are broadcast at most.
LOOKED_UP = 1 << 16
_NUMBER, _NAME, _WORD = "_number_of_", "_name_of_", "_word"


@dataclass(frozen=True)
class Codes:
    """By column, (name, number) with numbers from 1 and how many numbers there are with 0, for none."""

    names: dict[str, DataFrame]
    sizes: dict[str, int]

    def places(self) -> dict[str, tuple[int, int]]:
        """By column, the word its number is part of, and what the number is multiplied by there."""
        found, word, factor = {}, 0, 1
        for c, size in self.sizes.items():
            if factor * size >= 1 << 63:
                word, factor = word + 1, 1
            found[c] = word, factor
            factor *= size
        return found

    def shortened(self, rows: DataFrame) -> DataFrame:
        """Rows with words of numbers; a coded column is NULL where its number stands for it."""
        out = rows
        for c, known in self.names.items():
            own = known.select(F.col("name").alias(_NAME + c), F.col("number").alias(_NUMBER + c))
            out = out.join(F.broadcast(own), F.col(c) == F.col(_NAME + c), "left")
        left = [F.when(F.col(_NUMBER + c).isNull(), F.col(c)).alias(c) if c in self.names else F.col(c) for c in rows.columns]
        words: dict[int, list[Column]] = {}
        for c, (word, factor) in self.places().items():
            words.setdefault(word, []).append(F.coalesce(_NUMBER + c, F.lit(0)) * F.lit(factor).cast("long"))
        return out.select(*left, *[reduce(Column.__add__, parts).alias(f"{_WORD}{i}") for i, parts in words.items()])

    def restored(self, short: DataFrame) -> DataFrame:
        """What ``shortened`` was given."""
        columns = [c for c in short.columns if not c.startswith(_WORD)]
        numbers = [
            F.expr(f"{_WORD}{word} DIV {factor}L % {self.sizes[c]}L").alias(_NUMBER + c)
            for c, (word, factor) in self.places().items()
        ]
        out = short.select(*columns, *numbers)
        for c, known in self.names.items():
            own = known.select(F.col("number").alias(_NUMBER + c), F.col("name").alias(_NAME + c))
            out = out.join(F.broadcast(own), _NUMBER + c, "left")
        return out.select(*[F.coalesce(_NAME + c, c).alias(c) if c in self.names else F.col(c) for c in columns])


def of(table: Table, dims: Mapping[str, DataFrame]) -> Codes:
    """Codes of the text columns of a table, whose names are in written dimensions."""
    texts = {c.name: c.references for c in table.columns if c.references and isinstance(c.dtype, T.StringType)}
    return of_names({c: dims[dim].select(F.col(key).alias(c)) for c, (dim, key) in texts.items() if dim in dims})


def of_names(tables: Mapping[str, DataFrame]) -> Codes:
    """Codes of columns, each with a table of its names, that have few enough. Numbers are by order of the
    names, so that each reading of the same names gives the same."""
    names = {c: own.select(F.col(c).alias("name")).filter("name IS NOT NULL").distinct() for c, own in tables.items()}
    if not names:
        return Codes({}, {})
    counts = [own.agg(F.lit(c).alias("column"), F.count("*").alias("rows")) for c, own in names.items()]
    sizes = {r["column"]: r.rows + 1 for r in reduce(DataFrame.unionByName, counts).collect() if r.rows <= LOOKED_UP}
    nth = F.row_number().over(Window.orderBy("name")).cast("long")
    return Codes({c: names[c].withColumn("number", nth) for c in sizes}, sizes)
