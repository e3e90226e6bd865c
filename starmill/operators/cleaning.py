"""From canonical text columns to typed, complete rows with one row per order."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starmill import contracts
from starmill.functions import dates, numbers, text
from starmill.sources import filters, headers, shared
from starmill.sources.filters import FILE, ROW
from starmill.sources.headers import ORDINAL

OVERFLOW = "_overflow"
LACKING = "_lacking"
COMPLETE = "_complete"
DATE_SPAN = "date_span"


@dataclass(frozen=True)
class CleanSpec:
    """How one mart's raw table is read: headers, required fields, column kinds, date rule."""

    aliases: Mapping[str, Sequence[str]]
    required: Sequence[str]
    texts: Sequence[str]
    numbers: Mapping[str, T.DecimalType]
    parse_date: Callable[[Column], Column]

    def canonicalize(self, raw: DataFrame) -> DataFrame:
        return headers.canonicalize(raw, self.aliases, self.required)

    def canonicalize_each(self, raws: Sequence[DataFrame]) -> DataFrame:
        """Several staged tables as one, each by its own headers; later tables count as later rows.

        Spellings, order and number of columns may differ from table to table. A place is then the
        table's number and the place in it.
        """
        if len(raws) == 1:
            return self.canonicalize(raws[0])
        numbered = []
        for i, raw in enumerate(raws):
            place = F.struct(F.lit(i).alias("delivery"), F.col(ORDINAL).cast("decimal(38,0)").alias("place"))
            numbered.append(self.canonicalize(raw).withColumn(ORDINAL, place))
        return reduce(DataFrame.unionByName, numbered)


def _spec(aliases, required, fact: contracts.Table, parse_date) -> CleanSpec:
    measures = {c.name: c.dtype for c in fact.columns if isinstance(c.dtype, T.DecimalType)}
    derived = {"order_id", "date", "year", "month"}
    return CleanSpec(
        aliases=aliases,
        required=required,
        texts=[c for c in aliases if c not in measures and c not in derived],
        numbers={c: measures[c] for c in aliases if c in measures},
        parse_date=parse_date,
    )


REVENUE = _spec(
    headers.REVENUE_ALIASES, headers.REVENUE_REQUIRED, contracts.FACT_SALES, dates.parse_date_mixed
)
MARKETING = _spec(
    headers.MARKETING_ALIASES, headers.MARKETING_REQUIRED, contracts.FACT_MARKETING, dates.parse_date_staged
)


def spread(canonical: DataFrame) -> DataFrame:
    """Deal rows over tasks by their place in the source before they are parsed.

    A scan makes one task of a row group, a compressed file or a database query, and parsing costs far
    more than reading. A source with a file for every core is in many tasks as it is, and its rows stay
    where they are. Otherwise the number of tasks is the session's ``spark.sql.shuffle.partitions``; only
    the canonical columns move. A place is a number of its own for each row, so a frequent order cannot
    gather in one task here.
    """
    if len(canonical.inputFiles()) >= canonical.sparkSession.sparkContext.defaultParallelism:
        return canonical
    tasks = int(canonical.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return canonical.repartition(tasks, ORDINAL)


def parse(canonical: DataFrame, spec: CleanSpec) -> DataFrame:
    """Type every column and mark complete rows. Narrow: no shuffle, no Python.

    ``_lacking`` lists the required columns a row has no value for, and ``date_span`` if its date is
    one outside the supported span. ``_overflow`` lists the numeric
    columns whose number is too large for its NUMERIC type; such a row is not incomplete and must
    fail the load (K5) rather than vanish.

    The work is cut into steps that name each earlier result as a column, so that nothing is parsed
    twice. Optional numbers go through one array expression per type, which keeps the generated
    code small enough for the JVM to compile however many there are.
    """
    order = [ORDINAL] if ORDINAL in canonical.columns else []
    required = {c: t for c, t in spec.numbers.items() if c in spec.required}
    by_type: dict[T.DecimalType, list[str]] = {}
    for c, t in spec.numbers.items():
        if c not in required:
            by_type.setdefault(t, []).append(c)
    arrays = [(f"_texts{i}", f"_values{i}", t, columns) for i, (t, columns) in enumerate(by_type.items())]

    stripped = canonical.select(
        "order_id",
        *[text.strip(F.col(c)).alias(c) for c in ("date", *spec.texts)],
        *[F.col(c).alias(f"_text_{c}") for c in required],
        *[F.array(*columns).alias(texts) for texts, _, _, columns in arrays],
        *order,
    )
    read = stripped.select(
        numbers.to_order_id(F.col("order_id")).alias("order_id"),
        spec.parse_date(F.col("date")).alias("date"),
        *spec.texts,
        *[numbers.to_num(F.col(f"_text_{c}"), t).alias(c) for c, t in required.items()],
        *[f"_text_{c}" for c in required],
        *[texts for texts, _, _, _ in arrays],
        *[
            F.transform(texts, lambda x: numbers.to_num(x, t)).alias(values)
            for texts, values, t, _ in arrays
        ],
        *order,
    )
    typed = read.select(
        "order_id",
        dates.in_span(F.col("date")).alias("date"),
        (F.col("date").isNotNull() & dates.in_span(F.col("date")).isNull()).alias("_beyond"),
        *[text.missing_to_null(F.col(c)).alias(c) for c in spec.texts],
        *required,
        *[F.col(values)[k].alias(c) for _, values, _, columns in arrays for k, c in enumerate(columns)],
        *[numbers.overflows(F.col(f"_text_{c}"), F.col(c)).alias(f"_lost_{c}") for c in required],
        *[F.zip_with(texts, values, numbers.overflows).alias(values) for texts, values, _, _ in arrays],
        *order,
    )
    lost = {c: F.col(f"_lost_{c}") for c in required}
    any_lost = [*lost.values(), *[F.exists(values, lambda x: x) for _, values, _, _ in arrays]]
    lost |= {c: F.col(values)[k] for _, values, _, columns in arrays for k, c in enumerate(columns)}
    lacking = {c: F.col(c).isNull() for c in spec.required}
    lacking |= {c: F.col(c).isNull() & ~F.coalesce(lost[c], F.lit(False)) for c in required}
    lacking["date"] = lacking["date"] & ~F.col("_beyond")
    lacking[DATE_SPAN] = F.col("_beyond")
    incomplete = reduce(Column.__or__, lacking.values())
    return typed.select(
        "order_id",
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        *spec.texts,
        *spec.numbers,
        F.when(
            reduce(Column.__or__, any_lost), F.concat_ws(",", *[F.when(x, c) for c, x in lost.items()])
        ).alias(OVERFLOW),
        F.when(
            incomplete, F.concat(*[F.when(x, f"{c},").otherwise("") for c, x in lacking.items()])
        ).alias(LACKING),
        (~incomplete).alias(COMPLETE),
        *order,
    )


def missing(spec: CleanSpec) -> dict[str, Column]:
    """Per reason, whether a parsed row is rejected for it (C7): a required column it lacks, or the span."""
    return {c: F.col(LACKING).contains(f"{c},") for c in (*spec.required, DATE_SPAN)}


def rejects(parsed: DataFrame) -> DataFrame:
    """Incomplete rows, with ``reasons``: the required columns each one lacks."""
    incomplete = parsed.filter(~F.col(COMPLETE)) if COMPLETE in parsed.columns else parsed
    return incomplete.select("*", F.array_remove(F.split(LACKING, ","), "").alias("reasons"))


def split(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write parsed rows once and read the complete ones and the others back, each by a pushed filter.

    Nothing is parsed twice, and incomplete rows meet neither sort nor exchange. One write makes
    both sides, so they always come from the same reading of the source. With a folder for each side
    Spark would sort the whole rows of every task by side before it writes them.
    """
    written = shared.materialize(parsed, path)
    return written.filter(COMPLETE).drop(COMPLETE), written.filter(~F.col(COMPLETE)).drop(COMPLETE)


def rejects_by_reason(parsed: DataFrame, spec: CleanSpec) -> DataFrame:
    """Rows lacking each required column, in one pass. A row that lacks two counts under both."""
    reasons = list(missing(spec))
    counted = tally(parsed, spec).select(*[F.col(f"lacking_{c}").alias(c) for c in reasons])
    return counted.unpivot([], reasons, "reason", "n_rows").filter("n_rows > 0")


def clean(canonical: DataFrame, spec: CleanSpec) -> DataFrame:
    """Complete rows only, and of those the last one of each order (C7, then C9)."""
    return last_complete(parse(canonical, spec))


def last_complete(parsed: DataFrame, key: str = "order_id", ordinal: str = ORDINAL) -> DataFrame:
    """The last complete row of each key in ordinal order, of rows that are not staged by ``split``.

    Completeness leads the sort order and is filtered on afterwards. Filtering first gives the same
    rows, but Catalyst would push that filter below the parsing and parse the required columns
    twice. The group limit Catalyst adds before the exchange lets each map task send at most one
    row per key, so neither a key with a third of all rows nor the unreadable keys pile up.
    """
    order = [F.col(COMPLETE).desc(), *_latest_first(parsed, ordinal)]
    return _first_of(parsed, key, order).filter(COMPLETE).drop(COMPLETE, LACKING)


def last_of(complete: DataFrame, key: str = "order_id", ordinal: str = ORDINAL) -> DataFrame:
    """The last row of each key of the complete side of ``split`` (C9), with the same group limit.

    Whole rows stay where they were written. Only the key, order and place (file and row) of each are
    sorted and sent; the places of the rows that win come back as bitmaps, which pick them out of the
    files. The bitmaps are broadcast: a bit for each row.
    """
    return _at(complete, _places_of_last(complete, key, ordinal))


def staged_last_of(complete: DataFrame, path: str, key: str = "order_id", ordinal: str = ORDINAL) -> DataFrame:
    """``last_of`` for many readers: only the bitmaps are written, and no row a second time. Each reader
    takes its own columns of the rows out of the files that ``split`` wrote."""
    return _at(complete, shared.materialize(_places_of_last(complete, key, ordinal), path))


def _placed(complete: DataFrame) -> DataFrame:
    return complete.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def _at(complete: DataFrame, places: DataFrame) -> DataFrame:
    return filters.marked(_placed(complete), places).select(*[c for c in complete.columns if c != LACKING])


def _places_of_last(complete: DataFrame, key: str, ordinal: str) -> DataFrame:
    placed = _placed(complete)
    names = sorted(f.rsplit("/", 1)[-1] for f in complete.inputFiles())
    files = F.broadcast(complete.sparkSession.createDataFrame(list(enumerate(names)), f"_rank INT, {FILE} STRING"))
    short = placed.select(key, F.col(ordinal).alias("_at"), _tie(complete, ordinal).alias("_tie"), FILE, ROW)
    short = short.join(files, FILE).select(key, "_at", "_tie", "_rank", ROW)
    last = _first_of(short, key, [F.col("_at").desc(), F.col("_tie").desc()])
    return filters.mark(last, "_rank").join(files, "_rank").drop("_rank")


def _tie(df: DataFrame, ordinal: str) -> Column:
    """Rows of one key at one position are told apart by their values, not by the order of tasks."""
    return F.xxhash64(*[c for c in df.columns if c != ordinal])


def _latest_first(df: DataFrame, ordinal: str) -> list[Column]:
    return [F.col(ordinal).desc(), _tie(df, ordinal).desc()]


def _first_of(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_nth", nth).filter("_nth = 1").drop("_nth")


def tally(parsed: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row: raw rows, incomplete rows, and rows lacking each required column.

    Plain aggregates rather than observed metrics, which count a retried task twice. The scan is
    pruned to the required columns.
    """
    return parsed.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(~F.col(COMPLETE)).alias("rejected_rows"),
        *[F.count_if(cond).alias(f"lacking_{c}") for c, cond in missing(spec).items()],
    )


def row_counts(parsed: DataFrame, cleaned: DataFrame, spec: CleanSpec) -> DataFrame:
    """One row: raw, rejected, superseded by a later row of the same order, clean."""
    kept = cleaned.agg(F.count("*").alias("clean_rows")).scalar()
    return tally(parsed, spec).select(
        "raw_rows",
        "rejected_rows",
        (F.col("raw_rows") - F.col("rejected_rows") - kept).alias("superseded_rows"),
        kept.alias("clean_rows"),
    )
