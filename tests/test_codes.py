"""Names that cross an exchange as numbers."""

from test_loads import SALES, raw, sales

from starmill.config import MartConfig
from starmill.contracts import DIM_PRODUCT, FACT_SALES
from starmill.plans import loads
from starmill.sources import codes
from starmill.sources.warehouse import Warehouse


def names(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"{column} STRING")


ROWS = [(1, "a", "x", 1.5), (2, None, "y", None), (3, "b", None, 2.5), (4, "unknown", "", 3.5), (5, "A", "x ", 4.5)]


def test_rows_come_back_as_they_were(spark, rows):
    df = spark.createDataFrame(ROWS, "id LONG, p STRING, q STRING, v DOUBLE")
    known = codes.of_names({"p": names(spark, "p", ["b", "a", "a", None, "A"]), "q": names(spark, "q", ["y", "x", ""])})
    assert known.sizes == {"p": 4, "q": 4}
    short = known.shortened(df)
    assert sorted((r.id, r.p, r.q) for r in short.collect()) == [
        (1, None, None), (2, None, None), (3, None, None), (4, "unknown", None), (5, None, "x "),
    ]
    back = known.restored(short)
    assert back.columns == df.columns and rows(back) == rows(df)


def test_many_names_need_several_words(spark, rows):
    columns = [f"c{i}" for i in range(5)]
    df = spark.range(50).selectExpr("id", *[f"string(id * {i + 3} % 40) AS {c}" for i, c in enumerate(columns)])
    known = codes.of_names({c: spark.range(40 - i).selectExpr(f"string(id) AS {c}") for i, c in enumerate(columns)})
    wide = codes.Codes(known.names, {c: 60_000 for c in columns})
    short = wide.shortened(df)
    assert [c for c in short.columns if c.startswith("_word")] == ["_word0", "_word1"]
    assert rows(wide.restored(short)) == rows(df)


def test_names_of_a_large_dimension_stay(spark, monkeypatch):
    monkeypatch.setattr(codes, "LOOKED_UP", 2)
    known = codes.of_names({"p": names(spark, "p", "abc"), "q": names(spark, "q", "ab")})
    assert known.sizes == {"q": 3}
    assert codes.of(FACT_SALES, {DIM_PRODUCT.name: names(spark, "product_name", "abc")}).names == {}


def test_a_load_deals_its_rows_without_their_names(spark, tmp_path, monkeypatch):
    """the exchange of whole rows into files of the fact."""
    dealt, kind = [], type(spark.range(1))
    texts = [c.name for c in FACT_SALES.columns if c.max_length]
    plain = kind.repartitionByRange

    def seen(df, *args):
        dealt.extend(df.select(*texts).collect())
        return plain(df, *args)

    monkeypatch.setattr(kind, "repartitionByRange", seen)
    config = MartConfig(str(tmp_path), "revenue", rows_per_file=2)
    loads.load(spark, config, loads.REVENUE, raw(spark, SALES, sales(range(6), "2024-01-05"), 0))
    fact = Warehouse(spark, config).read(FACT_SALES)
    assert len(dealt) == 6 and all(r[c] is None for r in dealt for c in texts)
    assert fact.count() == 6 and fact.filter("region_name IS NULL").isEmpty()
