"""Wide, dirty raw tables derived from the test tables (FIXTURES.md section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.functions.numbers import MONEY, RATIO
from starmill.sources import codes
from starmill.sources.headers import ORDINAL

NBSP = "\xa0"
# Start of the second delivery: a raw row belongs to the batch its ship date falls in.
SECOND_DELIVERY = "1999-01-01"
# Region some lines of every branch are booked under, so that branches occur under two regions.
MOVED_TO = "AFRICA"


def _dec(col: Column) -> Column:
    return col.cast(MONEY)


def _money_text(col: Column) -> Column:
    return col.cast(MONEY).cast("string")


def _dirty(col: Column, *rules: tuple[Column, str | Column]) -> Column:
    """``col`` as text, replaced where a rule holds; the first rule that holds wins."""
    out = col.cast("string")
    for cond, value in reversed(rules):
        out = F.when(cond, value).otherwise(out)
    return out


def _day_text(day: Column, shape: str) -> Column:
    """``date_format``, put together from parts of the plain text where the year has four digits: no formatter
    is called then, which costs more than all else a line's day needs."""
    plain, year = day.cast("string"), F.substring(day.cast("string"), 1, 4)
    two = {"dd": F.substring(plain, 9, 2), "MM": F.substring(plain, 6, 2)}
    parts = {"yyyy": year, **two, "d": F.dayofmonth(day).cast("string"), "M": F.month(day).cast("string")}
    text = plain if shape == "yyyy-MM-dd" else F.concat_ws("/", *[parts[p] for p in shape.split("/")])
    return F.when(F.year(day).between(1000, 9999), text).otherwise(F.date_format(day, shape))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per line item under mixed Vietnamese and English headers.

    Orders meet their customers first, so that lines move twice only, with short numbers for amounts, days
    and the names that orders bring; the few nations come last.
    """
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in
         ("lineitem", "orders", "customer", "nation", "region", "part")}
    amounts = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"),
        *[_dec(F.col(c)).alias(c) for c in amounts],
    )
    orders = t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderpriority", "c_nationkey", "c_mktsegment"
    )
    names = codes.of_names({"o_orderpriority": t["orders"], "c_mktsegment": t["customer"]})
    joined = names.restored(
        lines.join(names.shortened(orders), F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("order_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    )
    joined = (
        joined.join(t["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )
    p, day = F.col("l_partkey"), F.col("l_shipdate")
    price, quantity, discount, tax = [F.col(c) for c in amounts]
    # named as columns, so that each is worked out once for a line
    joined = joined.select(
        "*",
        _dec(price * (F.lit(1).cast("decimal(3,2)") - discount)).alias("_revenue"),
        _dec(_dec(_dec(F.col("p_retailprice")) * quantity) * F.lit("0.6").cast("decimal(2,1)")).alias("_cost"),
    )
    revenue, cost = F.col("_revenue"), F.col("_cost")
    iso = _day_text(day, "yyyy-MM-dd")
    order_id = F.col("order_id")
    home = F.when(p % 43 == 2, MOVED_TO).otherwise(F.col("r_name"))
    columns = {
        "Order ID": _dirty(
            order_id, (p % 107 == 11, "ORD-x"), (p % 13 == 2, F.concat(order_id.cast("string"), F.lit(".0")))
        ),
        "ngay": _dirty(
            iso,
            (p % 97 == 5, "not-a-date"),
            (p % 4 == 1, _day_text(day, "dd/MM/yyyy")),
            (p % 4 == 2, _day_text(day, "d/M/yyyy")),
            ((p % 4 == 3) & (F.dayofmonth(day) > 12), _day_text(day, "MM/dd/yyyy")),
        ),
        "Vung": _dirty(
            home,
            (p % 89 == 3, ""),
            (p % 11 == 0, F.concat(F.lit(NBSP + "  "), home, F.lit("\t"))),
        ),
        "chi_nhanh": _dirty(F.col("n_name"), (p % 53 == 1, "None")),
        "San Pham": _dirty(F.col("p_name"), (p % 59 == 4, "nan")),
        "Danh-Muc": _dirty(F.col("p_type"), (p % 17 == 6, "")),
        "Kenh": F.col("o_orderpriority"),
        "So Luong": _money_text(quantity),
        "Doanh Thu": _dirty(revenue, (p % 101 == 7, "1,234"), (p % 103 == 9, "12d")),
        "Chi Phi": _money_text(cost),
        "Loi Nhuan": _money_text(revenue - cost),
        "Quy Mo Thi Truong": _money_text(F.lit(100000) + F.col("p_size") * 1000),
        "Ngan Sach": _money_text(revenue * F.lit("1.1").cast("decimal(2,1)")),
        "Chi phi logistics": _money_text(price * tax),
        "Chi phi marketing": _money_text(price * discount),
        "Phan Khuc Khach Hang": F.col("c_mktsegment"),
        "Chien Dich": _dirty(F.col("p_brand"), (p % 5 == 0, "  ")),
    }
    return joined.select(*[c.alias(name) for name, c in columns.items()], _line_ordinal(day).alias(ORDINAL))


# Bits of a line's position in the raw table: its part and supplier, below the day it shipped.
PART_BITS, SUPPLIER_BITS = 26, 22


def _line_ordinal(day: Column) -> Column:
    """One number that orders lines by ship date, part and supplier."""
    by_day = F.shiftleft(F.unix_date(day.cast("date")).cast("long"), PART_BITS + SUPPLIER_BITS)
    by_part = F.shiftleft(F.col("l_partkey").cast("long"), SUPPLIER_BITS)
    return by_day + by_part + F.col("l_suppkey").cast("long")


DELIVERIES = ("early", "late")


def delivery() -> Column:
    """The delivery a raw row belongs to by its ship date; many orders are in both. A row without a place
    is in neither."""
    early, late = DELIVERIES
    return F.when(_is_late(), late).when(~_is_late(), early)


def _is_late() -> Column:
    first_day = F.unix_date(F.lit(SECOND_DELIVERY).cast("date")).cast("long")
    return F.col(ORDINAL) >= F.shiftleft(first_day, PART_BITS + SUPPLIER_BITS)


def sales_batches(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All raw rows, split by ship date into two deliveries."""
    return raw.filter(~_is_late()), raw.filter(_is_late())


# Other accepted spellings of headers of the raw sales table.
RESPELLED = {
    "Order ID": "ORDERID",
    "ngay": "Date",
    "Vung": "REGION",
    "chi_nhanh": "Branch",
    "San Pham": "product",
    "Doanh Thu": "Revenue",
    "Chi Phi": "COST",
    "Chien Dich": "Promotion Campaign",
}


def respelled(raw: DataFrame) -> DataFrame:
    """The same rows under other spellings, columns the other way round."""
    return raw.select(*[F.col(f"`{c}`").alias(RESPELLED.get(c, c)) for c in reversed(raw.columns)])


def raw_marketing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per event; the event id is the row order."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    e, user, value = F.col("event_id"), F.col("user_id"), _dec(F.col("value"))
    k = F.get_json_object("props", "$.k").cast("int")
    cost = _dec(value * F.lit("0.7").cast("decimal(2,1)"))
    day = F.col("ts").cast("date")

    def part(factor: str) -> Column:
        return _money_text(value * F.lit(factor).cast(MONEY))

    def pick(index: Column, names: list[str]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), (index + 1).cast("int"))

    kinds = F.create_map(*[F.lit(x) for x in (
        "view", "Impression", "signup", "Visit website", "click", "Click",
        "purchase", "Purchase", "error", "Support ticket",
    )])
    columns = {
        "OrderID": (e - F.when(e % 10 == 9, 1).otherwise(0)).cast("string"),
        "Date": _dirty(
            F.date_format(day, "yyyy-MM-dd"),
            (e % 97 == 5, "2024-13-45"),
            (e % 3 == 1, F.date_format(day, "dd/MM/yyyy")),
        ),
        "Stage": F.element_at(kinds, F.col("event_type")),
        "Channel": pick(user % 7, [
            "Facebook", "Ecommerce", "TV", "Retail promotion", "Traditional trade", "Other", "Messenger",
        ]),
        "campaign": pick(k % 8, [
            "Tet Sale", "Spring Fest", "Summer Cool", "Mid-Autumn Moon", "Year-End Deal",
            "Back-to-School", "Flash Sale", "",
        ]),
        "Department": F.concat(F.lit("Dept "), (user % 4).cast("string")),
        "Machine": F.concat(F.lit("M"), (k % 6).cast("string")),
        "Information": F.col("event_type"),
        "Customer Segment": _dirty(
            F.concat(F.lit("Seg "), (user % 3).cast("string")), (user % 11 == 0, "None")
        ),
        "Region": F.concat(F.lit("R"), (user % 5).cast("string")),
        "Branch": F.concat(F.lit("B"), (user % 9).cast("string")),
        "Product": F.concat(F.lit("P"), (k % 12).cast("string")),
        "Category": F.concat(F.lit("C"), (k % 4).cast("string")),
        "Revenue per Unit": F.try_divide(value, (k % 20 + 1).cast(MONEY)).cast(RATIO).cast("string"),
        "ROI Marketing": F.try_divide(value - cost, (user + 1).cast(MONEY)).cast(RATIO).cast("string"),
        "Region Profit Share": F.try_divide(k.cast(MONEY), F.lit(1000).cast(MONEY)).cast(RATIO).cast("string"),
        "Quantity": (k % 20 + 1).cast("string"),
        "Revenue": _money_text(value),
        "Cost": _money_text(cost),
        "Profit": _money_text(value - cost),
        "profit margin": F.try_divide(value - cost, value).cast(RATIO).cast("string"),
        "Target": _dirty(_dec(value * F.lit("1.2").cast(MONEY)), (e % 10 == 0, "0"), (e % 13 == 0, "")),
        "Budget": user.cast("string"),
        "marketing cost": part("0.05"),
        "raw_material_cost": part("0.30"),
        "LaborCost": part("0.20"),
        "logistics cost": part("0.10"),
        "Inventory Level": k.cast("string"),
        "Calls": (k % 5).cast("string"),
        "Waiting Time": (k % 7).cast("string"),
        "Conversion Proxy": F.try_divide(k.cast(MONEY), F.lit(100).cast(MONEY)).cast(RATIO).cast("string"),
        "Unit Cost": F.try_divide(cost, (k % 20 + 1).cast(MONEY)).cast(RATIO).cast("string"),
        "Cost per Machine Unit": F.try_divide(cost, (k % 6 + 1).cast(MONEY)).cast(RATIO).cast("string"),
        "Market Size": (F.lit(10000) + k).cast("string"),
        "Market Share": F.try_divide(value, (F.lit(10000) + k).cast(MONEY)).cast(RATIO).cast("string"),
    }
    return events.select(*[c.alias(name) for name, c in columns.items()], e.alias(ORDINAL))
