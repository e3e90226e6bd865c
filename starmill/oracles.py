"""DuckDB SQL for every registered query.

The SQL computes clean answers from the clean source columns and the rules by which the raw tables
were soiled (FIXTURES.md section 3). It never parses a dirty text, so a parsing error in the Spark
code cannot cancel out. Ratios use whole-number arithmetic, because DuckDB divides decimals as
floating point.
"""

from __future__ import annotations

from starmill.contracts import FACT_MARKETING, FACT_SALES
from starmill.registry import TIGHT_LENGTH, TIGHT_MONEY
from starmill.sources.testdata import SECOND_DELIVERY

MONEY = "DECIMAL(18,2)"
RATE = "DECIMAL(18,6)"
TOTAL = "DECIMAL(38,2)"


def dec(expr: str) -> str:
    """A floating-point column as the decimal its text shows."""
    return f"CAST(CAST({expr} AS VARCHAR) AS {MONEY})"


def money(expr: str) -> str:
    return f"CAST({expr} AS {MONEY})"


def total(expr: str) -> str:
    return f"CAST(SUM({expr}) AS {TOTAL})"


def ratio(top: str, bottom: str, top_scale: int = 2, bottom_scale: int = 2) -> str:
    """Quotient rounded half up to six digits."""
    n = f"(CAST(({top}) * {10**top_scale} AS HUGEINT) * {10 ** (6 + bottom_scale)})"
    d = f"(CAST(({bottom}) * {10**bottom_scale} AS HUGEINT) * {10**top_scale})"
    sign = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END)"
    whole = f"((2 * ABS({n}) + ABS({d})) // (2 * ABS({d})))"
    micro = f"CAST({sign} * {whole} AS DECIMAL(38,0))"
    return (
        f"CASE WHEN ({bottom}) IS NULL OR ({bottom}) = 0 THEN NULL "
        f"ELSE CAST({micro} * CAST(0.000001 AS DECIMAL(7,6)) AS {RATE}) END"
    )


def average(expr: str, scale: int = 2) -> str:
    return ratio(f"CAST(SUM({expr}) AS DECIMAL(38,{scale}))", f"COUNT({expr})", scale, 0)


# -- the sales table -----------------------------------------------------------------------------

_LINES = f"""lines AS (
    SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS p, l_suppkey, l_shipdate,
           CAST(l_shipdate AS DATE) AS day,
           CASE WHEN l_partkey % 43 = 2 THEN 'AFRICA' ELSE r_name END AS r_name, n_name, p_name, p_type, p_brand, p_size,
           o_orderpriority, c_mktsegment, {dec('l_quantity')} AS quantity,
           {dec('l_extendedprice')} AS price, {dec('l_discount')} AS discount,
           {dec('l_tax')} AS tax, {dec('p_retailprice')} AS retail
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
), valued AS (
    SELECT *, {money('price * (1 - discount)')} AS revenue,
           {money(f"{money('retail * quantity')} * CAST(0.6 AS DECIMAL(2,1))")} AS cost,
           {money('100000 + p_size * 1000')} AS market_size,
           {money('price * tax')} AS logistics_cost, {money('price * discount')} AS marketing_cost
    FROM lines
), amounts AS (
    SELECT *, {money('revenue - cost')} AS profit,
           {money('revenue * CAST(1.1 AS DECIMAL(2,1))')} AS budget
    FROM valued
), parsed AS (
    SELECT CASE WHEN p % 107 <> 11 THEN id END AS order_id,
           CASE WHEN p % 97 <> 5 THEN day END AS date,
           CASE WHEN p % 89 <> 3 THEN r_name END AS region,
           CASE WHEN p % 53 <> 1 THEN n_name END AS branch,
           CASE WHEN p % 59 <> 4 THEN p_name END AS product,
           CASE WHEN p % 17 <> 6 THEN p_type END AS category,
           o_orderpriority AS channel, quantity,
           CASE WHEN p % 101 <> 7 AND p % 103 <> 9 THEN revenue END AS revenue,
           cost, profit, market_size, budget, logistics_cost, marketing_cost,
           c_mktsegment AS customer_segment,
           CASE WHEN p % 5 <> 0 THEN p_brand END AS promotion_campaign,
           l_shipdate, p, l_suppkey
    FROM amounts
), complete AS (
    SELECT * FROM parsed
    WHERE order_id IS NOT NULL AND date IS NOT NULL AND region IS NOT NULL AND revenue IS NOT NULL
)"""


def _clean_sales(name: str = "clean", where: str = "TRUE") -> str:
    return f"""{name} AS (
    SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
    FROM complete WHERE {where}
    QUALIFY row_number() OVER (
        PARTITION BY order_id ORDER BY l_shipdate DESC, p DESC, l_suppkey DESC) = 1
)"""


_EARLY = f"l_shipdate < TIMESTAMP '{SECOND_DELIVERY}'"
_LATE = f"l_shipdate >= TIMESTAMP '{SECOND_DELIVERY}'"
SALES = f"WITH {_LINES}, {_clean_sales()}"
BATCHES = f"WITH {_LINES}, {_clean_sales()}, {_clean_sales('early', _EARLY)}, {_clean_sales('late', _LATE)}"

SALES_COLUMNS = (
    "order_id, date, year, month, region, branch, product, category, channel, quantity, revenue, cost, "
    "profit, market_size, budget, logistics_cost, marketing_cost, customer_segment, promotion_campaign"
)
SALES_FACT = (
    "order_id, date AS full_date, region AS region_name, branch AS branch_name, product AS product_name, "
    "channel AS channel_name, customer_segment AS segment_name, promotion_campaign, quantity, revenue, "
    "cost, profit, market_size, budget, logistics_cost, marketing_cost"
)
PRODUCTS = """products AS (
    SELECT product AS product_name, category FROM clean WHERE product IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY product ORDER BY l_shipdate, p, l_suppkey, category) = 1
)"""

# -- the marketing table -------------------------------------------------------------------------

_EVENTS = f"""events_k AS (
    SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
           {dec('value')} AS v, CAST(ts AS DATE) AS day
    FROM events
), costed AS (
    SELECT *, {money('v * CAST(0.7 AS DECIMAL(2,1))')} AS cost,
           CASE WHEN event_id % 10 = 0 THEN CAST(0 AS {MONEY}) WHEN event_id % 13 = 0 THEN NULL
                ELSE {money(f'v * CAST(1.2 AS {MONEY})')} END AS target
    FROM events_k
), clean AS (
    SELECT event_id, event_id - (CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END) AS order_id, day AS date,
           CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
           CASE event_type WHEN 'view' THEN 'Impression' WHEN 'signup' THEN 'Visit website'
                WHEN 'click' THEN 'Click' WHEN 'purchase' THEN 'Purchase'
                WHEN 'error' THEN 'Support ticket' END AS stage,
           CASE user_id % 7 WHEN 0 THEN 'Facebook' WHEN 1 THEN 'Ecommerce' WHEN 2 THEN 'TV'
                WHEN 3 THEN 'Retail promotion' WHEN 4 THEN 'Traditional trade' WHEN 5 THEN 'Other'
                ELSE 'Messenger' END AS channel,
           CASE k % 8 WHEN 0 THEN 'Tet Sale' WHEN 1 THEN 'Spring Fest' WHEN 2 THEN 'Summer Cool'
                WHEN 3 THEN 'Mid-Autumn Moon' WHEN 4 THEN 'Year-End Deal' WHEN 5 THEN 'Back-to-School'
                WHEN 6 THEN 'Flash Sale' END AS campaign,
           'Dept ' || CAST(user_id % 4 AS VARCHAR) AS department,
           'M' || CAST(k % 6 AS VARCHAR) AS machine, event_type AS information,
           CASE WHEN user_id % 11 <> 0 THEN 'Seg ' || CAST(user_id % 3 AS VARCHAR) END AS customer_segment,
           {money('k % 20 + 1')} AS quantity, v AS revenue, cost, {money('v - cost')} AS profit,
           {ratio('v - cost', 'v')} AS profit_margin, {money('k')} AS inventory_level,
           {money('k % 5')} AS calls, {money('k % 7')} AS waiting_time,
           {ratio('k', '100', 0, 0)} AS conversion_proxy, {money('user_id')} AS budget, target,
           {money(f'v * CAST(0.05 AS {MONEY})')} AS marketing_cost,
           {ratio('v - cost', 'user_id + 1', 2, 0)} AS roi_marketing,
           {money(f'v * CAST(0.30 AS {MONEY})')} AS raw_material_cost,
           {money(f'v * CAST(0.20 AS {MONEY})')} AS labor_cost,
           {money(f'v * CAST(0.10 AS {MONEY})')} AS logistics_cost,
           {ratio('cost', 'k % 20 + 1', 2, 0)} AS unit_cost, {ratio('v', 'k % 20 + 1', 2, 0)} AS revenue_per_unit,
           {ratio('cost', 'k % 6 + 1', 2, 0)} AS cost_per_machine_unit, {money('10000 + k')} AS market_size,
           {ratio('v', '10000 + k', 2, 0)} AS market_share, {ratio('k', '1000', 0, 0)} AS region_profit_share,
           'R' || CAST(user_id % 5 AS VARCHAR) AS region, 'B' || CAST(user_id % 9 AS VARCHAR) AS branch,
           'P' || CAST(k % 12 AS VARCHAR) AS product, 'C' || CAST(k % 4 AS VARCHAR) AS category
    FROM costed
    WHERE event_id % 97 <> 5
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_id DESC) = 1
)"""

_CHANNEL_TYPE = """CASE channel WHEN 'Facebook' THEN 'Social' WHEN 'Ecommerce' THEN 'Digital commerce'
    WHEN 'TV' THEN 'Broadcast' WHEN 'Retail promotion' THEN 'Trade promotion'
    WHEN 'Traditional trade' THEN 'Traditional trade' ELSE 'Other' END"""
_CAMPAIGN_TYPE = """CASE campaign WHEN 'Tet Sale' THEN 'Seasonal' WHEN 'Spring Fest' THEN 'Seasonal'
    WHEN 'Summer Cool' THEN 'Seasonal' WHEN 'Mid-Autumn Moon' THEN 'Seasonal'
    WHEN 'Year-End Deal' THEN 'Year end' WHEN 'Back-to-School' THEN 'Back to school'
    WHEN 'Flash Sale' THEN 'Other' END"""
_STAGES = """stages AS (
    SELECT * FROM (VALUES ('Impression', 1, 'Awareness'), ('Visit website', 2, 'Consideration'),
        ('Click', 3, 'Consideration'), ('Add to cart', 4, 'Intent'), ('Purchase', 5, 'Conversion'),
        ('Support ticket', 99, 'Other')) AS t(stage_name, stage_order, stage_group)
)"""

MARKETING = f"WITH {_EVENTS}"
MARKETING_COLUMNS = (
    "order_id, date, year, month, region, branch, department, product, category, stage, channel, "
    "information, machine, quantity, revenue, cost, profit, profit_margin, inventory_level, calls, "
    "waiting_time, budget, target, raw_material_cost, labor_cost, logistics_cost, marketing_cost, unit_cost, "
    "revenue_per_unit, roi_marketing, conversion_proxy, cost_per_machine_unit, region_profit_share, "
    "market_size, market_share, customer_segment, campaign"
)
_NAMES = {
    "full_date": "date", "stage_name": "stage", "channel_name": "channel", "information_name": "information",
    "machine_name": "machine", "department_name": "department", "segment_name": "customer_segment",
    "campaign_name": "campaign",
}
_COMPUTED = {
    "target_gap": money("revenue - COALESCE(target, 0)"),
    "target_achievement_rate": ratio("revenue", "target"),
    "roi_marketing_calc": ratio("profit", "budget"),
}
MARKETING_FACT = ", ".join(
    f"{_COMPUTED.get(c, _NAMES.get(c, c))} AS {c}" for c in FACT_MARKETING.names if c != "created_at"
)


# -- shared shapes -------------------------------------------------------------------------------

_DATE_DIM = """SELECT DISTINCT date AS full_date, year, month, strftime(date, '%B') AS month_name,
    CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month FROM clean"""
_BY = f"COUNT(*) AS orders, {total('revenue')} AS revenue, {total('profit')} AS profit"


def _distinct(source: str, column: str, key: str) -> str:
    return f"{source} SELECT DISTINCT {column} AS {key} FROM clean WHERE {column} IS NOT NULL"


def _group(source: str, column: str, key: str, extra: str = "") -> str:
    return f"{source} SELECT {column} AS {key}, {_BY}{extra} FROM clean GROUP BY {column}"


def _conflicts(key: str, attribute: str) -> str:
    return f"""{SALES}, pairs AS (
        SELECT {key}, {attribute}, COUNT(*) AS n FROM clean WHERE {key} IS NOT NULL GROUP BY ALL
    ) SELECT {key}, COUNT(*) AS n_values, CAST(SUM(n) AS BIGINT) AS n_rows FROM pairs
    GROUP BY {key} HAVING COUNT(*) > 1"""


def _tests(source: str, constraint: str, tests: dict[str, str], key: str, table: str) -> str:
    rows = [
        f"SELECT '{constraint}' AS \"constraint\", '{column}' AS \"column\", "
        f"COUNT(*) FILTER (WHERE {cond}) AS n_violations, "
        f"CAST(MIN({key}) FILTER (WHERE {cond}) AS VARCHAR) AS sample_key FROM {table}"
        for column, cond in tests.items()
    ]
    return f"{source} " + " UNION ALL ".join(rows)


# The declared tables of the revenue mart, each column with its longest text (0: no
# text), required columns in capitals, the key first.
_DECLARED = {
    "fact": "ORDER_ID 0, FULL_DATE 0, REGION_NAME 50, branch_name 100, product_name 150, channel_name 100, "
    "segment_name 100, promotion_campaign 150, REVENUE 0",
    "dates": "FULL_DATE 0, YEAR 0, MONTH 0, month_name 20, year_month 7",
    "regions": "REGION_NAME 50",
    "branches": "BRANCH_NAME 100, region_name 50",
    "products": "PRODUCT_NAME 150, category 100",
    "channels": "CHANNEL_NAME 100",
    "segments": "SEGMENT_NAME 100",
    "promotions": "PROMOTION_CAMPAIGN 150",
}
_REFERENCES = {
    "full_date": "dates", "region_name": "regions", "branch_name": "branches", "product_name": "products",
    "channel_name": "channels", "segment_name": "segments", "promotion_campaign": "promotions",
}


def _declared() -> str:
    """Every declared constraint, counted over the tables that the clean rows give."""
    names = {"regions": "region", "channels": "channel", "segments": "customer_segment", "promotions": "promotion_campaign"}
    tables = [f"fact AS (SELECT {SALES_FACT} FROM clean)", f"dates AS ({_DATE_DIM})"]
    for table, column in names.items():
        key = _DECLARED[table].split()[0].lower()
        tables.append(f"{table} AS (SELECT DISTINCT {column} AS {key} FROM clean WHERE {column} IS NOT NULL)")
    tables.append(
        """branches AS (SELECT branch AS branch_name, region AS region_name FROM clean WHERE branch IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY branch ORDER BY l_shipdate DESC, p DESC, l_suppkey DESC, region) = 1)"""
    )
    row = """SELECT '{kind}' AS "constraint", '{column}' AS "column", COUNT(*) AS n_violations,
        CAST(MIN({sample}) AS VARCHAR) AS sample_key FROM {rows}"""
    found = []
    for table, declared in _DECLARED.items():
        columns = [part.split() for part in declared.split(", ")]
        key = columns[0][0].lower()
        repeated = f"(SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1)"
        found.append(row.format(kind="primary_key", column=key, sample=key, rows=repeated))
        for name, length in columns:
            column = name.lower()
            if name.isupper():
                found.append(row.format(kind="not_null", column=column, sample=key, rows=f"{table} WHERE {column} IS NULL"))
            if int(length):
                found.append(row.format(kind="max_length", column=column, sample=key, rows=f"{table} WHERE length({column}) > {length}"))
    for column, table in _REFERENCES.items():
        orphans = f"fact WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {column} FROM {table})"
        found.append(row.format(kind="foreign_key", column=column, sample=column, rows=orphans))
    return f"{SALES}, {PRODUCTS}, {', '.join(tables)} " + " UNION ALL ".join(found)


def _upsert(body: str) -> str:
    columns = [c for c in FACT_SALES.names if c != "order_id"]
    picked = ", ".join(f"{body.format(c=c)} AS {c}" for c in columns)
    return f"""{BATCHES}, a AS (SELECT {SALES_FACT} FROM early), b AS (SELECT {SALES_FACT} FROM late)
    SELECT COALESCE(a.order_id, b.order_id) AS order_id, {picked}
    FROM a FULL OUTER JOIN b ON a.order_id = b.order_id"""


def _orphans() -> str:
    keys = {c.name: _sales_source(c.name) for c in FACT_SALES.columns if c.references}
    parts = [
        f"SELECT '{column}' AS \"column\", CAST({source} AS VARCHAR) AS value, COUNT(*) AS n_rows FROM clean "
        f"WHERE {source} IS NOT NULL AND {source} NOT IN "
        f"(SELECT {source} FROM early WHERE {source} IS NOT NULL) GROUP BY {source}"
        for column, source in keys.items()
    ]
    return f"{BATCHES} " + " UNION ALL ".join(parts)


def _sales_source(column: str) -> str:
    named = {"full_date": "date", "region_name": "region", "branch_name": "branch", "product_name": "product",
             "channel_name": "channel", "segment_name": "customer_segment"}
    return named.get(column, column)


def _sales_canonical() -> str:
    text = {
        "quantity": "quantity", "cost": "cost", "profit": "profit", "market_size": "market_size",
        "budget": "budget", "logistics_cost": "logistics_cost", "marketing_cost": "marketing_cost",
    }
    plain = ", ".join(f"CAST({e} AS VARCHAR) AS {c}" for c, e in text.items())
    return f"""WITH {_LINES} SELECT
        CASE WHEN p % 107 = 11 THEN 'ORD-x' WHEN p % 13 = 2 THEN CAST(id AS VARCHAR) || '.0'
             ELSE CAST(id AS VARCHAR) END AS order_id,
        CASE WHEN p % 97 = 5 THEN 'not-a-date' WHEN p % 4 = 1 THEN strftime(day, '%d/%m/%Y')
             WHEN p % 4 = 2 THEN strftime(day, '%-d/%-m/%Y')
             WHEN p % 4 = 3 AND day(day) > 12 THEN strftime(day, '%m/%d/%Y')
             ELSE strftime(day, '%Y-%m-%d') END AS date,
        CAST(NULL AS VARCHAR) AS year, CAST(NULL AS VARCHAR) AS month,
        CASE WHEN p % 89 = 3 THEN '' WHEN p % 11 = 0 THEN chr(160) || '  ' || r_name || chr(9)
             ELSE r_name END AS region,
        CASE WHEN p % 53 = 1 THEN 'None' ELSE n_name END AS branch,
        CASE WHEN p % 59 = 4 THEN 'nan' ELSE p_name END AS product,
        CASE WHEN p % 17 = 6 THEN '' ELSE p_type END AS category,
        o_orderpriority AS channel,
        CASE WHEN p % 101 = 7 THEN '1,234' WHEN p % 103 = 9 THEN '12d'
             ELSE CAST(revenue AS VARCHAR) END AS revenue, {plain},
        c_mktsegment AS customer_segment, CASE WHEN p % 5 = 0 THEN '  ' ELSE p_brand END AS promotion_campaign
    FROM amounts"""


def _marketing_canonical() -> str:
    """The marketing raw table holds its clean values as text, but for five columns."""
    events = _EVENTS[: _EVENTS.rindex("    WHERE event_id % 97")] + ")"
    soiled = {
        "date": """CASE WHEN event_id % 97 = 5 THEN '2024-13-45' WHEN event_id % 3 = 1
                   THEN strftime(date, '%d/%m/%Y') ELSE strftime(date, '%Y-%m-%d') END""",
        "campaign": "COALESCE(campaign, '')",
        "customer_segment": "COALESCE(customer_segment, 'None')",
        "target": "CASE WHEN target IS NULL THEN '' WHEN event_id % 10 = 0 THEN '0' ELSE CAST(target AS VARCHAR) END",
        "year": "CAST(NULL AS VARCHAR)", "month": "CAST(NULL AS VARCHAR)",
    }
    whole = ("quantity", "inventory_level", "calls", "waiting_time", "budget", "market_size")
    soiled |= {c: f"CAST(CAST({c} AS BIGINT) AS VARCHAR)" for c in whole}
    picked = ", ".join(f"{soiled.get(c, f'CAST({c} AS VARCHAR)')} AS {c}" for c in MARKETING_COLUMNS.split(", "))
    return f"WITH {events} SELECT {picked} FROM clean"


def _counts(source: str, raw: str, bad: str) -> str:
    return f"""{source} SELECT n_raw AS raw_rows, n_bad AS rejected_rows, n_raw - n_bad - n_clean AS superseded_rows,
        n_clean AS clean_rows FROM (SELECT (SELECT COUNT(*) FROM {raw}) AS n_raw,
        (SELECT COUNT(*) FROM {raw} WHERE {bad}) AS n_bad, (SELECT COUNT(*) FROM clean) AS n_clean)"""


# -- one statement per query ---------------------------------------------------------------------

_INCOMPLETE = "order_id IS NULL OR date IS NULL OR region IS NULL OR revenue IS NULL"
_NINES = f"{10 ** (TIGHT_MONEY.precision - TIGHT_MONEY.scale) - 1}.995"
_PERF = (
    f"COUNT(*) AS orders, {total('revenue')} AS revenue, {total('profit')} AS profit, "
    f"{total('marketing_cost')} AS marketing_cost"
)
_EFFECT = (
    f"{_PERF}, {ratio('SUM(revenue)', 'SUM(marketing_cost)')} AS revenue_per_marketing_cost, "
    f"{ratio('SUM(profit)', 'SUM(revenue)')} AS margin"
)
_COMPONENTS = ("raw_material_cost", "labor_cost", "logistics_cost", "marketing_cost")

_LAST_REGION = """QUALIFY row_number() OVER (
    PARTITION BY branch ORDER BY l_shipdate DESC, p DESC, l_suppkey DESC, region) = 1"""
_SPARSE = """CAST((CAST(order_id AS HUGEINT) * 2862933555777941757) % 9223372036854775783 AS BIGINT)
    - 4611686018427387891"""

ORACLES: dict[str, str] = {
    "sales_canonical": _sales_canonical(),
    "marketing_canonical": _marketing_canonical(),
    "clean_sales": f"{SALES} SELECT {SALES_COLUMNS} FROM clean",
    "clean_marketing": f"{MARKETING} SELECT {MARKETING_COLUMNS} FROM clean",
    "sales_rejects_by_reason": f"WITH {_LINES} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS reason, COUNT(*) AS n_rows FROM parsed WHERE {c} IS NULL"
        for c in ("order_id", "date", "region", "revenue")
    )
    + ") WHERE n_rows > 0",
    "marketing_rejects_by_reason": """SELECT 'date' AS reason, COUNT(*) AS n_rows FROM events
        WHERE event_id % 97 = 5 HAVING COUNT(*) > 0""",
    "sales_row_counts": _counts(SALES, "parsed", _INCOMPLETE),
    "marketing_row_counts": _counts(MARKETING, "events", "event_id % 97 = 5"),
    "dim_date": f"{SALES} {_DATE_DIM}",
    "dim_region": _distinct(SALES, "region", "region_name"),
    "dim_branch": f"""{SALES} SELECT branch AS branch_name, region AS region_name FROM clean
        WHERE branch IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY branch ORDER BY l_shipdate DESC, p DESC, l_suppkey DESC, region) = 1""",
    "dim_product": f"{SALES}, {PRODUCTS} SELECT * FROM products",
    "dim_channel": _distinct(SALES, "channel", "channel_name"),
    "dim_segment": _distinct(SALES, "customer_segment", "segment_name"),
    "dim_promotion": _distinct(SALES, "promotion_campaign", "promotion_campaign"),
    "marketing_dim_date": f"{MARKETING} {_DATE_DIM}",
    "marketing_dim_segment": _distinct(MARKETING, "customer_segment", "segment_name"),
    "dim_stage": f"""{MARKETING}, {_STAGES} SELECT * FROM stages WHERE stage_order < 99
        OR stage_name IN (SELECT stage FROM clean)""",
    "dim_channel_typed": f"""{MARKETING} SELECT DISTINCT channel AS channel_name,
        {_CHANNEL_TYPE} AS channel_type FROM clean""",
    "dim_campaign": f"""{MARKETING} SELECT DISTINCT campaign AS campaign_name,
        {_CAMPAIGN_TYPE} AS campaign_type FROM clean WHERE campaign IS NOT NULL""",
    "dim_department": _distinct(MARKETING, "department", "department_name"),
    "dim_machine": _distinct(MARKETING, "machine", "machine_name"),
    "dim_information": _distinct(MARKETING, "information", "information_name"),
    "branch_conflicts": _conflicts("branch", "region"),
    "product_conflicts": _conflicts("product", "category"),
    "fact_sales": f"{SALES} SELECT {SALES_FACT} FROM clean",
    "fact_marketing": f"{MARKETING} SELECT {MARKETING_FACT} FROM clean",
    # The later delivery wins, and ship date leads the row order: the same as one load of everything.
    "upsert_update": f"{SALES} SELECT {SALES_FACT} FROM clean",
    "upsert_ignore": f"""{BATCHES} SELECT {SALES_FACT} FROM early UNION ALL
        SELECT {SALES_FACT} FROM late WHERE order_id NOT IN (SELECT order_id FROM early)""",
    "upsert_keep_first": _upsert("COALESCE(a.{c}, b.{c})"),
    "upsert_products": f"""{BATCHES}, a AS (
            SELECT product, category FROM early WHERE product IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY product ORDER BY l_shipdate, p, l_suppkey, category) = 1
        ), b AS (
            SELECT product, category FROM late WHERE product IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY product ORDER BY l_shipdate, p, l_suppkey, category) = 1
        ) SELECT COALESCE(a.product, b.product) AS product_name, COALESCE(a.category, b.category) AS category
        FROM a FULL OUTER JOIN b ON a.product = b.product""",
    "revenue_load": f"{SALES} SELECT {SALES_FACT} FROM clean",
    "marketing_load": f"{MARKETING} SELECT {MARKETING_FACT} FROM clean",
    "pk_duplicates": f"""WITH {_LINES} SELECT 'primary_key' AS "constraint", 'order_id' AS "column",
        COUNT(*) AS n_violations, CAST(MIN(order_id) AS VARCHAR) AS sample_key
        FROM (SELECT order_id FROM complete GROUP BY order_id HAVING COUNT(*) > 1)""",
    "not_null_violations": _tests(
        f"WITH {_LINES}",
        "not_null",
        {c.name: f"{_sales_source(c.name)} IS NULL" for c in FACT_SALES.columns if c.required},
        "order_id",
        "parsed",
    ),
    "length_violations": _tests(
        SALES,
        "max_length",
        {
            c.name: f"length({_sales_source(c.name)}) > {TIGHT_LENGTH}"
            for c in FACT_SALES.columns
            if c.max_length
        },
        "order_id",
        "clean",
    ),
    "numeric_overflow": _tests(
        f"WITH {_LINES}",
        "precision",
        {
            c: f"ABS({c}) >= {_NINES}"
            for c in ("quantity", "revenue", "cost", "profit", "market_size", "budget", "logistics_cost",
                      "marketing_cost")
        },
        "order_id",
        "parsed",
    ),
    "sales_rejects": f"""WITH {_LINES} SELECT order_id, date, region, revenue, concat_ws(',',
            CASE WHEN order_id IS NULL THEN 'order_id' END, CASE WHEN date IS NULL THEN 'date' END,
            CASE WHEN region IS NULL THEN 'region' END, CASE WHEN revenue IS NULL THEN 'revenue' END) AS reasons
        FROM parsed WHERE {_INCOMPLETE}""",
    "upsert_sparse_ids": f"{SALES} SELECT * REPLACE ({_SPARSE} AS order_id) FROM (SELECT {SALES_FACT} FROM clean)",
    "revenue_rebuild": f"{BATCHES} SELECT {SALES_FACT} FROM late",
    "revenue_empty_batch": f"{SALES} SELECT {SALES_FACT} FROM clean",
    "marketing_created_at": f"{MARKETING} SELECT COUNT(*) AS n_orders, COUNT(*) AS n_unchanged, "
    "CAST(0 AS BIGINT) AS n_missing FROM clean",
    "loaded_dim_branch": f"""{BATCHES}, a AS (SELECT branch, region FROM early WHERE branch IS NOT NULL {_LAST_REGION}),
        b AS (SELECT branch, region FROM late WHERE branch IS NOT NULL {_LAST_REGION})
        SELECT COALESCE(b.branch, a.branch) AS branch_name, COALESCE(b.region, a.region) AS region_name
        FROM a FULL OUTER JOIN b ON a.branch = b.branch""",
    "loaded_dim_stage": f"""{MARKETING}, {_STAGES} SELECT * FROM stages WHERE stage_order < 99
        OR stage_name IN (SELECT stage FROM clean)""",
    "loaded_dim_campaign": f"""{MARKETING} SELECT DISTINCT campaign AS campaign_name,
        {_CAMPAIGN_TYPE} AS campaign_type FROM clean WHERE campaign IS NOT NULL""",
    "declared_contract": _declared(),
    "fk_orphans": _orphans(),
    "revenue_by_region": f"""{SALES}, r AS (SELECT region AS region_name, {_BY} FROM clean GROUP BY region),
        t AS (SELECT SUM(revenue) AS all_revenue, SUM(profit) AS all_profit FROM r)
        SELECT r.*, {ratio('revenue', 'all_revenue')} AS revenue_share,
        {ratio('profit', 'all_profit')} AS profit_share FROM r CROSS JOIN t""",
    "region_branch_rollup": f"""{SALES} SELECT region AS region_name, branch AS branch_name,
        CAST(GROUPING(region, branch) AS INTEGER) AS level, {_BY} FROM clean GROUP BY ROLLUP (region, branch)""",
    "revenue_by_category_product": f"""{SALES}, {PRODUCTS} SELECT products.category, product AS product_name, {_BY}
        FROM clean LEFT JOIN products ON product = product_name GROUP BY products.category, product""",
    "top_products_per_category": f"""{SALES}, {PRODUCTS}, g AS (
            SELECT products.category, product AS product_name, {_BY}
            FROM clean JOIN products ON product = product_name GROUP BY products.category, product
        ) SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY revenue DESC, product_name) AS INTEGER)
        AS rank FROM g QUALIFY rank <= 5""",
    "revenue_by_channel": _group(SALES, "channel", "channel_name"),
    "revenue_by_segment": _group(SALES, "customer_segment", "segment_name"),
    "revenue_by_promotion": _group(
        SALES, "promotion_campaign", "promotion_campaign", f", {ratio('SUM(profit)', 'SUM(revenue)')} AS margin"
    ),
    "monthly_trend": f"""{SALES}, m AS (SELECT strftime(date, '%Y-%m') AS year_month, {_BY} FROM clean GROUP BY 1),
        w AS (SELECT *, lag(revenue) OVER (ORDER BY year_month) AS previous_revenue FROM m)
        SELECT *, CAST(revenue - previous_revenue AS {TOTAL}) AS change,
        {ratio('revenue - previous_revenue', 'previous_revenue')} AS change_rate FROM w""",
    "calendar_rollup": f"""{SALES}, c AS (SELECT *, CAST(quarter(date) AS INTEGER) AS quarter,
            strftime(date, '%Y-%m') AS year_month FROM clean)
        SELECT year, quarter, year_month, CAST(GROUPING(year, quarter, year_month) AS INTEGER) AS level, {_BY}
        FROM c GROUP BY ROLLUP (year, quarter, year_month)""",
    "kpi_totals": f"""{SALES} SELECT COUNT(*) AS orders, """
    + ", ".join(
        f"{total(c)} AS {c}"
        for c in ("revenue", "profit", "cost", "market_size", "budget", "logistics_cost", "marketing_cost")
    )
    + f", {ratio('SUM(profit)', 'SUM(revenue)')} AS margin FROM clean",
    "stage_funnel": f"""{MARKETING}, {_STAGES}, s AS (
            SELECT stage_name, stage_order, stage_group, COUNT(order_id) AS orders,
                CAST(COALESCE(SUM(revenue), 0) AS {TOTAL}) AS revenue,
                {average('conversion_proxy', 6)} AS avg_conversion
            FROM stages LEFT JOIN clean ON stage = stage_name GROUP BY ALL
        ), w AS (SELECT s.*, b.orders AS previous_orders FROM s LEFT JOIN s AS b ON b.stage_order = s.stage_order - 1)
        SELECT *, {ratio('orders', 'previous_orders', 0, 0)} AS step_ratio FROM w""",
    "channel_effectiveness": f"""{MARKETING} SELECT {_CHANNEL_TYPE} AS channel_type, channel AS channel_name, {_EFFECT}
        FROM clean GROUP BY channel""",
    "channel_type_effectiveness": f"{MARKETING} SELECT {_CHANNEL_TYPE} AS channel_type, {_EFFECT} FROM clean GROUP BY 1",
    "campaign_performance": f"""{MARKETING} SELECT {_CAMPAIGN_TYPE} AS campaign_type, campaign AS campaign_name, {_PERF}
        FROM clean GROUP BY campaign""",
    "campaign_type_performance": f"{MARKETING} SELECT {_CAMPAIGN_TYPE} AS campaign_type, {_PERF} FROM clean GROUP BY 1",
    "target_vs_actual": f"""{MARKETING} SELECT channel AS channel_name, strftime(date, '%Y-%m') AS year_month,
        {total('revenue')} AS revenue, {total('target')} AS target,
        CAST(SUM(revenue - COALESCE(target, 0)) AS {TOTAL}) AS target_gap,
        {ratio('SUM(revenue)', 'SUM(target)')} AS achievement_rate FROM clean GROUP BY 1, 2""",
    "campaign_roi": f"""{MARKETING}, f AS (SELECT {MARKETING_FACT} FROM clean)
        SELECT campaign_name, {total('profit')} AS profit, {total('budget')} AS budget,
        {ratio('SUM(profit)', 'SUM(budget)')} AS roi, {average('roi_marketing_calc', 6)} AS avg_roi
        FROM f GROUP BY campaign_name""",
    "cost_breakdown": f"""{MARKETING}, m AS (SELECT machine, """
    + ", ".join(f"{total(c)} AS {c}" for c in _COMPONENTS)
    + f""", CAST({' + '.join(f'SUM({c})' for c in _COMPONENTS)} AS {TOTAL}) AS every,
            {average('unit_cost', 6)} AS avg_unit_cost,
            {average('cost_per_machine_unit', 6)} AS avg_cost_per_machine_unit FROM clean GROUP BY machine) """
    + " UNION ALL ".join(
        f"""SELECT machine AS machine_name, '{c}' AS component, {c} AS amount, {ratio(c, 'every')} AS share,
        avg_unit_cost, avg_cost_per_machine_unit FROM m"""
        for c in _COMPONENTS
    ),
    "operations_summary": f"""{MARKETING} SELECT department AS department_name, machine AS machine_name,
        information AS information_name, COUNT(*) AS orders, {total('inventory_level')} AS inventory,
        {total('calls')} AS calls, {total('waiting_time')} AS waiting_time,
        {average('inventory_level')} AS avg_inventory, {average('calls')} AS avg_calls,
        {average('waiting_time')} AS avg_waiting_time FROM clean GROUP BY department, machine, information""",
    "market_metrics": f"""{MARKETING} SELECT strftime(date, '%Y-%m') AS year_month,
        {total('market_size')} AS market_size, {total('revenue')} AS revenue,
        {average('market_size')} AS avg_market_size, {average('market_share', 6)} AS avg_market_share,
        {ratio('SUM(revenue)', 'SUM(market_size)')} AS revenue_of_market FROM clean GROUP BY 1""",
}
ORACLES["loaded_dim_product"] = ORACLES["upsert_products"]

ORACLES["revenue_two_spellings"] = ORACLES["revenue_load"]
ORACLES["kept_contract"] = ORACLES["declared_contract"]
ORACLES["kept_length_violations"] = ORACLES["length_violations"]
ORACLES["missing_headers"] = f"""
WITH {_LINES}, n AS (SELECT count(*) AS n_rows FROM lines)
SELECT staged, mart, "column", n_rows
FROM n, (VALUES ('raw_sales', 'marketing', 'stage'), ('cut_sales', 'revenue', 'date'), ('cut_sales', 'revenue', 'region'),
                ('cut_sales', 'marketing', 'date'), ('cut_sales', 'marketing', 'stage')) AS lacking(staged, mart, "column")
"""

# A report from the kept state gives the same rows as from the fact.
ORACLES |= {
    f"kept_{name}": ORACLES[name]
    for name in (
        *("revenue_by_region", "top_products_per_category", "calendar_rollup", "kpi_totals"),
        *("stage_funnel", "target_vs_actual", "cost_breakdown", "operations_summary"),
    )
}
