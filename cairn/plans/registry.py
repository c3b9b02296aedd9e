"""Registered queries over the driver tables and their DuckDB SQL oracles.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them),
so its work grows with the data. Each oracle states the same result in plain SQL;
computed columns carry the same names on both sides.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .rfm import rfm_analysis, rfm_base, rfm_segment_counts

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-08-02"


def money_as_double(df: DataFrame) -> DataFrame:
    """Decimal result columns as DOUBLE, so results compare the same whichever way
    a client converts them (exact decimal -> nearest double on both engines)."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    """Register a query (money columns returned as DOUBLE) and its oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return money_as_double(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table. Registered queries are defined in UTC (ISO marks with
    ``Z`` and offsets), so the session time zone is pinned to UTC here."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- RFM

# Recency scores from, to; mean from, to (upper end excluded); label. Means
# are multiples of a half from 1 to 5.
_RFM_SEGMENTS = """
    (5, 5, 0, 2, 'New Customers'), (5, 5, 2, 3, 'Potential Loyalist'), (5, 5, 3, 6, 'Champions'),
    (4, 4, 0, 1.5, 'Promising'), (4, 4, 1.5, 3, 'Potential Loyalist'), (4, 4, 3, 6, 'Loyal Customer'),
    (3, 3, 0, 2.5, 'Needs Attention'), (3, 3, 3, 3.5, 'About to Sleep'),
    (3, 3, 2.5, 3, 'Loyal Customer'), (3, 3, 3.5, 6, 'Loyal Customer'),
    (1, 2, 0, 2.5, 'Hibernating'), (1, 2, 2.5, 4.5, 'At Risk'), (1, 2, 4.5, 6, 'Cannot Lose Them')"""


def _rfm_oracle(model_filter: str, recent_filter: str, money: str = "DOUBLE") -> str:
    return f"""
WITH orders_of AS (
    SELECT o_custkey AS c, o_orderdate AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS amt, o_orderkey AS tb
    FROM orders
),
totals AS (
    SELECT c, max(d) AS last_d, count(c) AS n, CAST(sum(amt) AS DECIMAL(38,2)) AS total
    FROM orders_of WHERE {model_filter} GROUP BY c
),
recent AS (
    SELECT c, arg_max(amt, (d, tb)) AS last_amt, CAST(sum(amt) AS DECIMAL(38,2)) AS total,
           count(amt) AS n, round(stddev_pop(CAST(amt AS DOUBLE)), 4) AS std
    FROM orders_of WHERE {recent_filter} GROUP BY c
),
ranked AS (
    SELECT *, date_diff('day', CAST(last_d AS DATE), DATE '{AS_OF}') AS age,
           ntile(5) OVER (ORDER BY total NULLS LAST, c NULLS LAST) AS ms,
           ntile(5) OVER (ORDER BY n NULLS LAST, c NULLS LAST) AS fs,
           ntile(5) OVER (ORDER BY date_diff('day', CAST(last_d AS DATE), DATE '{AS_OF}') DESC NULLS FIRST, c NULLS LAST) AS rs
    FROM totals
),
segment(r_from, r_to, m_from, m_to, label) AS (VALUES {_RFM_SEGMENTS})
SELECT ranked.c AS CUSTOMER_ID, last_d AS LASTBUY, CAST(age AS BIGINT) AS RECENCY, ranked.n AS FREQUENCY,
       CAST(ranked.total AS {money}) AS MONETARY, CAST(ms AS INTEGER) AS MONETARY_SCORE,
       CAST(fs AS INTEGER) AS FREQUENCY_SCORE, CAST(rs AS INTEGER) AS RECENCY_SCORE,
       CAST((fs + ms) / 2 AS DOUBLE) AS mean_monetary_frequency, label AS CUSTOMER_TYPE,
       CAST(last_amt AS {money}) AS AMOUNT_LAST_40D, CAST(recent.total AS {money}) AS TOTAL_MONETARY_40D,
       CAST(recent.total AS DOUBLE) / nullif(recent.n, 0) AS MEAN_MONETARY_40D, std AS STD_MONETARY_40D
FROM ranked LEFT JOIN recent ON recent.c = ranked.c
LEFT JOIN segment ON rs BETWEEN r_from AND r_to AND (fs + ms) / 2 >= m_from AND (fs + ms) / 2 < m_to
"""


_RFM_REFERENCE_SQL = _rfm_oracle(
    "d >= LAST_DAY(d) - INTERVAL 1 YEAR", "d >= LAST_DAY(d) - INTERVAL 40 DAY"
)
_RFM_AS_OF_SQL = _rfm_oracle(
    f"d >= DATE '{AS_OF}' - INTERVAL 1 YEAR",
    f"d >= DATE '{AS_OF}' - INTERVAL 40 DAY AND d >= DATE '{AS_OF}' - INTERVAL 1 YEAR",
)


def _orders_rfm(spark, sf_dir, window="reference", amount="CAST(o_totalprice AS DECIMAL(18,2))"):
    """The analysis over orders; the last digits of a deviation depend on the order of
    addition, so it is rounded here."""
    rfm = rfm_analysis(
        table(spark, sf_dir, "orders").withColumn("o_totalprice", F.expr(amount)),
        customer="o_custkey",
        date="o_orderdate",
        amount="o_totalprice",
        as_of=AS_OF,
        tiebreak="o_orderkey",
        window=window,
    )
    return rfm.withColumn("STD_MONETARY_40D", F.round("STD_MONETARY_40D", 4))


@register("rfm_analysis", _RFM_REFERENCE_SQL)
def q_rfm_analysis(spark, sf_dir):
    return _orders_rfm(spark, sf_dir)


@register(
    "rfm_segment_counts",
    f"""SELECT CUSTOMER_TYPE, RECENCY_SCORE, COUNT(*) AS customers,
               CAST(SUM(MONETARY) AS DOUBLE) AS monetary
        FROM ({_rfm_oracle("d >= LAST_DAY(d) - INTERVAL 1 YEAR", "d >= LAST_DAY(d) - INTERVAL 40 DAY",
                           "DECIMAL(38,2)")}) r
        GROUP BY CUSTOMER_TYPE, RECENCY_SCORE""",
)
def q_rfm_segment_counts(spark, sf_dir):
    return rfm_segment_counts(_orders_rfm(spark, sf_dir))


@register("rfm_as_of_window", _RFM_AS_OF_SQL)
def q_rfm_as_of_window(spark, sf_dir):
    return _orders_rfm(spark, sf_dir, window="as_of")


_SMALL = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,5))"


@register(
    "rfm_small_amounts",
    _RFM_REFERENCE_SQL.replace("CAST(o_totalprice AS DECIMAL(18,2))", _SMALL).replace("DECIMAL(38,2)", "DECIMAL(38,5)"),
)
def q_rfm_small_amounts(spark, sf_dir):
    """Amounts of five decimal places keep them."""
    return _orders_rfm(spark, sf_dir, amount=_SMALL)


@register(
    "rfm_today",
    """SELECT o_custkey AS CUSTOMER_ID, date_diff('day', CAST(max(o_orderdate) AS DATE), current_date) AS RECENCY
       FROM orders GROUP BY o_custkey""",
)
def q_rfm_today(spark, sf_dir):
    """Recency counted to the current date."""
    orders = table(spark, sf_dir, "orders")
    return rfm_base(orders, "o_custkey", "o_orderdate", "o_totalprice").select("CUSTOMER_ID", "RECENCY")


# ---------------------------------------------------------------- ranking

@register(
    "ntile_scores",
    """
    SELECT l_orderkey, l_linenumber,
           ntile(5) OVER (ORDER BY l_extendedprice NULLS LAST, l_orderkey, l_linenumber) AS price_score,
           ntile(5) OVER (ORDER BY l_quantity NULLS LAST, l_orderkey, l_linenumber) AS quantity_score,
           ntile(7) OVER (ORDER BY l_shipdate DESC NULLS FIRST, l_orderkey DESC, l_linenumber DESC) AS date_score
    FROM lineitem
    """,
)
def q_ntile_scores(spark, sf_dir):
    """Several global NTILEs of one table: boundaries by sketch and counting rounds."""
    from ..operators.boundaries import Order, ntile_scores

    key = [Order("l_orderkey"), Order("l_linenumber")]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate")
    by_value = {"price_score": [Order("l_extendedprice"), *key], "quantity_score": [Order("l_quantity"), *key]}
    by_date = {"date_score": [Order("l_shipdate", descending=True), *[Order(o.column, descending=True) for o in key]]}
    scored = ntile_scores(ntile_scores(lines, by_value, 5), by_date, 7)
    return scored.select("l_orderkey", "l_linenumber", *by_value, *by_date)


@register(
    "ntile_distributed",
    """SELECT l_partkey, CAST(revenue AS DOUBLE) AS revenue,
              CAST(NTILE(10) OVER (ORDER BY revenue ASC NULLS LAST, l_partkey ASC) AS INTEGER) AS revenue_decile
       FROM (SELECT l_partkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
             FROM lineitem GROUP BY l_partkey) t""",
)
def q_ntile_distributed(spark, sf_dir):
    from ..operators.ranking import distributed_ntile

    rev = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue")
    )
    return distributed_ntile(
        rev, 10, [F.col("revenue").asc_nulls_last(), F.col("l_partkey").asc()], "revenue_decile"
    )


@register(
    "latest_per_key",
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
           SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
           FROM events) t WHERE rn = 1""",
)
def q_latest_per_key(spark, sf_dir):
    from ..operators.latest import latest_per_key

    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


@register(
    "window_stats_per_key",
    """SELECT user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS mean,
              ROUND(STDDEV_POP(CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)), 4) AS std,
              COUNT(*) AS "rows"
       FROM events GROUP BY user_id""",
)
def q_window_stats_per_key(spark, sf_dir):
    from ..operators.latest import key_stats

    ev = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = key_stats(ev, ["user_id"], "value")
    return out.withColumns({"total": F.col("total").cast("decimal(38,2)"), "std": F.round("std", 4)})


@register(
    "window_stats_null_key",
    """SELECT event_id, nullif(user_id % 7, 0) AS k,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY nullif(user_id % 7, 0)) AS DOUBLE) AS k_sum,
              COUNT(*) OVER (PARTITION BY nullif(user_id % 7, 0)) AS k_rows
       FROM events""",
)
def q_window_stats_null_key(spark, sf_dir):
    """Rows with a NULL key are a group of their own."""
    from ..operators.latest import attach_key_stats

    ev = table(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("user_id") % 7, F.lit(0)).alias("k"), F.col("value").cast("decimal(18,2)").alias("value")
    )
    return attach_key_stats(ev, ["k"], "value", prefix="k_").select("event_id", "k", "k_sum", "k_rows")


@register(
    "latest_per_key_map",
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id,
              json_extract_string(arg_max(props, (ts, event_id)), '$.k') AS k
       FROM events GROUP BY user_id""",
)
def q_latest_per_key_map(spark, sf_dir):
    """Rows that carry a map, which Spark cannot order."""
    from ..operators.latest import latest_per_key

    ev = table(spark, sf_dir, "events").withColumn("props", F.from_json("props", "map<string,string>"))
    out = latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", F.col("props")["k"].alias("k"))


@register(
    "window_stats_per_row",
    """SELECT event_id, user_id,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id) AS DOUBLE) AS user_sum,
              COUNT(*) OVER (PARTITION BY user_id) AS user_rows
       FROM events""",
)
def q_window_stats_per_row(spark, sf_dir):
    from ..operators.latest import attach_key_stats

    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("value")
    )
    out = attach_key_stats(ev, ["user_id"], "value", prefix="user_")
    return out.select(
        "event_id", "user_id", F.col("user_sum").cast("decimal(38,2)").alias("user_sum"), "user_rows"
    )


# ---------------------------------------------------------------- columns

@register(
    "remove_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
              l_returnflag, l_shipdate FROM lineitem""",
)
def q_remove_columns(spark, sf_dir):
    from ..operators.columns import remove_columns

    return remove_columns(table(spark, sf_dir, "lineitem"), ["l_tax", "l_discount", "l_linestatus"])


@register(
    "drop_by_prefix",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
              l_returnflag FROM lineitem""",
)
def q_drop_by_prefix(spark, sf_dir):
    from ..operators.columns import drop_by_prefix

    return drop_by_prefix(table(spark, sf_dir, "lineitem"), ["l_ship", "l_line"])


@register(
    "strip_prefixes",
    """SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
              c_mktsegment AS segment FROM customer""",
)
def q_strip_prefixes(spark, sf_dir):
    from ..operators.columns import strip_prefixes

    return strip_prefixes(table(spark, sf_dir, "customer"), ["c_", "c_mkt"])


@register(
    "rename_columns",
    """SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus, o_totalprice,
              o_orderdate, o_orderpriority FROM orders""",
)
def q_rename_columns(spark, sf_dir):
    from ..operators.columns import rename_columns

    return rename_columns(
        table(spark, sf_dir, "orders"),
        [
            {"column_name": "o_orderkey", "new_column_name": "order_id"},
            {"column_name": "o_custkey", "new_column_name": "customer_id"},
            {"column_name": "order_id", "new_column_name": "order_key"},
        ],
    )


@register(
    "prepare_columns",
    """SELECT l_orderkey AS orderkey, l_partkey AS partkey, l_suppkey AS suppkey,
              l_quantity AS quantity, l_extendedprice AS extendedprice, l_discount AS discount,
              l_returnflag AS returnflag, l_shipdate AS shipdate FROM lineitem""",
)
def q_prepare_columns(spark, sf_dir):
    from ..operators.columns import prepare_columns

    return prepare_columns(
        table(spark, sf_dir, "lineitem"),
        columns_to_remove=["l_tax"],
        column_prefixes_to_remove=["l_line"],
        remove_prefix_from_columns=["l_"],
    )


@register(
    "text_transform",
    """SELECT p_partkey, UPPER(p_name) AS p_name, LOWER(p_brand) AS p_brand,
              UPPER(TRIM(p_type)) AS p_type, p_size, p_retailprice FROM part""",
)
def q_text_transform(spark, sf_dir):
    from ..operators.columns import text_transform

    return text_transform(
        table(spark, sf_dir, "part"),
        [
            {"column_name": "p_name", "transformation_to_apply": "upper"},
            {"column_name": "p_brand", "transformation_to_apply": "lower"},
            {"column_name": "p_type", "transformation_to_apply": "trim"},
            {"column_name": "p_type", "transformation_to_apply": "upper"},
        ],
    )


_CLEAN = r"""'[<>:"/\\|?*\x00-\x1F\x7F]'"""


@register(
    "clean_strings",
    f"""SELECT doc_id, regexp_replace(text, {_CLEAN}, '', 'g') AS text,
               regexp_replace(lang, {_CLEAN}, '', 'g') AS lang,
               regexp_replace(source, {_CLEAN}, '', 'g') AS source, n_chars
        FROM documents""",
)
def q_clean_strings(spark, sf_dir):
    from ..operators.columns import clean_strings

    return clean_strings(table(spark, sf_dir, "documents"))


@register(
    "clean_strings_pages",
    f"""SELECT page_id, regexp_replace(url, {_CLEAN}, '', 'g') AS url, regexp_replace(html, {_CLEAN}, '', 'g') AS html FROM pages""",
)
def q_clean_strings_pages(spark, sf_dir):
    from ..operators.columns import clean_strings

    return clean_strings(table(spark, sf_dir, "pages"))


# ---------------------------------------------------------------- flatten

@register(
    "flatten_json",
    """SELECT json_extract_string(props, '$.k') AS PROPS__K, event_id, ts, user_id, event_type, value
       FROM events""",
)
def q_flatten_json(spark, sf_dir):
    from ..operators.flatten import flatten_columns

    return flatten_columns(table(spark, sf_dir, "events"), ["props"])


def _packed_customer(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        F.to_json(
            F.struct(
                F.col("c_name").alias("Customer Name"),
                F.col("c_nationkey").alias("nation-key"),
                F.col("c_mktsegment").alias("segment"),
                F.col("c_custkey").alias("id"),
            )
        ).alias("attrs"),
    )


@register(
    "flatten_auto",
    """SELECT c_name AS ATTRS__CUSTOMER_NAME, CAST(c_custkey AS VARCHAR) AS ATTRS__ID,
              CAST(c_nationkey AS VARCHAR) AS ATTRS__NATION_KEY, c_mktsegment AS ATTRS__SEGMENT,
              c_custkey, c_name
       FROM customer""",
)
def q_flatten_auto(spark, sf_dir):
    from ..operators.flatten import flatten_columns

    return flatten_columns(_packed_customer(spark, sf_dir), columns=None)


# ---------------------------------------------------------------- reshape

@register(
    "unpivot_columns",
    """SELECT * FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
                              FROM lineitem)
                     ON l_quantity, l_extendedprice, l_discount, l_tax
                     INTO NAME measure VALUE amount)""",
)
def q_unpivot_columns(spark, sf_dir):
    from ..operators.reshape import unpivot_columns

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return unpivot_columns(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "measure", "amount")


_SPARSE_LINEITEM = """SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN l_discount END AS disc_r,
        CASE WHEN l_returnflag = 'A' THEN l_tax END AS tax_a FROM lineitem"""


@register(
    "unpivot_keep_nulls",
    f"""SELECT * FROM ({_SPARSE_LINEITEM}) t
        UNPIVOT INCLUDE NULLS (amount FOR measure IN (disc_r, tax_a))""",
)
def q_unpivot_keep_nulls(spark, sf_dir):
    from ..operators.reshape import unpivot_columns

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.col("l_discount")).alias("disc_r"),
        F.when(F.col("l_returnflag") == "A", F.col("l_tax")).alias("tax_a"),
    )
    return unpivot_columns(li, ["disc_r", "tax_a"], "measure", "amount", include_nulls=True)


@register(
    "unpivot_drop_nulls",
    f"""SELECT * FROM (UNPIVOT ({_SPARSE_LINEITEM})
                     ON disc_r, tax_a INTO NAME measure VALUE amount)""",
)
def q_unpivot_drop_nulls(spark, sf_dir):
    from ..operators.reshape import unpivot_columns

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.col("l_discount")).alias("disc_r"),
        F.when(F.col("l_returnflag") == "A", F.col("l_tax")).alias("tax_a"),
    )
    return unpivot_columns(li, ["disc_r", "tax_a"], "measure", "amount")


_STD_CUSTOMER = {
    "STD_ID": {"value": "c_custkey", "is_column": True},
    "STD_NAME": {"value": "c_name", "is_column": True},
    "STD_BALANCE": {"value": "c_acctbal", "is_column": True},
    "STD_ORIGIN": {"value": "crm", "is_column": False},
    "STD_EMPTY": {"value": None, "is_column": False},
    "STD_ZERO": {"value": 0, "is_column": False},
}
_STD_SUPPLIER = {
    "STD_ID": {"value": "s_suppkey", "is_column": True},
    "STD_NAME": {"value": "s_name", "is_column": True},
    "STD_BALANCE": {"value": "s_acctbal", "is_column": True},
    "STD_ORIGIN": {"value": "erp", "is_column": False},
    "STD_EMPTY": {"value": "", "is_column": False},
    "STD_ZERO": {"value": False, "is_column": False},
}
_STD_CUSTOMER_SQL = """SELECT c_custkey AS STD_ID, c_name AS STD_NAME, c_acctbal AS STD_BALANCE,
        'crm' AS STD_ORIGIN, CAST(NULL AS VARCHAR) AS STD_EMPTY, CAST(NULL AS VARCHAR) AS STD_ZERO
    FROM customer"""
_STD_SUPPLIER_SQL = """SELECT s_suppkey AS STD_ID, s_name AS STD_NAME, s_acctbal AS STD_BALANCE,
        'erp' AS STD_ORIGIN, CAST(NULL AS VARCHAR) AS STD_EMPTY, CAST(NULL AS VARCHAR) AS STD_ZERO
    FROM supplier"""


@register("standardize", _STD_CUSTOMER_SQL)
def q_standardize(spark, sf_dir):
    from ..operators.reshape import standardize

    return standardize(table(spark, sf_dir, "customer"), _STD_CUSTOMER)


@register("standardized_union", f"{_STD_CUSTOMER_SQL} UNION ALL {_STD_SUPPLIER_SQL}")
def q_standardized_union(spark, sf_dir):
    from ..operators.reshape import standardize, union_all
    from ..sinks.writers import create_view

    parts = [
        standardize(table(spark, sf_dir, "customer"), _STD_CUSTOMER),
        standardize(table(spark, sf_dir, "supplier"), _STD_SUPPLIER),
    ]
    create_view(union_all(parts), "standardized_all")
    return spark.table("standardized_all")


@register(
    "concat_by_name",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment
       FROM customer
       UNION ALL BY NAME
       SELECT s_suppkey AS key, s_name AS name, s_acctbal AS acctbal, s_nationkey AS nationkey
       FROM supplier""",
)
def q_concat_by_name(spark, sf_dir):
    from ..operators.reshape import concat_by_name

    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"),
    )
    return concat_by_name([c, s])


# ---------------------------------------------------------------- filters

@register(
    "filter_by_params",
    "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def q_filter_by_params(spark, sf_dir):
    from ..operators.filters import filter_by_params

    return filter_by_params(
        table(spark, sf_dir, "orders"),
        [{"key": "o_orderstatus", "value": "F"}, {"key": "o_orderpriority", "value": "1-URGENT"}],
    )


@register(
    "exclude_by_params",
    "SELECT * FROM orders WHERE NOT COALESCE(o_orderstatus = 'P' AND o_orderpriority = '5-LOW', false)",
)
def q_exclude_by_params(spark, sf_dir):
    from ..operators.filters import exclude_by_params

    return exclude_by_params(
        table(spark, sf_dir, "orders"),
        [{"key": "o_orderstatus", "value": "P"}, {"key": "o_orderpriority", "value": "5-LOW"}],
    )


# ---------------------------------------------------------------- merge

def _merge_source_sql() -> str:
    return """
    SELECT c_custkey, c_nationkey, c_acctbal + 100 AS c_acctbal, 'UPDATED' AS c_mktsegment
        FROM customer WHERE c_nationkey = 1
    UNION ALL
    SELECT c_custkey, c_nationkey, c_acctbal + 200 AS c_acctbal, 'UPDATED' AS c_mktsegment
        FROM customer WHERE c_nationkey = 1
    UNION ALL
    SELECT c_custkey + 1000000000 AS c_custkey, c_nationkey, c_acctbal, 'NEW' AS c_mktsegment
        FROM customer WHERE c_nationkey = 2
    UNION ALL
    SELECT c_custkey + 1000000000 AS c_custkey, c_nationkey, c_acctbal, 'NEW' AS c_mktsegment
        FROM customer WHERE c_nationkey = 2
    UNION ALL
    SELECT CAST(NULL AS BIGINT) AS c_custkey, c_nationkey, c_acctbal, 'NULLKEY' AS c_mktsegment
        FROM customer WHERE c_nationkey = 3
    UNION ALL
    SELECT c_custkey, c_nationkey, c_acctbal, CAST(NULL AS STRING) AS c_mktsegment
        FROM customer WHERE c_nationkey = 4"""


_MERGE_SQL = f"""
WITH src AS ({_merge_source_sql()}),
winners AS (
    SELECT * FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY c_custkey
            ORDER BY c_nationkey DESC NULLS LAST, c_acctbal DESC NULLS LAST, c_mktsegment DESC NULLS LAST) AS rn
        FROM src WHERE c_custkey IS NOT NULL) t WHERE rn = 1
)
SELECT t.c_custkey, t.c_name,
       CASE WHEN w.c_custkey IS NOT NULL THEN w.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
       CASE WHEN w.c_custkey IS NOT NULL THEN w.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
       CASE WHEN w.c_custkey IS NOT NULL THEN w.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment
FROM customer t LEFT JOIN winners w ON t.c_custkey = w.c_custkey
UNION ALL
SELECT s.c_custkey, CAST(NULL AS VARCHAR) AS c_name, s.c_nationkey, s.c_acctbal, s.c_mktsegment
FROM src s WHERE NOT EXISTS (SELECT 1 FROM customer t WHERE t.c_custkey = s.c_custkey)
"""


@register("merge_upsert", _MERGE_SQL)
def q_merge_upsert(spark, sf_dir):
    from ..operators.merge import merge_upsert

    customer = table(spark, sf_dir, "customer")
    customer.createOrReplaceTempView("customer")
    source = spark.sql(_merge_source_sql())
    return merge_upsert(customer, source, ["c_custkey"], ["c_custkey"])


@register("merge_upsert_shuffled", _MERGE_SQL)
def q_merge_upsert_shuffled(spark, sf_dir):
    """The merge after the source was shuffled by another column."""
    from ..operators.merge import merge_upsert

    customer = table(spark, sf_dir, "customer")
    customer.createOrReplaceTempView("customer")
    source = spark.sql(_merge_source_sql()).repartition("c_nationkey")
    return merge_upsert(customer, source, ["c_custkey"], ["c_custkey"])


# ---------------------------------------------------------------- SQL source

_SQL_TEMPLATE = """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = {{status}} AND o_totalprice >= {{ min_price }}"""


@register(
    "sql_params",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'O' AND o_totalprice >= 100000""",
)
def q_sql_params(spark, sf_dir):
    from ..sources.tables import read_sql

    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return read_sql(
        spark,
        _SQL_TEMPLATE,
        parameters=[{"key": "status", "value": "O"}, {"key": "min_price", "value": 100000}],
    )


# ---------------------------------------------------------------- incremental loads

_MARK = "2024-01-15T00:00:00Z"


@register("incremental_filter", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def q_incremental_filter(spark, sf_dir):
    from ..streaming.watermark import incremental_filter

    return incremental_filter(table(spark, sf_dir, "events"), "ts", _MARK)


@register(
    "incremental_filter_day",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'",
)
def q_incremental_filter_day(spark, sf_dir):
    from ..streaming.watermark import incremental_filter

    return incremental_filter(table(spark, sf_dir, "events"), "ts", "2024-01-15T13:45:10Z", floor_to_day=True)


@register(
    "incremental_filter_historical",
    "SELECT * FROM events",
)
def q_incremental_filter_historical(spark, sf_dir):
    from ..streaming.watermark import incremental_filter

    return incremental_filter(table(spark, sf_dir, "events"), "ts", _MARK, is_historical=True)


@register(
    "next_watermark",
    """SELECT strftime(MAX(ts), '%Y-%m-%dT%H:%M:%SZ') AS last_update,
              COUNT(ts) AS values_seen, CAST(0 AS BIGINT) AS values_unparsed
       FROM events""",
)
def q_next_watermark(spark, sf_dir):
    from ..streaming.watermark import next_watermark

    return next_watermark(table(spark, sf_dir, "events"), "ts")


def _events_as_text_spark(ev):
    """Events with the timestamp rendered as text in layouts that depend on the
    event type (ISO with offset, the extraction layouts, and junk)."""
    t = F.col("ts")
    return ev.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("value").cast("string").alias("value_text"),
        F.when(F.col("event_type") == "click", F.date_format(t, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_type") == "view", F.date_format(t, "yyyy-MM-dd'T'HHmmss"))
        .when(F.col("event_type") == "error", F.date_format(t, "dd/MM/yyyy HH:mm"))
        .when(F.col("event_type") == "purchase", F.date_format(t, "yyyy-MM-dd"))
        .otherwise(F.lit("not a date"))
        .alias("ts_text"),
    )


_EVENTS_AS_TEXT_SQL = """SELECT event_id, user_id, event_type, CAST(value AS VARCHAR) AS value_text,
    CASE event_type
        WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H%M%S')
        WHEN 'error' THEN strftime(ts, '%d/%m/%Y %H:%M')
        WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d')
        ELSE 'not a date' END AS ts_text
    FROM events"""

_PARSE_TS_SQL = """COALESCE(
        try_strptime(ts_text, '%Y-%m-%dT%H%M%S.%f'),
        try_strptime(ts_text, '%Y-%m-%d %H:%M:%S'),
        try_strptime(ts_text, '%d/%m/%Y %H:%M'),
        try_strptime(ts_text, '%Y-%m-%d'),
        try_strptime(ts_text, '%Y-%m-%dT%H%M%S'))"""


@register(
    "next_watermark_day",
    f"""SELECT strftime(date_trunc('day', MAX({_PARSE_TS_SQL})), '%Y-%m-%dT%H:%M:%SZ') AS last_update,
               COUNT(ts_text) AS values_seen,
               COUNT(*) FILTER (WHERE ts_text IS NOT NULL AND {_PARSE_TS_SQL} IS NULL) AS values_unparsed
        FROM ({_EVENTS_AS_TEXT_SQL}) t""",
)
def q_next_watermark_day(spark, sf_dir):
    from ..functions.timestamps import EXTRACTION_FORMATS
    from ..streaming.watermark import next_watermark

    text = _events_as_text_spark(table(spark, sf_dir, "events"))
    return next_watermark(text, "ts_text", formats=EXTRACTION_FORMATS, floor="day")


@register(
    "coerce_schema",
    f"""SELECT TRY_CAST(event_id AS BIGINT) AS event_id,
               TRY_CAST(user_id AS TINYINT) AS user_id,
               TRY_CAST(value_text AS DOUBLE) AS value,
               {_PARSE_TS_SQL} AS ts,
               event_type,
               CAST(NULL AS VARCHAR) AS missing_col
        FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
                     CASE WHEN event_type = 'signup' THEN value_text || 'x' ELSE value_text END AS value_text,
                     ts_text, event_type
              FROM ({_EVENTS_AS_TEXT_SQL}) a) t""",
)
def q_coerce_schema(spark, sf_dir):
    from ..operators.coerce import coerce_schema

    text = _events_as_text_spark(table(spark, sf_dir, "events")).select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "signup", F.concat(F.col("value_text"), F.lit("x")))
        .otherwise(F.col("value_text"))
        .alias("value_text"),
        F.col("ts_text").alias("ts"),
        "event_type",
        F.lit("dropped").alias("undeclared"),
    )
    text = text.withColumnRenamed("value_text", "value")
    return coerce_schema(
        text,
        {
            "event_id": "int64",
            "user_id": "int8",
            "value": "float64",
            "ts": "timestamp[ns]",
            "event_type": "string",
            "missing_col": "string",
        },
    )


# ---------------------------------------------------------------- files, pages, objects

def _scratch(spark, name: str) -> str:
    """Scratch folder under the session's checkpoint folder."""
    from ..session import scratch_path

    return scratch_path(spark, name, remove_at_exit=True)


JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_EVENT_ITEM_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def _land_event_pages(spark, sf_dir, path, predicate=None, page_size=50, withhold=None, changed=None):
    """Land events as shape-A API pages: ``{data: [...], meta: {total}}``, 50
    records per page (page = event_id div 50, so a page never grows). ``changed``: new
    values of columns."""
    ev = table(spark, sf_dir, "events").withColumns(changed or {})
    if predicate is not None:
        ev = ev.filter(predicate)
    pages = ev.groupBy(F.floor(F.col("event_id") / page_size).alias("page")).agg(
        F.collect_list(F.struct(*[F.col(c) for c in ev.columns])).alias("data")
    )
    n = ev.count()  # the listing total an API would report
    if withhold is not None:
        pages = pages.filter(F.col("page") != withhold)
    pages.select("data", F.struct(F.lit(n).cast("bigint").alias("total")).alias("meta")).write.mode(
        "overwrite"
    ).option("timestampNTZFormat", JSON_TS_FORMAT).json(path)
    return n


@register("read_pages", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_read_pages(spark, sf_dir):
    from ..sources.pages import read_pages

    path = _scratch(spark, "pages")
    _land_event_pages(spark, sf_dir, path)
    return read_pages(spark, path, items="data", item_schema=_EVENT_ITEM_DDL)


@register(
    "page_completeness",
    """SELECT COUNT(*) FILTER (WHERE event_id // 50 <> 1) AS records, COUNT(*) AS expected, false AS complete
       FROM events""",
)
def q_page_completeness(spark, sf_dir):
    from ..sources.pages import page_completeness_a

    path = _scratch(spark, "pages")
    _land_event_pages(spark, sf_dir, path, withhold=1)  # its second page is missing
    pages = spark.read.schema(
        f"data ARRAY<STRUCT<{_EVENT_ITEM_DDL}>>, meta STRUCT<total: BIGINT>"
    ).json(path)
    return page_completeness_a(pages)


@register(
    "write_by_date_roundtrip",
    """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS extract_date, COUNT(*) AS events,
              CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
       FROM events GROUP BY 1""",
)
def q_write_by_date_roundtrip(spark, sf_dir):
    from ..sinks.writers import write_by_date

    path = _scratch(spark, "bydate")
    write_by_date(table(spark, sf_dir, "events"), path, "ts")
    back = spark.read.parquet(path)
    return back.groupBy(F.date_format("extract_date", "yyyy-MM-dd").alias("extract_date")).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("value_sum"),
    )


_CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@register("csv_roundtrip", "SELECT * FROM customer")
def q_csv_roundtrip(spark, sf_dir):
    from ..sources.files import read_file

    path = _scratch(spark, "csv")
    table(spark, sf_dir, "customer").write.option("sep", ";").option("header", "true").csv(path)
    return read_file(spark, path, "csv", delimiter=";", header=True, schema=_CUSTOMER_DDL)


@register("csv_infer_roundtrip", "SELECT * FROM customer")
def q_csv_infer_roundtrip(spark, sf_dir):
    """Schema inferred from the file (no schema given), then aligned to the table."""
    from ..operators.merge import align_to_schema
    from ..sources.files import read_file

    src = table(spark, sf_dir, "customer")
    path = _scratch(spark, "csv")
    src.write.option("sep", "|").option("header", "true").csv(path)
    return align_to_schema(read_file(spark, path, "csv", delimiter="|"), src.schema)


@register("load_file_to_table", "SELECT * FROM customer")
def q_load_file_to_table(spark, sf_dir):
    """A landed CSV file loaded into a (path-based) table, which then replaces it."""
    from ..sinks.writers import load_file_to_table

    landed = _scratch(spark, "landed_csv")
    table(spark, sf_dir, "customer").write.option("sep", "|").option("header", "true").csv(landed)
    target = _scratch(spark, "loaded")
    load_file_to_table(spark, None, landed, "csv", table_path=target, delimiter="|", schema=_CUSTOMER_DDL)
    return spark.read.parquet(target)


@register("json_roundtrip", "SELECT * FROM customer")
def q_json_roundtrip(spark, sf_dir):
    from ..operators.merge import align_to_schema
    from ..sources.files import read_file

    src = table(spark, sf_dir, "customer")
    path = _scratch(spark, "json")
    src.write.json(path)
    return align_to_schema(read_file(spark, path, "json"), src.schema)


@register("append_table", "SELECT * FROM events UNION ALL SELECT * FROM events")
def q_append_table(spark, sf_dir):
    from ..sinks.writers import save_table

    path = _scratch(spark, "append")
    ev = table(spark, sf_dir, "events")
    save_table(ev, path=path, mode="append")
    save_table(ev, path=path, mode="append")
    return spark.read.parquet(path)


@register(
    "objects_roundtrip",
    """SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS file_name,
              CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes,
              text AS content
       FROM documents""",
)
def q_objects_roundtrip(spark, sf_dir):
    from ..sinks.writers import write_objects
    from ..sources.files import read_objects

    root = _scratch(spark, "objects")
    docs = table(spark, sf_dir, "documents")
    objects = docs.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file_name"),
        F.col("text").alias("file_content"),
    )
    write_objects(objects, root, file_extension="txt")
    back = read_objects(spark, root)
    return back.select(
        "file_name",
        F.length("file_content").cast("bigint").alias("n_bytes"),
        F.decode(F.col("file_content"), "UTF-8").alias("content"),
    )


@register(
    "objects_to_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
)
def q_objects_to_rows(spark, sf_dir):
    """Records carried inside objects (JSON arrays of 100 orders each) -> rows."""
    from ..sinks.writers import write_objects
    from ..sources.files import objects_to_rows, read_objects

    root = _scratch(spark, "records")
    o = table(spark, sf_dir, "orders")
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    objects = o.groupBy(F.floor(F.col("o_orderkey") / 100).alias("b")).agg(
        F.to_json(F.collect_list(F.struct(*cols))).alias("file_content")
    ).select(F.concat(F.lit("orders_"), F.col("b").cast("string")).alias("file_name"), "file_content")
    write_objects(objects, root, file_extension="json")
    return objects_to_rows(
        read_objects(spark, root),
        "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING",
    )


@register("ingest_stream", "SELECT * FROM events")
def q_ingest_stream(spark, sf_dir):
    """Two scheduled runs over landings that overlap by a day (the inclusive
    re-read): the target holds every event exactly once."""
    from pyspark.sql.types import StructType

    from ..streaming.ingest import ingest_stream, read_current

    base = _scratch(spark, "stream")
    landing = f"{base}/landing"
    item_schema = StructType.fromDDL(_EVENT_ITEM_DDL)
    run = dict(target=f"{base}/target", checkpoint=f"{base}/checkpoint", keys=["event_id"], event_time="ts")
    _land_event_pages(spark, sf_dir, f"{landing}/run1", F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    ingest_stream(spark, f"{landing}/*", item_schema, **run).awaitTermination()
    _land_event_pages(spark, sf_dir, f"{landing}/run2", F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    ingest_stream(spark, f"{landing}/*", item_schema, **run).awaitTermination()
    return read_current(spark, f"{base}/target")


# ---------------------------------------------------------------- text

_HTML_SQL = """trim(regexp_replace(
    replace(replace(replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(
      regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?s)<!--.*?-->', ' ', 'g'),
        '(?is)<script\\b[^>]*>.*?</script\\s*>', ' ', 'g'),
        '(?is)<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'),
        '(?is)<head\\b[^>]*>.*?</head\\s*>', ' ', 'g'),
      '<[^>]*>', ' ', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
    '&apos;', ''''), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'),
  '[ \\t\\r\\n\\f]+', ' ', 'g'))"""


@register("extract_text", f"SELECT page_id, url, {_HTML_SQL} AS text FROM pages")
def q_extract_text(spark, sf_dir):
    from ..operators.text import extract_text

    return extract_text(table(spark, sf_dir, "pages"), "html", "text").drop("html")


# ---------------------------------------------------------------- user code and chains

def _long_docs(pdf):
    """User transformation over a pandas batch: keep long documents, add a column."""
    out = pdf[pdf["n_chars"] > 1000][["doc_id", "lang", "n_chars"]].copy()
    out["lang_upper"] = out["lang"].str.upper()
    return out[["doc_id", "lang_upper", "n_chars"]]


@register(
    "apply_transformation",
    "SELECT doc_id, upper(lang) AS lang_upper, n_chars FROM documents WHERE n_chars > 1000",
)
def q_apply_transformation(spark, sf_dir):
    from .steps import apply_transformation

    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return apply_transformation(docs, _long_docs, "doc_id BIGINT, lang_upper STRING, n_chars BIGINT")


@register(
    "step_chain",
    """SELECT o_orderkey AS order_key, o_custkey AS customer, o_totalprice,
              lower(o_orderpriority) AS o_orderpriority
       FROM orders WHERE o_orderstatus = 'F'""",
)
def q_step_chain(spark, sf_dir):
    from .steps import run_steps

    steps = [
        {"step": "read_file", "params": {"path": f"{sf_dir.rstrip('/')}/orders.parquet", "fmt": "parquet"},
         "output": "orders"},
        {"step": "filter_by_params", "input": "orders",
         "params": {"params": [{"key": "o_orderstatus", "value": "F"}]}, "output": "finished"},
        {"step": "text_transform", "input": "finished",
         "params": {"transformations": [{"column_name": "o_orderpriority", "transformation_to_apply": "lower"}]},
         "output": "lowered"},
        {"step": "remove_columns", "input": "lowered",
         "params": {"columns": ["o_orderdate", "o_orderstatus"]}, "output": "slim"},
        {"step": "rename_columns", "input": "slim",
         "params": {"renames": [{"column_name": "o_orderkey", "new_column_name": "order_key"},
                                {"column_name": "o_custkey", "new_column_name": "customer"}]},
         "output": "result"},
    ]
    return run_steps(spark, steps)["result"]


@register(
    "rfm_step_chain",
    f"SELECT CUSTOMER_TYPE, COUNT(*) AS customers FROM ({_RFM_REFERENCE_SQL}) r GROUP BY CUSTOMER_TYPE",
)
def q_rfm_step_chain(spark, sf_dir):
    """The flagship as a declarative chain: read -> rfm_analysis -> segment sizes."""
    from .steps import run_steps

    steps = [
        {"step": "read_sql",
         "params": {"sql": "SELECT o_orderkey, o_custkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice "
                           "FROM {{orders}}",
                    "parameters": {"orders": f"parquet.`{sf_dir.rstrip('/')}/orders.parquet`"}},
         "output": "orders"},
        {"step": "rfm_analysis", "input": "orders",
         "params": {"customer": "o_custkey", "date": "o_orderdate", "amount": "o_totalprice",
                    "as_of": AS_OF, "tiebreak": "o_orderkey"},
         "output": "rfm"},
    ]
    rfm = run_steps(spark, steps)["rfm"]
    return rfm.groupBy("CUSTOMER_TYPE").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------- names, lookups, listings

@register(
    "sql_like_param",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE '%UIL%'",
)
def q_sql_like_param(spark, sf_dir):
    """A value inside a literal, and a table name."""
    from ..sources.tables import read_sql

    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return read_sql(
        spark, "SELECT c_custkey, c_mktsegment FROM {{t}} WHERE c_mktsegment LIKE '%{{part}}%'",
        parameters={"t": "customer", "part": "UIL"},
    )


@register(
    "sql_identifier_param",
    "SELECT c_custkey, c_nationkey AS picked FROM customer WHERE c_nationkey = 3",
)
def q_sql_identifier_param(spark, sf_dir):
    from ..sources.tables import read_sql

    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    return read_sql(
        spark, "SELECT c_custkey, `{{c}}` AS picked FROM customer WHERE {{c}} = {{v}}",
        parameters={"c": "c_nationkey", "v": 3}, identifiers=["c"],
    )


@register(
    "flatten_given_keys",
    """SELECT c_name AS GOOD__NAME, c_custkey,
              CASE WHEN c_custkey % 5 = 0 THEN 'not json' ELSE '{}' END AS mixed FROM customer""",
)
def q_flatten_given_keys(spark, sf_dir):
    """Given keys: a column that holds other values than objects stays as it is."""
    from ..operators.flatten import flatten_columns

    c = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.to_json(F.struct(F.col("c_name").alias("name"))).alias("good"),
        F.when(F.col("c_custkey") % 5 == 0, "not json").otherwise("{}").alias("mixed"),
    )
    return flatten_columns(c, ["good", "mixed"], keys={"good": ["name"], "mixed": ["a"]})


@register(
    "unpivot_other_case",
    """SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS amount FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem""",
)
def q_unpivot_other_case(spark, sf_dir):
    from ..operators.reshape import unpivot_columns

    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    out = unpivot_columns(li, ["L_QUANTITY", "L_TAX"], "measure", "amount")
    return out.withColumn("measure", F.lower("measure"))


@register("lookup_one", "SELECT n_nationkey, n_name, 'more than one row matches' AS of_region FROM nation WHERE n_nationkey = 7")
def q_lookup_one(spark, sf_dir):
    """One match is returned; several are told apart from it."""
    from ..operators.filters import lookup_one

    nation = table(spark, sf_dir, "nation")
    try:
        lookup_one(nation, {"n_regionkey": 1}, require=True)
        several = "one"
    except LookupError as e:
        several = str(e)
    return lookup_one(nation, {"n_nationkey": 7}, ["n_nationkey", "n_name"], require=True).withColumn("of_region", F.lit(several))


@register(
    "merge_from_file",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS c_mktsegment,
              c_acctbal FROM customer
       UNION ALL SELECT c_custkey + 10000000, upper(c_mktsegment) || '!', NULL FROM customer WHERE c_custkey % 10 = 5""",
)
def q_merge_from_file(spark, sf_dir):
    """The source is a landed JSON file whose keys are text; they take the target's type."""
    from ..operators.merge import merge_upsert

    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    path = _scratch(spark, "merge_source") + ".json"
    changed = F.concat(F.upper("c_mktsegment"), F.lit("!")).alias("c_mktsegment")
    customer.filter("c_custkey % 5 = 0").select(
        F.when(F.col("c_custkey") % 10 == 5, F.col("c_custkey") + 10000000).otherwise(F.col("c_custkey"))
        .cast("string").alias("c_custkey"), changed,
    ).write.json(path)
    return merge_upsert(customer, path, ["c_custkey"])


@register("read_folder", "SELECT 'part_' || p_partkey || '.v1.txt' AS file_name, p_name AS content FROM part")
def q_read_folder(spark, sf_dir):
    """Files of one folder, their names kept whole."""
    from ..sinks.writers import write_objects
    from ..sources.files import read_folder

    root = _scratch(spark, "folder")
    part = table(spark, sf_dir, "part")
    name = F.concat(F.lit("part_"), F.col("p_partkey").cast("string"), F.lit(".v1"))
    write_objects(part.select(name.alias("file_name"), F.col("p_name").alias("file_content")), root, "txt")
    return read_folder(spark, root).select("file_name", F.decode("file_content", "UTF-8").alias("content"))


@register("read_folder_limit", "SELECT CAST(10 AS BIGINT) AS files")
def q_read_folder_limit(spark, sf_dir):
    """A listing with a limit, for a folder with more files."""
    from ..sinks.writers import write_objects
    from ..sources.files import read_folder

    root = _scratch(spark, "folder")
    nation = table(spark, sf_dir, "nation")
    write_objects(nation.select(F.col("n_name").alias("file_name"), F.col("n_name").alias("file_content")), root)
    return read_folder(spark, root, limit=10).agg(F.count(F.lit(1)).alias("files"))


@register("nested_object_names", "SELECT 'region_' || n_regionkey || '/' || n_nationkey AS name, n_name AS content FROM nation")
def q_nested_object_names(spark, sf_dir):
    """Object names that hold a slash."""
    from ..sinks.writers import write_objects
    from ..sources.files import read_objects

    root = _scratch(spark, "nested")
    n = table(spark, sf_dir, "nation")
    name = F.concat(F.lit("region_"), F.col("n_regionkey").cast("string"), F.lit("/"), F.col("n_nationkey").cast("string"))
    write_objects(n.select(name.alias("file_name"), F.col("n_name").alias("file_content")), root)
    back = read_objects(spark, root)
    return back.select(
        F.regexp_extract("key", r"(region_[0-9]+/[0-9]+)$", 1).alias("name"), F.decode("file_content", "UTF-8").alias("content")
    )


@register("read_listing", "SELECT s_suppkey AS id, s_name AS name FROM supplier")
def q_read_listing(spark, sf_dir):
    from ..sources.pages import read_listing

    path = _scratch(spark, "listing")
    s = table(spark, sf_dir, "supplier")
    s.groupBy(F.floor(F.col("s_suppkey") / 50).alias("p")).agg(
        F.collect_list(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).alias("connections")
    ).select("connections").repartitionByRange("connections").write.option("maxRecordsPerFile", 1).json(path)
    return read_listing(spark, path)


def _land_numbered_pages(spark, ev, path):
    """Events as pages of 50 with ``currentPage``, ``totalPages`` and text timestamps."""
    pages = ev.withColumn("ts", F.date_format("ts", JSON_TS_FORMAT)).groupBy(F.floor(F.col("event_id") / 50).alias("currentPage")).agg(
        F.collect_list(F.struct(*[F.col(c) for c in ev.columns])).alias("items")
    )
    total = ev.select(F.floor(F.col("event_id") / 50)).distinct().count()
    pages.withColumn("totalPages", F.lit(total)).withColumn("tenant", F.lit("t1")).write.mode("overwrite").json(path)


@register("read_pages_numbered", "SELECT 't1' AS tenant, event_id, user_id, event_type FROM events")
def q_read_pages_numbered(spark, sf_dir):
    """Pages that carry a tenant and their number; every one is there."""
    from ..sources.pages import read_pages
    from .extraction import check_pages_complete

    path = _scratch(spark, "pages")
    _land_numbered_pages(spark, table(spark, sf_dir, "events"), path)
    check_pages_complete(spark, path, "tenant")
    return read_pages(spark, path, "items", "event_id BIGINT, user_id BIGINT, event_type STRING", keep=("tenant",))


@register("extract_increment_two_runs", "SELECT event_id, ts, user_id, value FROM events")
def q_extract_increment_two_runs(spark, sf_dir):
    """Two runs with the mark in the middle of a day, the second landing only what came
    after it: every event once."""
    from ..streaming.watermark import WatermarkStore
    from .extraction import extract_increment

    base = _scratch(spark, "increment")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    for run, part in enumerate([ev.filter(F.col("ts") < noon), ev.filter(F.col("ts") >= noon)]):
        _land_numbered_pages(spark, part, f"{base}/landing{run}")
        extract_increment(
            spark, f"{base}/landing{run}", "events",
            {"event_id": "int64", "ts": "timestamp[ns]", "user_id": "int64", "value": "float64"},
            f"{base}/target", WatermarkStore(spark, f"{base}/state"), "ts", floor_to_day=False,
        )
    return spark.read.parquet(f"{base}/target").select("event_id", "ts", "user_id", "value")


def _land_nested_pages(spark, ev, path):
    """Events as pages of 50 ``{data: [{id, attributes: {...}}], meta: {total}}``."""
    attributes = F.struct("user_id", "value", F.date_format("ts", JSON_TS_FORMAT).alias("updated_at"))
    record = F.struct(F.col("event_id").alias("id"), attributes.alias("attributes"))
    pages = ev.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(F.collect_list(record).alias("data"))
    pages.select("data", F.struct(F.lit(ev.count()).alias("total")).alias("meta")).write.mode("overwrite").json(path)


@register(
    "extract_increment_shape_a",
    "SELECT event_id AS id, ts AS attributes__updated_at, user_id AS attributes__user_id, value AS attributes__value FROM events",
)
def q_extract_increment_shape_a(spark, sf_dir):
    """Two runs over pages that only say how many records there are, with the time of a
    record inside an object; the second run lands what came at or after the first mark."""
    from ..streaming.watermark import WatermarkStore
    from .extraction import extract_increment

    base = _scratch(spark, "increment_a")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    noon = F.lit("2024-01-16 12:00:00").cast("timestamp_ntz")
    state = WatermarkStore(spark, f"{base}/state")
    for run in (0, 1):
        mark = F.lit(state.load("events")).cast("timestamp").cast("timestamp_ntz") if run else None
        _land_nested_pages(spark, ev.filter(F.col("ts") >= mark) if run else ev.filter(F.col("ts") < noon), f"{base}/landing{run}")
        extract_increment(
            spark, f"{base}/landing{run}", "events",
            {"id": "int64", "attributes.updated_at": "timestamp[ns]", "attributes.user_id": "int64", "attributes.value": "float64"},
            f"{base}/target", state, "attributes.updated_at", key=("id",), shape="a",
        )
    return spark.read.parquet(f"{base}/target").drop("extract_date")


@register(
    "extract_increment_moved_date",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2030-01-01' + to_seconds(event_id % 86400) ELSE ts END AS ts,
              user_id FROM events""",
)
def q_extract_increment_moved_date(spark, sf_dir):
    """A second run lands a fifth of the records again, in another date: each is there once."""
    from ..streaming.watermark import WatermarkStore
    from .extraction import extract_increment

    base = _scratch(spark, "increment_moved")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    late = F.timestamp_add("SECOND", F.col("event_id") % 86400, F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    for run, part in enumerate([ev, ev.filter("event_id % 5 = 0").withColumn("ts", late)]):
        _land_numbered_pages(spark, part, f"{base}/landing{run}")
        extract_increment(
            spark, f"{base}/landing{run}", "events", {"event_id": "int64", "ts": "timestamp[ns]", "user_id": "int64"},
            f"{base}/target", WatermarkStore(spark, f"{base}/state"), "ts", key=("event_id",),
        )
    return spark.read.parquet(f"{base}/target").drop("extract_date")


@register(
    "missing_page_ranges",
    """WITH p AS (SELECT DISTINCT event_type AS tenant, event_id // 50 + 1 AS page FROM events),
         t AS (SELECT max(page) AS n FROM p),
         landed AS (SELECT * FROM p WHERE page % 7 NOT IN (2, 3) AND page % 11 <> 0),
         wanted AS (SELECT tenant, unnest(generate_series(1, n)) AS page FROM (SELECT DISTINCT tenant FROM landed), t),
         missing AS (SELECT tenant, page FROM wanted EXCEPT SELECT tenant, page FROM landed),
         runs AS (SELECT *, page - row_number() OVER (PARTITION BY tenant ORDER BY page) AS run FROM missing)
       SELECT tenant, min(page) AS first_missing, max(page) AS last_missing, COUNT(*) AS pages FROM runs GROUP BY tenant, run""",
)
def q_missing_page_ranges(spark, sf_dir):
    """The ranges of page numbers that did not land, per tenant."""
    from ..sources.pages import missing_page_ranges

    ev = table(spark, sf_dir, "events").withColumn("page", F.floor(F.col("event_id") / 50) + 1)
    total = ev.agg(F.max("page")).first()[0]
    path = _scratch(spark, "pages")
    landed = ev.filter("page % 7 NOT IN (2, 3) AND page % 11 <> 0")
    landed.groupBy(F.col("event_type").alias("tenant"), F.col("page").alias("currentPage")).agg(
        F.collect_list(F.struct("event_id", "user_id")).alias("items")
    ).withColumn("totalPages", F.lit(total)).write.json(path)
    pages = spark.read.schema("tenant STRING, currentPage BIGINT, totalPages BIGINT").json(path)
    return missing_page_ranges(pages, tenant="tenant")


@register(
    "coerce_iso_variants",
    """SELECT event_id, CASE event_id % 4 WHEN 2 THEN date_trunc('millisecond', ts) WHEN 3 THEN date_trunc('minute', ts)
                        ELSE ts END AS ts FROM events""",
)
def q_coerce_iso_variants(spark, sf_dir):
    """ISO text with a Z, with an offset, with few fraction digits and without seconds."""
    from ..operators.coerce import coerce_schema

    kind, t = F.col("event_id") % 4, F.col("ts")
    text = (
        F.when(kind == 0, F.concat(F.date_format(t, JSON_TS_FORMAT), F.lit("Z")))
        .when(kind == 1, F.concat(F.date_format(t + F.expr("INTERVAL 2 HOURS"), JSON_TS_FORMAT), F.lit("+02:00")))
        .when(kind == 2, F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm"))
    )
    ev = table(spark, sf_dir, "events").select("event_id", text.alias("ts"))
    return coerce_schema(ev, {"event_id": "int64", "ts": "timestamp[ns]"})


@register(
    "next_watermark_nested",
    """SELECT strftime(date_trunc('second', MAX(ts)), '%Y-%m-%dT%H:%M:%SZ') AS last_update,
              COUNT(*) AS values_seen, CAST(0 AS BIGINT) AS values_unparsed FROM events""",
)
def q_next_watermark_nested(spark, sf_dir):
    """The mark from a field inside a record, in text with an offset."""
    from ..streaming.watermark import next_watermark

    local = F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    ev = table(spark, sf_dir, "events").select(
        F.struct(F.concat(local, F.lit("+03:00")).alias("updated_at")).alias("attributes")
    )
    return next_watermark(ev, "attributes.updated_at")


@register(
    "watermark_store",
    """SELECT event_type AS source, strftime(date_trunc('day', MAX(ts)), '%Y-%m-%dT%H:%M:%SZ') AS mark
       FROM events GROUP BY event_type""",
)
def q_watermark_store(spark, sf_dir):
    """One mark for each event type, saved and loaded again."""
    from ..streaming.watermark import WatermarkStore, next_watermark

    store = WatermarkStore(spark, _scratch(spark, "marks"))
    ev = table(spark, sf_dir, "events")
    kinds = [r[0] for r in ev.select("event_type").distinct().collect()]  # the few event types
    for kind in kinds:
        of_kind = next_watermark(ev.filter(F.col("event_type") == kind), "ts", floor="day")
        store.save(kind, of_kind.first()["last_update"])
    return spark.createDataFrame([(k, store.load(k)) for k in kinds], "source string, mark string")


@register(
    "write_by_date_one_timestamp",
    "SELECT '2024-03-01' AS extract_date, COUNT(*) AS events, CAST(SUM(event_id) AS BIGINT) AS ids FROM events",
)
def q_write_by_date_one_timestamp(spark, sf_dir):
    """Every row carries the time of the extraction."""
    from ..sinks.writers import write_by_date

    path = _scratch(spark, "bydate")
    ev = table(spark, sf_dir, "events").withColumn("extracted_at", F.lit("2024-03-01 08:00:00").cast("timestamp_ntz"))
    write_by_date(ev, path, "extracted_at")
    back = spark.read.parquet(path)
    return back.groupBy(F.date_format("extract_date", "yyyy-MM-dd").alias("extract_date")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("event_id").alias("ids")
    )


@register("ingest_stream_new_checkpoint", "SELECT * FROM events")
def q_ingest_stream_new_checkpoint(spark, sf_dir):
    """The checkpoint is lost between two runs: everything is read again, and later
    records are not hidden."""
    from pyspark.sql.types import StructType

    from ..streaming.ingest import ingest_stream, read_current

    base = _scratch(spark, "stream")
    item_schema = StructType.fromDDL(_EVENT_ITEM_DDL)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    for run, predicate in enumerate([F.col("ts") < cut, F.col("ts") >= cut]):
        _land_event_pages(spark, sf_dir, f"{base}/landing/run{run}", predicate)
        ingest_stream(
            spark, f"{base}/landing/*", item_schema, f"{base}/target", f"{base}/checkpoint{run}", ["event_id"], event_time="ts"
        ).awaitTermination()
    return read_current(spark, f"{base}/target")


@register(
    "ingest_stream_many_batches",
    """SELECT event_id, ts, user_id, event_type,
              CASE WHEN event_id % 50 BETWEEN 1 AND 4 THEN value + event_id % 50 ELSE value END AS value, props
       FROM events""",
)
def q_ingest_stream_many_batches(spark, sf_dir):
    """All events, then four batches of changed ones, each also landing again what the
    one before changed; the dates that gathered many files are compacted in between."""
    from pyspark.sql.types import StructType

    from ..streaming.ingest import compact, ingest_stream, read_current

    base = _scratch(spark, "stream")
    item_schema = StructType.fromDDL(_EVENT_ITEM_DDL)
    run = dict(target=f"{base}/target", checkpoint=f"{base}/checkpoint", keys=["event_id"], event_time="ts")
    for batch in range(5):
        part = F.col("event_id") % 50
        again = {"value": F.when(part.between(1, batch), F.col("value") + part).otherwise(F.col("value"))}
        wanted = part.between(batch - 1, batch) & (part > 0) if batch else None
        _land_event_pages(spark, sf_dir, f"{base}/landing/run{batch}", wanted, changed=again)
        ingest_stream(spark, f"{base}/landing/*", item_schema, **run).awaitTermination()
        if batch == 2:
            compact(spark, f"{base}/target", most_files=1)
    return read_current(spark, f"{base}/target")


@register("csv_quoted", "SELECT doc_id, text FROM documents")
def q_csv_quoted(spark, sf_dir):
    """Values with quotes (doubled), delimiters and line breaks."""
    from ..sources.files import read_file

    path = _scratch(spark, "csv")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    table(spark, sf_dir, "documents").select(
        F.concat(F.col("doc_id").cast("string"), F.lit(","), F.coalesce(quoted, F.lit(""))).alias("value")
    ).write.text(path)
    return read_file(spark, path, "csv", header=False, multiline=True, schema="doc_id BIGINT, text STRING")


@register("csv_quoted_skip_lines", "SELECT doc_id, text FROM documents")
def q_csv_quoted_skip_lines(spark, sf_dir):
    """Files with two lines before their header and line breaks inside quotes."""
    from ..sinks.writers import write_objects
    from ..sources.files import read_file

    root = _scratch(spark, "csv_quoted_skip")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted)
    files = table(spark, sf_dir, "documents").groupBy(F.floor(F.col("doc_id") / 500).alias("file")).agg(F.collect_list(line).alias("lines"))
    content = F.concat(F.lit("an export\nof documents\ndoc_id,text\n"), F.array_join("lines", "\n"), F.lit("\n"))
    write_objects(files.select(F.col("file").cast("string").alias("file_name"), content.alias("file_content")), root, "csv")
    return read_file(spark, root, "csv", multiline=True, skip_lines=2, schema="doc_id BIGINT, text STRING")


@register("csv_skip_lines", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_csv_skip_lines(spark, sf_dir):
    """Several files, two lines before the header of each, types inferred."""
    from ..operators.merge import align_to_schema
    from ..sinks.writers import write_objects
    from ..sources.files import read_file

    root = _scratch(spark, "csv_skip")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", F.col("c_acctbal").cast("string"))
    files = c.groupBy(F.floor(F.col("c_custkey") / 500).alias("b")).agg(F.array_join(F.collect_list(line), "\n").alias("body"))
    head = "made by hand\nsecond line\nc_custkey;c_name;c_acctbal\n"
    write_objects(
        files.select(F.concat(F.lit("customers_"), F.col("b").cast("string")).alias("file_name"),
                     F.concat(F.lit(head), "body", F.lit("\n")).alias("file_content")),
        root, "csv",
    )
    return align_to_schema(read_file(spark, root, "csv", delimiter=";", skip_lines=2), c.schema)


@register(
    "standardized_tables_view",
    """SELECT c_name AS name, c_nationkey AS nation, 'customer' AS kind, CAST(NULL AS VARCHAR) AS note FROM customer
       UNION ALL SELECT s_name, s_nationkey, 'supplier', NULL FROM supplier""",
)
def q_standardized_tables_view(spark, sf_dir):
    """Source tables to standard columns, listed by prefix, under one kept view."""
    import uuid

    from .standardization import standardize_tables, standardized_union_view

    db = f"cairn_{uuid.uuid4().hex[:12]}"
    where = _scratch(spark, "database")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{where}'")
    mapping = []
    for name, short in (("customer", "c"), ("supplier", "s")):
        table(spark, sf_dir, name).write.saveAsTable(f"{db}.{name}")
        mapping.append({"source": f"{db}.{name}", "map": {
            "name": {"value": f"{short}_name", "is_column": True},
            "nation": {"value": f"{short}_nationkey", "is_column": True},
            "kind": {"value": name, "is_column": False},
            "note": {"value": None},
        }})
    standardize_tables(spark, mapping)
    return standardized_union_view(spark, f"{db}.everyone", database=db, persistent=True)


@register("flow_extract_text", f"SELECT 'page_' || page_id AS file_name, {_HTML_SQL} AS content FROM pages")
def q_flow_extract_text(spark, sf_dir):
    """A chain of steps: objects in, their text, objects out."""
    from ..sinks.writers import write_objects
    from ..sources.files import read_objects
    from .steps import run_steps

    base = _scratch(spark, "flow")
    p = table(spark, sf_dir, "pages")
    name = F.concat(F.lit("page_"), F.col("page_id").cast("string"))
    write_objects(p.select(name.alias("file_name"), F.col("html").alias("file_content")), f"{base}/in", "html")
    run_steps(spark, [
        {"step": "read_objects", "params": {"root": f"{base}/in"}, "output": "objects"},
        {"step": "coerce_schema", "input": "objects",
         "params": {"schema": {"file_name": "string", "file_content": "string"}}, "output": "pages"},
        {"step": "extract_text", "input": "pages",
         "params": {"html_column": "file_content", "out_column": "file_content"}, "output": "texts"},
        {"step": "write_objects", "input": "texts", "params": {"root": f"{base}/out", "file_extension": "txt"}},
    ])
    return read_objects(spark, f"{base}/out").select("file_name", F.decode("file_content", "UTF-8").alias("content"))


@register(
    "merge_upsert_bucketed",
    """SELECT c.c_custkey, c.c_name,
              CASE WHEN c.c_nationkey = 3 THEN c.c_nationkey + 100 ELSE c.c_nationkey END AS c_nationkey,
              CASE WHEN c.c_nationkey = 3 THEN NULL ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment
       FROM customer c
       UNION ALL
       SELECT c_custkey + 1000000000, NULL, c_nationkey + 100, NULL, NULL FROM customer WHERE c_nationkey = 4""",
)
def q_merge_upsert_bucketed(spark, sf_dir):
    """In-place merge into a table bucketed by its key: changed customers, each landed
    twice, and new ones."""
    from ..operators.merge import merge_into, save_bucketed

    name = f"cairn_customer_{uuid.uuid4().hex[:8]}"
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    save_bucketed(customer, name, ["c_custkey"], 8, location=_scratch(spark, "bucketed"))
    gone = F.lit(None).cast(dict(customer.dtypes)["c_acctbal"]).alias("c_acctbal")
    changed = customer.filter("c_nationkey = 3").select("c_custkey", (F.col("c_nationkey") + 100).alias("c_nationkey"), gone)
    older = customer.filter("c_nationkey = 3").select("c_custkey", F.lit(-1).cast(dict(customer.dtypes)["c_nationkey"]).alias("c_nationkey"), "c_acctbal")
    added = customer.filter("c_nationkey = 4").select((F.col("c_custkey") + 1000000000).alias("c_custkey"), (F.col("c_nationkey") + 100).alias("c_nationkey"), gone)
    merge_into(spark, name, changed.unionByName(older).unionByName(added), ["c_custkey"], order_by=["c_nationkey"])
    return spark.table(name)


@register(
    "coerce_number_forms",
    """SELECT o_orderkey AS whole, o_orderkey AS exponent, CAST(NULL AS BIGINT) AS fraction, CAST(NULL AS TINYINT) AS small,
              CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 3 END AS refused
       FROM orders WHERE o_orderkey > 127 OR o_orderkey < 0""",
)
def q_coerce_number_forms(spark, sf_dir):
    """Whole numbers written with a point or an exponent are whole numbers; what is
    refused is kept and counted."""
    from ..operators.coerce import coerce_schema

    key = F.col("o_orderkey").cast("string")
    text = table(spark, sf_dir, "orders").filter("o_orderkey > 127 OR o_orderkey < 0").select(
        F.concat(key, F.lit(".0")).alias("whole"), F.concat(key, F.lit("00e-2")).alias("exponent"),
        F.concat(key, F.lit(".5")).alias("fraction"), key.alias("small"), F.lit("n/a").alias("odd"),
        F.when(F.col("o_orderkey") % 2 == 0, "x").alias("even"),
    )
    schema = {"whole": "int64", "exponent": "int64", "fraction": "int64", "small": "int8", "odd": "float64", "even": "timestamp[ns]"}
    out = coerce_schema(text, schema, rejects="refused")
    return out.select("whole", "exponent", "fraction", "small", F.size("refused").alias("refused"))


@register(
    "sql_double_quoted_param",
    "SELECT c_custkey, 'seg: ' || c_mktsegment AS label FROM customer WHERE c_mktsegment = 'BUILDING' OR c_name LIKE '%0007%'",
)
def q_sql_double_quoted_param(spark, sf_dir):
    from ..sources.tables import read_sql

    table(spark, sf_dir, "customer").createOrReplaceTempView("customer_named")
    return read_sql(
        spark,
        '''SELECT c_custkey, concat("{{ prefix }}: ", c_mktsegment) AS label FROM customer_named
           WHERE c_mktsegment = "{{segment}}" OR c_name LIKE "%{{part}}%"''',
        parameters=[{"key": "prefix", "value": "seg"}, {"key": "segment", "value": "BUILDING"}, {"key": "part", "value": "0007"}],
    )


@register(
    "sql_list_param",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey % 10 NOT IN (1, 2, 3)",
)
def q_sql_list_param(spark, sf_dir):
    from ..sources.tables import read_sql

    table(spark, sf_dir, "orders").createOrReplaceTempView("orders_listed")
    return read_sql(
        spark,
        "SELECT o_orderkey FROM orders_listed WHERE o_orderstatus IN ({{ states }}) AND o_custkey % 10 NOT IN ({{ends}})",
        parameters={"states": ["F", "P"], "ends": [1, 2, 3]},
    )


@register("overwrite_path_failed", "SELECT c_custkey FROM customer")
def q_overwrite_path_failed(spark, sf_dir):
    """An overwrite that fails in a task leaves the rows that were there."""
    from ..sinks.writers import save_table

    path = _scratch(spark, "overwritten")
    keys = table(spark, sf_dir, "customer").select("c_custkey")
    save_table(keys, path=path)
    try:
        save_table(keys.select(F.when(F.col("c_custkey") > 0, F.raise_error(F.lit("stop"))).otherwise(F.col("c_custkey")).alias("c_custkey")), path=path)
    except Exception as error:
        if "stop" not in str(error):
            raise
    return spark.read.parquet(path)
