"""Recency-frequency-monetary analysis: score and segment every customer.

Plan (all customers stay spread over the cluster):

* one ``groupBy(customer)`` computes the model columns and the last-transaction
  columns together (partial aggregation before the shuffle, so a customer holding a
  third of all rows is combined map-side); the latest amount is ``max_by`` on
  (date, tiebreak) instead of a window plus ``row_number = 1`` and a self join;
* the per-customer rows are stored once; the boundaries of the three NTILEs are found by
  sketch and exact counting rounds over the narrow key columns (``ntile_scores``), so
  the scores are comparisons with literals: no sort, no window, no join;
* the segment CASE and the final projection.

The reference's date filters (``d >= LAST_DAY(d) - 1 YEAR`` and ``- 40 DAY``) are
true for every non-null date, so ``window="reference"`` keeps rows with a date.
``window="as_of"`` anchors both windows on ``as_of`` instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import packed_order
from ..operators.boundaries import Order, ntile_scores

# Segment labels and the label for rows without a score.
SEGMENT_NEW = "New Customers"
SEGMENT_POTENTIAL = "Potential Loyalist"
SEGMENT_CHAMPIONS = "Champions"
SEGMENT_PROMISING = "Promising"
SEGMENT_LOYAL = "Loyal Customer"
SEGMENT_NEEDS_ATTENTION = "Needs Attention"
SEGMENT_ABOUT_TO_SLEEP = "About to Sleep"
SEGMENT_HIBERNATING = "Hibernating"
SEGMENT_AT_RISK = "At Risk"
SEGMENT_CANNOT_LOSE = "Cannot Lose Them"
SEGMENT_NOT_FOUND = "Categoria não encontrada"

OUTPUT_COLUMNS = [
    "CUSTOMER_ID", "LASTBUY", "RECENCY", "FREQUENCY", "MONETARY",
    "MONETARY_SCORE", "FREQUENCY_SCORE", "RECENCY_SCORE",
    "mean_monetary_frequency", "CUSTOMER_TYPE",
    "AMOUNT_LAST_40D", "TOTAL_MONETARY_40D", "MEAN_MONETARY_40D", "STD_MONETARY_40D",
]


# Recency scores, then labels by the upper end of the mean score (True: end included).
SEGMENT_RULES = (
    ((5,), ((2, False, SEGMENT_NEW), (3, False, SEGMENT_POTENTIAL), (5, True, SEGMENT_CHAMPIONS))),
    ((4,), ((1, True, SEGMENT_PROMISING), (3, False, SEGMENT_POTENTIAL), (5, True, SEGMENT_LOYAL))),
    ((3,), ((2, True, SEGMENT_NEEDS_ATTENTION), (3, False, SEGMENT_LOYAL), (3, True, SEGMENT_ABOUT_TO_SLEEP), (5, True, SEGMENT_LOYAL))),
    ((1, 2), ((2, True, SEGMENT_HIBERNATING), (4, True, SEGMENT_AT_RISK), (5, True, SEGMENT_CANNOT_LOSE))),
)


def rfm_segment(recency_score: Column, mean_mf: Column) -> Column:
    """Segment from the recency score and the mean of frequency and monetary score (1
    to 5 each); the label for no segment where the recency score is none of 1 to 5."""
    cases = [
        (recency_score.isin(*scores) & ((mean_mf <= end) if closed else (mean_mf < end)), label)
        for scores, bounds in SEGMENT_RULES
        for end, closed, label in bounds
    ]
    known = recency_score.isin(1, 2, 3, 4, 5)
    return F.coalesce(*[F.when(test, F.lit(label)) for test, label in cases], F.when(~F.coalesce(known, F.lit(False)), F.lit(SEGMENT_NOT_FOUND)))


def _as_of_col(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (dt.date, dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    return F.lit(str(as_of)).cast("date")


def rfm_base(
    df: DataFrame,
    customer: str,
    date: str,
    amount: str,
    as_of=None,
    tiebreak: str | None = None,
    window: str = "reference",
) -> DataFrame:
    """Per-customer model and last-transaction columns, before scoring.

    Amounts keep their own type and scale. Give DECIMAL amounts where sums must be exact:
    sums of DOUBLE depend on the order of addition in their last digits."""
    if window not in ("reference", "as_of"):
        raise ValueError("window must be 'reference' or 'as_of'")
    as_of_d = _as_of_col(as_of)
    types = dict(df.dtypes)
    tb = F.col(tiebreak) if tiebreak else F.col(amount)
    # latest row = greatest (date, tiebreak); packed into one decimal when possible
    # so the aggregate stays hash-based (see functions/ordering.py)
    packed = packed_order(
        F.col(date), types[date], F.col(tiebreak) if tiebreak else None,
        types[tiebreak] if tiebreak else None,
    )
    latest_key = packed if packed is not None else F.struct(F.col(date), tb)
    txn = df.select(
        F.col(customer).alias("CUSTOMER_ID"),
        F.col(date).alias("_d"),
        F.col(amount).alias("_amt"),
        F.when(F.col(date).isNotNull(), latest_key).alias("_ord"),
    ).filter(F.col("_d").isNotNull())
    if window == "reference":
        model_rows = F.lit(True)
        recent_rows = F.lit(True)
    else:
        model_rows = F.col("_d") >= F.add_months(as_of_d, -12)
        recent_rows = F.col("_d") >= F.date_sub(as_of_d, 40)
        txn = txn.filter(model_rows)

    def recent(c: Column) -> Column:
        return c if window == "reference" else F.when(recent_rows, c)

    amt_d = F.col("_amt").cast("double")
    agg = txn.groupBy("CUSTOMER_ID").agg(
        F.max("_d").alias("LASTBUY"),
        F.count("CUSTOMER_ID").alias("FREQUENCY"),
        F.sum("_amt").alias("MONETARY"),
        F.max_by(recent(F.col("_amt")), recent(F.col("_ord"))).alias("AMOUNT_LAST_40D"),
        F.sum(recent(F.col("_amt"))).alias("TOTAL_MONETARY_40D"),
        F.count(recent(F.col("_amt"))).alias("_n40"),
        F.stddev_pop(recent(amt_d)).alias("_std40"),
        F.count(recent(F.col("_d"))).alias("_rows40"),
    )
    has_recent = (F.col("CUSTOMER_ID").isNotNull()) & (F.col("_rows40") > 0)
    return agg.select(
        "CUSTOMER_ID",
        "LASTBUY",
        F.datediff(as_of_d, F.col("LASTBUY").cast("date")).cast("bigint").alias("RECENCY"),
        "FREQUENCY",
        "MONETARY",
        # a NULL customer never matches the reference's join: its four columns stay NULL
        F.when(has_recent, F.col("AMOUNT_LAST_40D")).alias("AMOUNT_LAST_40D"),
        F.when(has_recent, F.col("TOTAL_MONETARY_40D")).alias("TOTAL_MONETARY_40D"),
        F.when(
            has_recent & (F.col("_n40") > 0),
            F.col("TOTAL_MONETARY_40D").cast("double") / F.col("_n40"),
        ).alias("MEAN_MONETARY_40D"),
        F.when(has_recent, F.col("_std40")).alias("STD_MONETARY_40D"),
    )


def rfm_analysis(
    df: DataFrame,
    customer: str,
    date: str,
    amount: str,
    as_of=None,
    tiebreak: str | None = None,
    window: str = "reference",
    buckets: int = 5,
) -> DataFrame:
    """Score and segment every customer; columns in ``OUTPUT_COLUMNS`` order.

    Scores: NTILE over monetary ascending, frequency ascending and recency
    descending (whole days); NULLs last for ascending, first for descending; ties
    broken by customer id ascending (NULL last) so the result is deterministic.
    """
    base = rfm_base(df, customer, date, amount, as_of, tiebreak, window)
    customer_id = Order("CUSTOMER_ID")
    scored = ntile_scores(
        base,
        {
            "MONETARY_SCORE": [Order("MONETARY"), customer_id],
            "FREQUENCY_SCORE": [Order("FREQUENCY"), customer_id],
            "RECENCY_SCORE": [Order("RECENCY", descending=True), customer_id],
        },
        buckets,
    )
    mean_mf = (F.col("FREQUENCY_SCORE") + F.col("MONETARY_SCORE")) / 2
    return scored.select(
        "CUSTOMER_ID", "LASTBUY", "RECENCY", "FREQUENCY", "MONETARY",
        "MONETARY_SCORE", "FREQUENCY_SCORE", "RECENCY_SCORE",
        mean_mf.cast("double").alias("mean_monetary_frequency"),
        rfm_segment(F.col("RECENCY_SCORE"), mean_mf).alias("CUSTOMER_TYPE"),
        "AMOUNT_LAST_40D", "TOTAL_MONETARY_40D", "MEAN_MONETARY_40D", "STD_MONETARY_40D",
    )


def rfm_segment_counts(rfm: DataFrame) -> DataFrame:
    """Customers per segment and recency score."""
    return rfm.groupBy("CUSTOMER_TYPE", "RECENCY_SCORE").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("MONETARY").alias("monetary"),
    )
