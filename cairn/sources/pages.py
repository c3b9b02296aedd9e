"""Landed API pages -> rows.

Extraction itself (HTTP, paging, rate limits) is not rebuilt: pages are landed as
JSON files by whatever fetches them, and Spark reads every page of every tenant in
one multi-file scan, one row per page, exploded into records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import quote


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    items: str = "data",
    item_schema: StructType | str | None = None,
    page_schema: StructType | str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per record in the ``items`` array of every page.

    ``item_schema`` fixes the record type (recommended: no inference pass);
    ``keep`` carries page-level fields (e.g. a tenant code) onto each record."""
    reader = spark.read
    if page_schema is not None:
        reader = reader.schema(page_schema)
    elif item_schema is not None:
        ddl = item_schema if isinstance(item_schema, str) else item_schema.simpleString()
        if ddl.startswith("struct<"):
            ddl = ddl[len("struct<"):-1]
        extra = ", ".join(f"`{k}` STRING" for k in keep)
        reader = reader.schema(f"`{items}` ARRAY<STRUCT<{ddl}>>" + (f", {extra}" if extra else ""))
    pages = reader.json(path)
    return pages.select(*keep, F.explode(F.col(items)).alias("__item")).select(*keep, "__item.*")


def page_completeness_a(pages: DataFrame, items: str = "data", tenant: str | None = None) -> DataFrame:
    """Shape A check, of all pages or per ``tenant``: records landed vs the largest
    ``meta.total`` any page reports."""
    return pages.groupBy(*([tenant] if tenant else [])).agg(
        F.sum(F.size(items)).alias("records"),
        F.max("meta.total").alias("expected"),
    ).withColumn("complete", F.col("records") == F.col("expected"))


def page_completeness_b(pages: DataFrame, tenant: str = "tenant") -> DataFrame:
    """Shape B check per tenant: distinct ``currentPage`` equals ``totalPages``."""
    return pages.groupBy(tenant).agg(
        F.count_distinct("currentPage").alias("pages"),
        F.max("totalPages").alias("expected"),
    ).withColumn("complete", F.col("pages") == F.col("expected"))


def missing_page_ranges(
    pages: DataFrame,
    page: str = "currentPage",
    expected: Column | str = "totalPages",
    tenant: str | None = None,
    first_page: int = 1,
    block: int = 65_536,
) -> DataFrame:
    """The pages to fetch again: one row (tenant, first_missing, last_missing, pages) for
    each run of page numbers that did not land.

    Pages are numbered from ``first_page``; ``expected`` is the number of pages (the
    largest value any page of the tenant reports counts; for shape A for instance
    ``F.ceil(F.col("meta.total") / 50)``). Pages landed twice, without a number or outside
    the range change nothing. A tenant without any landed page is unknown here.

    Gaps are looked for within blocks of ``block`` page numbers, then between the blocks'
    ends, so no task sorts more than one block, however many pages a tenant has."""
    who = F.col(quote(tenant)) if tenant else F.lit("all")
    of = F.expr(expected) if isinstance(expected, str) else expected
    seen = pages.select(who.alias("_who"), F.col(quote(page)).cast("bigint").alias("_p"), of.cast("bigint").alias("_of"))
    until = seen.groupBy("_who").agg((F.max("_of") + first_page - 1).alias("_last"))
    inside = (
        seen.select("_who", "_p").where(F.col("_p") >= first_page).distinct()
        .withColumn("_block", F.floor(F.col("_p") / block))
    )
    following = F.lead("_p").over(Window.partitionBy("_who", "_block").orderBy("_p"))
    within = inside.select("_who", (F.col("_p") + 1).alias("_a"), (following - 1).alias("_b"))
    # one row a block: what lies between its end and the next block's begin, or the last page
    ends = inside.groupBy("_who", "_block").agg(F.min("_p").alias("_min"), F.max("_p").alias("_max"))
    w = Window.partitionBy("_who").orderBy("_block")
    ends = ends.withColumns({"_next": F.lead("_min").over(w), "_before": F.lag("_max").over(w)})
    ends = until.join(ends.withColumnRenamed("_who", "_w"), F.col("_who").eqNullSafe(F.col("_w")), "left").select(
        "_who",
        "_last",
        F.filter(
            F.array(
                F.struct((F.coalesce("_max", F.lit(first_page - 1)) + 1).alias("_a"), (F.coalesce("_next", F.col("_last") + 1) - 1).alias("_b")),
                # before the first block; with no page in range the entry above covers all
                F.struct(F.lit(first_page).cast("bigint").alias("_a"), F.when(F.col("_before").isNull(), F.col("_min") - 1).alias("_b")),
            ),
            lambda r: r["_b"].isNotNull(),
        ).alias("_r"),
    )
    between = ends.select("_who", F.explode("_r").alias("_r")).select("_who", "_r._a", "_r._b")
    gaps = within.where("_b >= _a").union(between)
    gaps = gaps.join(until.withColumnRenamed("_who", "_w"), F.col("_who").eqNullSafe(F.col("_w")))
    gaps = gaps.withColumn("_b", F.least("_b", "_last")).where("_b >= _a")
    return gaps.select(
        F.col("_who").alias(tenant or "tenant"),
        F.col("_a").alias("first_missing"),
        F.col("_b").alias("last_missing"),
        (F.col("_b") - F.col("_a") + 1).alias("pages"),
    )


def read_listing(spark: SparkSession, path: str, items: str = "connections") -> DataFrame:
    """Landed metadata listing (``{connections: [...]}``) -> one row per item."""
    return spark.read.option("multiLine", "true").json(path).select(
        F.explode(items).alias("__i")
    ).select("__i.*")
