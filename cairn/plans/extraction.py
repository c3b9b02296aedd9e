"""Entry C: landed API pages -> cleaned, typed rows -> parquet split by date.

Order of work: read pages, clean strings (timestamp fields excepted, so their
``:`` survive), coerce to the declared schema, write by extraction date, and only
then save the new mark, so a failed write never moves the mark past unwritten rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import quote
from ..operators.coerce import TYPE_MAP, coerce_schema
from ..operators.columns import clean_strings
from ..session import delete_folder, materialize, path_exists, release
from ..sinks.writers import write_by_date
from ..sources.pages import missing_page_ranges, page_completeness_a, page_completeness_b, read_pages
from ..streaming.watermark import WatermarkStore, incremental_filter, next_watermark


def check_pages_complete(
    spark: SparkSession,
    pages_path: str,
    tenant_field: str | None = None,
    shape: str = "b",
    items: str = "data",
    id_field: str | None = None,
) -> None:
    """Raise when landed pages, of all or of one tenant, are incomplete. Shape ``b``: a
    number up to ``totalPages`` is missing (the error names the ranges). Shape ``a``:
    fewer records than the largest ``meta.total``; with ``id_field`` only different
    ids count, so pages landed twice hide no gap."""
    tenant = f", {quote(tenant_field)} STRING" if tenant_field else ""
    if shape == "a":
        record = f"STRUCT<{quote(id_field)} STRING>" if id_field else "STRING"
        pages = spark.read.schema(f"{quote(items)} ARRAY<{record}>, meta STRUCT<total BIGINT>{tenant}").json(pages_path)
        if id_field:
            who = [F.col(quote(tenant_field))] if tenant_field else []
            pages = pages.withColumn("_id", F.explode_outer(F.col(quote(items))[id_field]))
            # summed before the shuffle to one row an id
            ids = pages.groupBy(*who, "_id").agg(F.max("meta.total").alias("total"))
            found = ids.groupBy(*who).agg(F.count("_id").alias("records"), F.max("total").alias("expected"))
            found = found.withColumn("complete", F.col("records") >= F.col("expected"))
        else:
            found = page_completeness_a(pages, items, tenant_field)
        unit = "records"
    else:
        pages = spark.read.schema(f"currentPage BIGINT, totalPages BIGINT{tenant}").json(pages_path)
        found = page_completeness_b(pages if tenant_field else pages.withColumn("tenant", F.lit("all")), tenant_field or "tenant")
        unit = "pages"
    gaps = found.filter(~F.coalesce(F.col("complete"), F.lit(False))).limit(20).collect()
    if gaps:
        detail = ", ".join(f"{r[tenant_field] if tenant_field else 'all'}: {r[unit]}/{r['expected']} {unit}" for r in gaps)
        if shape != "a":
            missing = missing_page_ranges(pages, tenant=tenant_field).orderBy("first_missing").limit(20).collect()
            detail += "; missing " + ", ".join(f"{r[0]}: {r['first_missing']}-{r['last_missing']}" for r in missing)
        raise RuntimeError(f"landed pages incomplete ({detail}); nothing written, mark unchanged")


def split_tenants(text: str) -> list[str]:
    """Comma-separated tenant codes, trimmed, empties dropped."""
    return [t.strip() for t in text.split(",") if t.strip()]


def _record_ddl(names: Sequence[str]) -> str:
    """The fields of a record, every leaf a string; ``a.b`` is the field b inside a."""
    tree: dict[str, list[str]] = {}
    for name in names:
        head, _, rest = name.partition(".")
        tree.setdefault(head, []).append(rest)
    for head, rests in tree.items():
        if "" in rests and len(rests) > 1:
            raise ValueError(f"field {head!r} is declared as a value and as an object")
    return ", ".join(
        f"{quote(head)} " + (f"STRUCT<{_record_ddl(rests)}>" if rests != [""] else "STRING")
        for head, rests in tree.items()
    )


def flat_name(field: str) -> str:
    """The column of a declared field: ``attributes.updated_at`` is ``attributes__updated_at``."""
    return field.replace(".", "__")


def _dates(df: DataFrame, date: Column) -> set:
    """The calendar dates of ``df``: as many values as a table has days."""
    return {r[0] for r in df.select(date.alias("d")).distinct().collect() if r[0] is not None}


def _merge_dates(
    spark: SparkSession, landed: DataFrame, target: str, ts_column: str, key: Sequence[str]
) -> tuple[DataFrame, set]:
    """``landed`` and the rows already at ``target`` in the dates concerned that it does
    not bring again: neither the whole row nor, where no part of it is NULL, the ``key``.
    Also the dates concerned: those of the landed rows and, with a ``key``, those where a
    landed key is now (a narrow scan of the keys), because a record may have moved."""
    stored = spark.read.parquet(target)
    dates = _dates(landed, F.to_date(F.col(quote(ts_column))))
    if key:
        keys = landed.select(*[F.col(quote(c)).alias(f"_again{i}") for i, c in enumerate(key)])
        dates |= _dates(stored.join(keys, [F.col(quote(c)) == F.col(f"_again{i}") for i, c in enumerate(key)], "left_semi"), F.col("extract_date"))
    old = stored.filter(F.col("extract_date").isin(sorted(dates))).drop("extract_date")
    for columns, same in ((list(key), lambda a, b: a == b), ([c for c in landed.columns if c in old.columns], lambda a, b: a.eqNullSafe(b))):
        if columns:
            again = landed.select(*[F.col(quote(c)).alias(f"_again{i}") for i, c in enumerate(columns)])
            on = [same(F.col(quote(c)), F.col(f"_again{i}")) for i, c in enumerate(columns)]
            old = old.join(again, on, "left_anti")
    return landed.unionByName(old, allowMissingColumns=True), dates


def extract_increment(
    spark: SparkSession,
    pages_path: str,
    entity: str,
    schema: Mapping[str, str],
    target: str,
    state: WatermarkStore,
    ts_column: str,
    items: str | None = None,
    is_historical: bool = False,
    floor_to_day: bool | None = None,
    tenant_field: str | None = None,
    require_complete: bool = True,
    key: Sequence[str] = (),
    shape: str = "b",
    replace_dates: bool = False,
) -> DataFrame:
    """Land one entity's increment; returns the one-row watermark frame written.

    ``shape`` ``b``: pages ``{items, currentPage, totalPages}``, the mark at midnight;
    ``a``: pages ``{data, meta: {total}}``, the mark at the second of the latest row.
    ``items`` and ``floor_to_day`` override these. A declared field ``a.b`` lies inside
    the object a; its column is ``a__b``.

    Records are read as text (every declared field a string) and typed by
    ``coerce_schema``; rows before the saved mark's day are skipped unless historical.
    With ``require_complete`` the landed pages are checked first (see
    ``check_pages_complete``; per ``tenant_field`` if given, shape ``a`` by different
    values of a ``key`` of one field): a gap raises before anything is written or the
    mark moves. The typed rows are stored once; values of ``ts_column`` that are no
    timestamps are counted while they are, and raise.

    What the dates concerned already have stays, except the rows landed again: the same
    ``key`` (in whatever date it was; a date left empty is removed), or the same whole
    row. ``replace_dates`` replaces the landed dates whole instead, for a source that
    always lands whole days, and so does ``is_historical``. Several landed rows of one
    key all stay."""
    if shape not in ("a", "b"):
        raise ValueError("shape must be 'a' or 'b'")
    items = items or ("data" if shape == "a" else "items")
    floor_to_day = shape == "b" if floor_to_day is None else floor_to_day
    if require_complete:
        one_key = key[0] if shape == "a" and len(key) == 1 and "." not in key[0] else None
        check_pages_complete(spark, pages_path, tenant_field, shape, items, one_key)
    raw = read_pages(spark, pages_path, items=items, item_schema=_record_ddl(list(schema)))
    raw = raw.select(*[F.col(".".join(quote(p) for p in c.split("."))).alias(flat_name(c)) for c in schema])
    schema = {flat_name(c): t for c, t in schema.items()}
    ts_column, key = flat_name(ts_column), [flat_name(c) for c in key]
    ts_fields = [c for c, t in schema.items() if TYPE_MAP.get(t) == "timestamp_ntz"]
    cleaned = clean_strings(raw, exclude=ts_fields)
    typed = coerce_schema(cleaned, schema, rejects="__refused")
    # A timestamp that is no timestamp must not vanish while the mark moves on.
    seen = Observation()
    typed = typed.observe(seen, F.count_if(F.map_contains_key("__refused", F.lit(ts_column))).alias("refused"))
    version, mark = state.version(entity), state.load(entity)
    landed = materialize(incremental_filter(typed.drop("__refused"), ts_column, mark, is_historical, True), "landed")
    if seen.get["refused"]:
        release(landed)
        raise ValueError(f"{seen.get['refused']} values of {ts_column} are not timestamps; nothing was written")
    rows, dates, merged = landed.filter(F.col(quote(ts_column)).isNotNull()), set(), None
    if not replace_dates and not is_historical and path_exists(spark, target):
        rows, dates = _merge_dates(spark, rows, target, ts_column, key)
        # stored, because it reads the folders that are replaced
        rows = merged = materialize(rows, "increment")
    write_by_date(rows, target, ts_column)
    if key and merged is not None:
        for date in dates - _dates(merged, F.to_date(F.col(quote(ts_column)))):
            delete_folder(spark, f"{target}/extract_date={date}")
    for stored in (landed, merged):
        if stored is not None:
            release(stored)
    # the mark moves only after the data is written
    written = spark.read.parquet(target)
    if mark is not None and not is_historical:
        # only the date folders this run could have touched (partition pruning)
        written = written.filter(F.col("extract_date") >= F.to_date(F.lit(mark[:10])))
    wm = next_watermark(written, ts_column, floor="day" if floor_to_day else None)
    row = wm.collect()[0]
    if row["last_update"]:
        state.save(entity, row["last_update"], version)
    return wm.select("last_update", "values_seen", F.col("values_unparsed"))
