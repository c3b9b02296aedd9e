"""Entry D: standardise source tables from a mapping, then union them in a view.

Each mapped source becomes one ``select`` (no round trip through the driver) written
as ``SCHEMA.STANDARDIZED_NAME``; the union view lists the tables by prefix.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import quote
from ..operators.reshape import StandardMapping, standardize, standardized_table_name, union_all
from ..sinks.writers import create_view, save_table
from ..sources.tables import list_tables


def load_mapping(source: str | Sequence[Mapping]) -> list[StandardMapping]:
    """Mapping entries from a JSON file path or an in-memory list.

    An absent or malformed file is an error (never "nothing to do")."""
    if isinstance(source, str):
        with open(source, encoding="utf-8") as fh:
            entries = json.load(fh)
    else:
        entries = list(source)
    if not isinstance(entries, list):
        raise ValueError("mapping must be a JSON list")
    return [StandardMapping.from_dict(e) for e in entries]


def standardize_tables(
    spark: SparkSession, mapping: str | Sequence[Mapping], write: bool = True
) -> dict[str, DataFrame]:
    """Standardise every non-manual source; returns ``{target_name: DataFrame}``
    and, with ``write``, overwrites each target table."""
    out: dict[str, DataFrame] = {}
    for m in load_mapping(mapping):
        if m.its_manual_registry:
            continue
        df = standardize(spark.table(m.source), m.columns)
        name = standardized_table_name(m.source)
        if write:
            save_table(df, name=name, mode="overwrite")
        out[name] = df
    return out


def standardized_union_view(
    spark: SparkSession,
    view_name: str,
    prefix: str = "STANDARDIZED_",
    database: str | None = None,
    by_name: bool = False,
    persistent: bool = False,
) -> DataFrame:
    """UNION ALL of every table whose name starts with ``prefix``, as a view of this
    session or, with ``persistent``, as a view kept in the catalog."""
    names = list_tables(spark, prefix, database)
    if not names:
        raise ValueError(f"no table starts with {prefix!r}")
    if persistent:
        columns = ", ".join(quote(c) for c in spark.table(names[0]).columns) if by_name else "*"
        parts = " UNION ALL ".join(f"SELECT {columns} FROM {n}" for n in names)
        spark.sql(f"CREATE OR REPLACE VIEW {view_name} AS {parts}")
        return spark.table(view_name)
    return create_view(union_all([spark.table(n) for n in names], by_name=by_name), view_name)
