"""Table and SQL sources."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

_PLACEHOLDER = re.compile(
    r"""--[^\n]*|/\*.*?\*/
    |'(?P<literal>(?:[^'\\]|\\.|'')*)'
    |"(?P<double>(?:[^"\\]|\\.|"")*)"
    |\bIN\s*\(\s*\{\{\s*(?P<listed>\w+)\s*\}\}\s*\)
    |`\{\{\s*(?P<quoted>\w+)\s*\}\}`
    |(?P<keyword>\b(?:FROM|JOIN|INTO|TABLE))(?P<gap>\s+)\{\{\s*(?P<named>\w+)\s*\}\}
    |\{\{\s*(?P<plain>\w+)\s*\}\}""",
    re.VERBOSE | re.IGNORECASE | re.DOTALL,
)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Lazy scan of a catalog table, or of a parquet folder given as a path."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def _params(parameters) -> dict[str, object]:
    if parameters is None:
        return {}
    if isinstance(parameters, Mapping):
        return dict(parameters)
    return {p["key"]: p["value"] for p in parameters}


def to_named_markers(sql: str, identifiers: Collection[str] = (), lists: Mapping[str, int] | None = None) -> str:
    """Rewrite ``{{name}}`` into the named marker ``:name``; values are then bound by
    Spark as literals, never spliced into the text.

    A placeholder that is a whole literal (``'{{x}}'`` or ``"{{x}}"``) becomes the marker
    alone; one inside a literal (``'%{{x}}%'``) becomes part of a concatenation. ``IN ({{x}})``
    with a list (``lists``: its length by name) gets a marker for each element; no
    element matches none. One in back quotes,
    after FROM, JOIN, INTO or TABLE, or named in ``identifiers`` is a name: it becomes
    ``IDENTIFIER(:name)``."""

    lists = lists or {}

    def literal(text: str, mark: str) -> str:
        pieces = re.split(r"\{\{\s*(\w+)\s*\}\}", text)
        if len(pieces) == 1:
            return f"{mark}{text}{mark}"
        parts = [f":{x}" if i % 2 else f"{mark}{x}{mark}" for i, x in enumerate(pieces) if x]
        return parts[0] if len(parts) == 1 else f"concat({', '.join(parts)})"

    def rewrite(m: re.Match) -> str:
        if m["literal"] is not None:
            return literal(m["literal"], "'")
        if m["double"] is not None:
            return literal(m["double"], '"')
        if m["listed"] is not None:
            name = m["listed"]
            if name not in lists:
                return re.sub(r"\{\{.*\}\}", f":{name}", m[0], flags=re.DOTALL)
            return f"IN ({', '.join(f':{name}__{i}' for i in range(lists[name])) or 'NULL'})"
        name = m["quoted"] or m["named"] or m["plain"]
        if name is None:  # a comment
            return m[0]
        if m["plain"] and name not in identifiers:
            return f":{name}"
        return f"{m['keyword'] or ''}{m['gap'] or ''}IDENTIFIER(:{name})"

    return _PLACEHOLDER.sub(rewrite, sql)


def read_sql(
    spark: SparkSession,
    sql: str | None = None,
    sql_file: str | None = None,
    parameters=None,
    identifiers: Collection[str] = (),
) -> DataFrame:
    """Run a SQL text or file with ``{{param}}`` parameters.

    ``parameters``: ``[{key, value}]`` or a dict. Table names are bound after FROM and
    JOIN; ``identifiers`` names the parameters that are column names. Inside a literal a
    value is bound as text. A placeholder without a parameter is an error."""
    if sql is None and sql_file is None:
        raise ValueError("give a SQL text or a SQL file")
    if sql is None:
        with open(sql_file, encoding="utf-8") as fh:
            sql = fh.read()
    args = _params(parameters)
    lists = {m["listed"] for m in _PLACEHOLDER.finditer(sql) if m["listed"] and isinstance(args.get(m["listed"]), (list, tuple, set))}
    text = to_named_markers(sql, identifiers, {name: len(args[name]) for name in lists})
    unknown = {x for m in _PLACEHOLDER.finditer(sql) for x in re.findall(r"\{\{\s*(\w+)\s*\}\}", m[0])
               if not m[0].startswith(("--", "/*"))} - set(args)
    if unknown:
        raise KeyError(f"no value for {sorted(unknown)}")
    args |= {f"{name}__{i}": x for name in lists for i, x in enumerate(args[name])}
    args = {name: x for name, x in args.items() if name not in lists or re.search(rf":{name}\b", text)}
    return spark.sql(text, args=args) if args else spark.sql(text)


def list_tables(spark: SparkSession, prefix: str, database: str | None = None) -> list[str]:
    """Qualified names of the tables whose name starts with ``prefix`` (literal
    match, case-insensitive), sorted (S12)."""
    db = database or spark.catalog.currentDatabase()
    names = [
        t.name for t in spark.catalog.listTables(db)
        if t.name.lower().startswith(prefix.lower()) and not t.isTemporary
    ]
    return [f"{db}.{n}" for n in sorted(names)]
