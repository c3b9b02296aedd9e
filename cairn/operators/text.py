"""HTML -> plain text as a column job (D4), with native ``regexp_replace`` only.

Every pattern is valid both as a Java regex (Spark) and as RE2 (DuckDB oracle):
no back-references, no look-around.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import quote

# The clean-up rules, applied in this order.
HTML_DROP_PATTERNS = [
    r"(?s)<!--.*?-->",
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?is)<head\b[^>]*>.*?</head\s*>",
]
HTML_TAG_PATTERN = r"<[^>]*>"
# Entities decoded, "&amp;" last so "&amp;lt;" stays "&lt;".
HTML_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
WHITESPACE_PATTERN = r"[ \t\r\n\f]+"


def html_to_text(c: Column) -> Column:
    """Comments, script/style/head blocks removed; tags -> space; common entities
    decoded; runs of blanks collapsed; trimmed."""
    out = c
    for p in HTML_DROP_PATTERNS:
        out = F.regexp_replace(out, p, " ")
    out = F.regexp_replace(out, HTML_TAG_PATTERN, " ")
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    out = F.regexp_replace(out, WHITESPACE_PATTERN, " ")
    return F.trim(out)


def extract_text(df: DataFrame, html_column: str = "html", out_column: str = "text") -> DataFrame:
    """Add ``out_column`` with the visible text of ``html_column``."""
    return df.withColumn(out_column, html_to_text(F.col(quote(html_column))))
