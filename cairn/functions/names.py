"""Driver-side rules for column names (no data touched)."""

from __future__ import annotations

from collections.abc import Iterable

# The symbols replaced by "_" in generated column names, in order.
INVALID_NAME_SYMBOLS = [
    " ", "\t", "@", "#", "$", "%", "^", "&", "*", "(", ")", "-", "+", "=",
    "{", "}", "[", "]", ":", ";", "'", "\"", "|", "\\", "<", ">", ",", ".",
    "/", "?", "!", "~", "`",
]

_TRANSLATE = str.maketrans({s: "_" for s in INVALID_NAME_SYMBOLS})


def normalize_name(name: str) -> str:
    """Replace every listed symbol with ``_``."""
    return str(name).translate(_TRANSLATE)


def dedupe_names(names: Iterable[str], case_insensitive: bool = True) -> list[str]:
    """Give repeated names a ``_2``, ``_3`` ... suffix (first one kept as is)."""
    out: list[str] = []
    seen: set[str] = set()
    for n in names:
        cand, i = n, 1
        key = cand.lower() if case_insensitive else cand
        while key in seen:
            i += 1
            cand = f"{n}_{i}"
            key = cand.lower() if case_insensitive else cand
        seen.add(key)
        out.append(cand)
    return out


def quote(name: str) -> str:
    """Back-quote a column name for use inside a Spark SQL expression."""
    return "`" + name.replace("`", "``") + "`"
