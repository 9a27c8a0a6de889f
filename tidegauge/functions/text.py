"""Name comparison that ignores case and trailing blanks.

Counter, object and instance names arrive from many servers in different spellings
(``'Page Lookups/sec'``, ``'Page lookups/sec '``).  Names are normalised once into a key and
keys are compared with plain equality, so joins stay hash joins.

Functions ending in ``_sql`` return expression text for use inside larger expressions; the others
return Columns.  Arguments are column names or expression text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def quoted(text: str) -> str:
    """String literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_key(text: str) -> str:
    """The key of a Python literal."""
    return text.rstrip(" ").lower()


def name_key_sql(c: str) -> str:
    return f"lower(rtrim({c}))"


def name_key(c: str) -> Column:
    """Comparison key of a name: lower case, trailing blanks removed."""
    return F.expr(name_key_sql(c))


def key_is_sql(key: str, name: str) -> str:
    return f"{key} = {quoted(literal_key(name))}"


def key_in_sql(key: str, names: Iterable[str]) -> str:
    return f"{key} in ({', '.join(quoted(literal_key(n)) for n in names)})"


def object_family_sql(object_key: str) -> str:
    """Part of an object name after the server prefix: ``sqlserver:locks`` -> ``locks``."""
    return f"substring_index({object_key}, ':', -1)"


def drive_letter(path: str) -> Column:
    return F.expr(f"upper(substring({path}, 1, 1))")


def drive_prefix(path: str) -> Column:
    """Drive with its separator, ``D:\\``."""
    return F.expr(f"upper(substring({path}, 1, 3))")
