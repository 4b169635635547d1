"""String column functions with Java ``String`` semantics."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions._util import as_col


def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def _java_regex_literal(sep: str) -> str:
    if re.fullmatch(r"[A-Za-z0-9 ,;:_\-]+", sep):
        return sep
    return "\\Q" + sep + "\\E"


def java_split(col: Column | str, sep: str = " ") -> Column:
    """``String.split(sep)`` for a literal separator.

    Java drops trailing empty tokens and keeps leading and inner ones, so
    ``"a  b"`` gives ``[a, "", b]``, ``" a"`` gives ``["", a]``, ``"a  "``
    gives ``[a]``.  A string made only of separators gives ``[]`` and the
    empty string gives ``[""]``.  Spark's ``split`` keeps trailing empty
    tokens, so the trailing separators are removed first.
    """
    if not sep:
        raise ValueError("separator must be non-empty")
    c = as_col(col)
    if len(sep) == 1:
        stripped = F.rtrim(c, F.lit(sep))
    else:
        stripped = F.regexp_replace(c, "(?:" + _java_regex_literal(sep) + ")+\\z", "")
    return F.when((F.length(c) > 0) & (stripped == ""), _empty_strings()).otherwise(
        F.split(stripped, _java_regex_literal(sep))
    )


def text_to_lines(col: Column | str) -> Column:
    """Split a text into lines the way a text-file reader does.

    Lines end at LF, CR or CRLF; one final terminator does not start a new
    line; an empty text has no lines; an empty line between two
    terminators is kept.
    """
    c = as_col(col)
    n = F.length(c)
    stripped = (
        F.when(c.endswith("\r\n"), c.substr(F.lit(1), n - 2))
        .when(c.endswith("\n") | c.endswith("\r"), c.substr(F.lit(1), n - 1))
        .otherwise(c)
    )
    return F.when(c == "", _empty_strings()).otherwise(F.split(stripped, "\\r\\n|\\r|\\n"))


def utf16_length(col: Column | str) -> Column:
    """``String.length()``: the number of UTF-16 code units (as int).

    Spark's ``length`` counts code points; the two differ only for
    characters outside the Basic Multilingual Plane, which count twice.
    """
    c = as_col(col)
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")
