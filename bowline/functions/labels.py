"""Class labels taken from directory names, and their numeric codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the parent directory of a labelled file is ``class`` followed by capital letters.
LABEL_DIRECTORY = r"/class([A-Z]+)[^/]*/[^/]*$"


def label_from_path(path: Column | str, strict: bool = False) -> Column:
    """Letters of the ``class<LETTERS>`` parent directory; null without one, or an error when ``strict``."""
    path = F.col(path) if isinstance(path, str) else path
    label = F.nullif(F.regexp_extract(path, LABEL_DIRECTORY, 1), F.lit(""))
    if not strict:
        return label
    return F.coalesce(label, F.raise_error(F.concat(F.lit("unlabelled file path: "), path)).cast("string"))


def base26_code(letters: Column | str) -> Column:
    """Sum of (letter - 'A') * 26^position, first letter least significant; null for null or empty text.

    Trailing ``A`` letters do not change the code, so it is not unique; an overflowing code is an error.
    """
    letters = F.col(letters) if isinstance(letters, str) else letters
    digits = F.transform(F.split(letters, ""), lambda c, i: (F.ascii(c) - F.lit(65)) * F.pow(F.lit(26), i))
    code = F.aggregate(digits, F.lit(0.0), lambda total, digit: total + digit)
    return F.when(F.length(letters) > 0, code.cast("int"))
