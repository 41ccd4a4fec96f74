"""Expressions and joins shared by the corpus operators. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The white space of every word rule here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"

# A key with at least 1/HOT_SHARE of all rows is hot, so there are never more than HOT_SHARE hot keys.
HOT_SHARE = 1000


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text; no word: an empty array."""
    return F.array_remove(F.split(text, SPACES), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often and in whatever lambda the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names like ``names`` that ``df`` does not have, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def join_split_hot(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], frequency: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``lookup``, which has one row per key and, in ``frequency``, its number of rows.

    Keys holding 1/HOT_SHARE of all ``total`` rows, at most HOT_SHARE of them, are sent to every task, so that their
    rows stay where they are; the rest meet in a shuffle in which no key is large. Null keys match null keys.
    """
    theirs = dict(zip(keys, unused(rows.join(lookup, list(keys)), *[f"key_{k}" for k in keys]), strict=True))
    lookup = lookup.withColumnsRenamed(theirs)
    same = F.lit(True)
    for mine, other in theirs.items():
        same = same & F.col(mine).eqNullSafe(F.col(other))
    is_hot = F.col(frequency) * HOT_SHARE >= total
    hot, cold = F.broadcast(lookup.filter(is_hot)), lookup.filter(~is_hot)
    near = rows.join(hot, same)
    far = rows.join(hot, same, "left_anti").join(cold, same)
    return near.unionByName(far).drop(*theirs.values())
