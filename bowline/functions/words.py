"""Word normalization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a text is cut at these characters.
SEPARATORS = " \n\t\r"


def normalize_word(word: Column | str) -> Column:
    """Lower-case, strip spaces; a word with nothing left is null."""
    return F.nullif(F.trim(F.lower(word)), F.lit(""))


def split_words(text: Column | str, lower: bool = True) -> Column:
    """The words of the text, lower-cased unless told otherwise, and no empty strings.

    A cut at one plain character takes no regular expression.
    """
    text = F.lower(text) if lower else F.col(text) if isinstance(text, str) else text
    for other in SEPARATORS[1:]:
        text = F.replace(text, F.lit(other), F.lit(SEPARATORS[0]))
    return F.array_remove(F.split(text, SEPARATORS[0]), "")
