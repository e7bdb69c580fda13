"""Word splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates words. Unicode white space plus the four
# information separators U+001C to U+001F.
WORD_GAP = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """The words of a text as an array of strings, none of them empty."""
    return F.array_remove(F.split(text, WORD_GAP), "")
