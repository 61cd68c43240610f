"""Word splitting and normalisation with Python ``str.split()`` / ``strip`` semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must match the word-count semantics being reproduced):
# - split on every character Python's str.split() treats as whitespace. Java's
#   \s alone is ASCII-only; \p{Z} adds the Unicode space separators and the
#   explicit range adds the file/group/record/unit separators and NEL.
WHITESPACE_PATTERN = r"[\p{Z}\s\x1c-\x1f\x85]+"
# - after lower-casing, strip these characters from both ends of a word only.
TRIM_CHARACTERS = ".,:;!?"


def split_words(text: Column, pattern: str = WHITESPACE_PATTERN) -> Column:
    """Array of raw tokens; leading/trailing whitespace yields empty tokens."""
    return F.split(text, pattern)
