"""Column expressions for word-level tokenisation (JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokenizer rule and the special tokens with their ids.
# A token is a maximal run of Unicode letters or digits, after lower-casing.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
PAD, UNK, CLS, SEP = 0, 1, 2, 3
SPECIALS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column) -> Column:
    """Array of lower-cased word tokens of the whole text, empty strings
    removed (``array_remove`` keeps the expression in generated code, unlike
    a lambda ``filter``)."""
    return F.array_remove(F.split(F.lower(_c(text)), TOKEN_SPLIT), "")
