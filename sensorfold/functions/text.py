"""Tokenising."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a run of anything that is not a Unicode letter separates tokens.
TOKENIZER_PATTERN = r"[^\p{L}]+"


def letter_tokens(text: Column) -> Column:
    """Array of the maximal letter runs in the text; no empty strings."""
    return F.array_remove(F.split(text, TOKENIZER_PATTERN), "")
