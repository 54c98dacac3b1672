"""Words in texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorfold.functions.text import letter_tokens


def tokenize_letters(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per letter run, with the other columns of the input."""
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.explode(letter_tokens(F.col(text))).alias("token"))


def token_counts(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Tokens and distinct tokens per group, counted per (group, token) first.

    The first shuffle is on the pair, so a group that holds most of the text is spread
    over as many tasks as it has words.
    """
    words = (
        tokenize_letters(df.select(by, text), text)
        .groupBy(by, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return words.groupBy(by).agg(
        F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct")
    )
