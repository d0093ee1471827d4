"""Relevance arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Usual BM25 constants.
K1 = 1.2
B = 0.75
# Scores are rounded to so many digits before they are ranked.
DIGITS = 6


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(F.lit(1.0) + (n_docs - df + F.lit(0.5)) / (df + F.lit(0.5)))


def bm25(tf: Column, length: Column, mean_length: Column, weight: Column) -> Column:
    """Saturated term frequency, corrected for field length, times the term's weight."""
    penalty = F.lit(K1) * (F.lit(1.0 - B) + F.lit(B) * length / mean_length)
    return weight * tf / (tf + penalty)


def share_of(tf, length, mean_length):
    """``bm25`` of numpy arrays, before the term's weight."""
    return tf / (tf + K1 * (1.0 - B + B * length / mean_length))


def rrf(rank: Column, offset: int = 60) -> Column:
    """A list entry's share in reciprocal rank fusion."""
    return F.lit(1.0) / (F.lit(float(offset)) + rank)
