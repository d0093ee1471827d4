"""Text analysis as Column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of letters and digits, with inner apostrophes kept ("don't" is one token).
UNICODE_WORD = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"


def strip(col: Column) -> Column:
    """Remove all leading and trailing whitespace, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


@dataclass(frozen=True)
class Analyzer:
    """Lower-case word tokens, optionally bounded in length and without stop words."""

    pattern: str = UNICODE_WORD
    min_len: int = 1
    max_len: int | None = None
    stop_words: tuple[str, ...] = ()

    def tokens(self, col: Column) -> Column:
        out = F.regexp_extract_all(F.lower(col), F.lit(self.pattern), F.lit(0))
        if self.min_len > 1 or self.max_len is not None:
            upper = self.max_len if self.max_len is not None else 2**31 - 1
            out = F.filter(out, lambda t: F.length(t).between(self.min_len, upper))
        if self.stop_words:
            stop = F.array(*[F.lit(w) for w in self.stop_words])
            out = F.filter(out, lambda t: ~F.array_contains(stop, t))
        return out


STANDARD = Analyzer()
# The word index keeps tokens of 3 to 15 characters.
BOUNDED_WORDS = Analyzer(min_len=3, max_len=15)


def join_tokens(tokens: Column) -> Column:
    """Tokens as one string padded with blanks, so whole tokens can be searched in it."""
    return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))


def compose(*parts: Column) -> Column:
    """Join the non-empty parts with blanks and trim the ends."""
    kept = F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != F.lit("")))
    return strip(F.array_join(kept, " "))
