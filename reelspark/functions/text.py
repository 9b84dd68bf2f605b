"""String functions whose warehouse semantics differ from Spark's namesakes.

All are Column -> Column expressions built from ``pyspark.sql.functions``; they
stay inside whole-stage codegen (no Python UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Word delimiters of the warehouse INITCAP (its public documentation): white
# space and  ! ? @ " ^ # $ & ~ _ , . : ; + - * % / | \ [ ] ( ) { } < >
# The apostrophe is not a delimiter. Written as the body of a regex class.
INITCAP_DELIMITERS = r"\s!?@\"^#$&~_,.:;+\-*%/|\\\[\](){}<>"
# Trailing four-digit year in parentheses, e.g. "Toy Story (1995)".
TRAILING_YEAR_STRIP = r"\s*\(\d{4}\)\s*$"
TRAILING_YEAR_CAPTURE = r"\((\d{4})\)\s*$"
# Genre list separator (a literal pipe; Spark's split takes a regex).
GENRE_SEPARATOR_REGEX = r"\|"
NO_GENRES = "(no genres listed)"
# ---------------------------------------------------------------------------

_TOKEN = f"([{INITCAP_DELIMITERS}]+|[^{INITCAP_DELIMITERS}]+)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """H1: INITCAP that also breaks words on punctuation.

    Spark's ``initcap`` breaks only on white space, so the text is cut into
    alternating runs of delimiters and non-delimiters and each run is
    capitalised: ``sci-fi o'brien (a.k.a. x)`` -> ``Sci-Fi O'brien (A.K.A. X)``.
    """
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(_TOKEN), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def strip_trailing_year(c) -> Column:
    """H3: drop a trailing ``(dddd)``; malformed years are left in place."""
    return F.regexp_replace(_col(c), TRAILING_YEAR_STRIP, "")


def parse_trailing_year(c) -> Column:
    """H4 + H5: the trailing year as int, NULL when absent or malformed.

    ``regexp_extract`` returns '' on no match (the warehouse returns NULL) and
    a plain cast of '' raises under ANSI, hence ``nullif`` + ``try_cast``.
    """
    raw = F.nullif(F.regexp_extract(_col(c), TRAILING_YEAR_CAPTURE, 1), F.lit(""))
    return raw.try_cast("int")


def clean_title(c) -> Column:
    """M6 movie_title: title case of the trimmed title without its year."""
    return title_case(F.trim(strip_trailing_year(c)))


def split_genres(c) -> Column:
    """H6: split on a literal pipe (escaped, since the delimiter is a regex)."""
    return F.split(_col(c), GENRE_SEPARATOR_REGEX)
