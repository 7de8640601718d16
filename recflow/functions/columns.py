"""Column expressions shared by the operators (all built-in Spark SQL)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from recflow import params as P

# per-user order of events: time, then item, then rating, so that equal
# timestamps are split the same way on every run
EVENT_ORDER = ("ts", "item_id", "rating")


def genre_column(genre: str, prefix: str = "genre_") -> str:
    """Column name of a genre flag: lower case; space and hyphen -> '_';
    parentheses dropped ('(no genres listed)' -> 'no_genres_listed')."""
    name = genre.replace(" ", "_").replace("-", "_").lower()
    name = re.sub(r"[()]", "", name).strip("_")
    return prefix + name


def genre_flag(genres: Column, genre: str) -> Column:
    """1 when ``genre`` is one of the pipe-separated tokens, else 0."""
    return F.array_contains(F.split(genres, r"\|"), F.lit(genre)).cast("int")


def release_year(title: Column) -> Column:
    """First four-digit year in parentheses; NULL when there is none."""
    return F.regexp_extract(title, r"\((\d{4})\)", 1).try_cast("int")


def normalized_reward(rating: Column) -> Column:
    """Rating 0.5..5.0 -> [0, 1]."""
    return (rating - F.lit(P.RATING_MIN)) / F.lit(P.RATING_SPAN)


def decade_bucket(year: Column) -> Column:
    clamped = F.least(F.greatest(year, F.lit(P.YEAR_MIN)), F.lit(P.YEAR_MAX))
    return F.floor((clamped - F.lit(P.YEAR_MIN)) / F.lit(P.YEAR_BUCKET)).cast("int")


def n_decade_buckets() -> int:
    return (P.YEAR_MAX - P.YEAR_MIN) // P.YEAR_BUCKET + 1


def md5_key(*cols: Column | str) -> Column:
    """Deterministic pseudo-random sort key, reproducible in any engine that
    has md5: md5 of the ':'-joined values."""
    return F.md5(F.concat_ws(":", *[F.col(c).cast("string") if isinstance(c, str)
                                     else c.cast("string") for c in cols]))


def gain(rel: Column) -> Column:
    return F.pow(F.lit(2.0), rel) - F.lit(1.0)


def discount(rank: Column) -> Column:
    return F.log2(rank + F.lit(1))


def fixed(c: Column, places: int = 6) -> Column:
    """Round half up to ``places`` decimals as floor(x * 10^p + 0.5) / 10^p.
    Every step is one IEEE operation, so any engine that evaluates the same
    formula gets the same double (decimal ``round`` implementations differ
    on values that sit on a half)."""
    scale = float(10 ** places)
    return (F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale))


def rank_key(c: Column, places: int = 9) -> Column:
    """Integer sort key of a float score at ``places`` decimals, so that
    near-ties rank the same in every engine and on every run."""
    return F.floor(c * F.lit(float(10 ** places)) + F.lit(0.5))
