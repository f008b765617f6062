"""Text rules of the two feeds: titles, categories, runtimes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values ---------------------------------------------------------------
GLOBAL_REGION = "Global"
SHOW = "Show"
MOVIE = "Movie"
ENGLISH = "English"
NON_ENGLISH = "Non-English"
FILMS_PREFIX = "Films"
MISSING_MARKS = ("N/A", "nan", "")
COUNTRY_CATEGORIES = {"Films": MOVIE, "TV": SHOW}
WORLDWIDE_CATEGORIES = tuple(f"{kind} ({tongue})" for kind in COUNTRY_CATEGORIES for tongue in (ENGLISH, NON_ENGLISH))
# Characters counted as white space around a value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ----------------------------------------------------------------------------


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def present(text: Column) -> Column:
    """The stripped text, or NULL when it is one of the missing marks."""
    bare = strip(text)
    return F.when(~bare.isin(*MISSING_MARKS), bare)


def title_key(show: Column, season: Column) -> Column:
    """Season title when there is one, else the show title; NULL if neither."""
    return F.coalesce(present(season), present(show))


def runtime_minutes(runtime: Column) -> Column:
    """Minutes of an ``h:mm`` text; NULL for any other form."""
    parts = F.split(strip(runtime), ":")
    hours = F.get(parts, F.lit(0)).try_cast("int")
    minutes = F.get(parts, F.lit(1)).try_cast("int")
    return F.when(F.size(parts) == 2, hours * 60 + minutes)


def category_type(category: Column) -> Column:
    """``Films...`` is a movie; everything else, also no category, is a show."""
    return F.when(category.startswith(FILMS_PREFIX), MOVIE).otherwise(SHOW)


def category_language(category: Column) -> Column:
    return F.when(category.contains(NON_ENGLISH), NON_ENGLISH).otherwise(ENGLISH)


def recode(value: Column, mapping: dict[str, str]) -> Column:
    """Mapped value, or the value itself where the mapping has no entry."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)
