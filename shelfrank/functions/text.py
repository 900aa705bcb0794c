"""Text and multi-value expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware whitespace class covers, and the label of missing categories.
WHITESPACE = r"\s\x1c-\x1f"
UNKNOWN = "Unknown"

MIN_TEXT_LENGTH = 10


def _remove(column: Column, pattern: str, replacement: str = "") -> Column:
    # (?U) makes \s and \S follow Unicode, so a no-break space separates words.
    return F.regexp_replace(column, f"(?U){pattern}", replacement)


def clean_text(text: Column) -> Column:
    """Lower case, without links and e-mail addresses; only letters a-z, apostrophes and single spaces remain."""
    word = f"[^{WHITESPACE}]+"
    lowered = F.lower(F.coalesce(text, F.lit("")))
    # Plain searches are much cheaper than patterns, and most texts hold neither a link nor an address.
    may_link = lowered.contains("http") | lowered.contains("www")
    unlinked = F.when(may_link, _remove(lowered, f"http{word}|www{word}")).otherwise(lowered)
    # The look-behind starts every attempt at a word start: same matches, linear time on very long words.
    address = f"(?<![^{WHITESPACE}]){word}@{word}"
    unaddressed = F.when(unlinked.contains("@"), _remove(unlinked, address)).otherwise(unlinked)
    # Any run of other characters is one space; single spaces are left alone.
    return F.trim(F.regexp_replace(unaddressed, "[^a-z' ][^a-z']*| [^a-z']+", " "))


def computed_once(value: Column) -> Column:
    """Evaluate ``value`` in a step of its own.

    A filter on a computed column is normally moved below the projection, which computes the column a second time.  The
    optimizer does not move it below a generator, so expensive values that are filtered on go through this one.
    """
    return F.explode(F.array(value))


def strip(text: Column) -> Column:
    """Remove whitespace of any kind at both ends."""
    return _remove(text, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$")


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(f"(?U)[^{WHITESPACE}]")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for an empty or missing text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"(?U)[^{WHITESPACE}]+"))


def char_count(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def comma_count(text: Column) -> Column:
    """Number of comma-separated parts; an empty or missing text has one."""
    return F.size(F.split(F.coalesce(text, F.lit("")), ","))


def split_list(text: Column) -> Column:
    """Comma list to array, parts stripped."""
    return F.transform(F.split(text, ","), strip)


def genre_list(genre: Column) -> Column:
    """Plain comma list; a missing value becomes the one-element list ``[Unknown]``."""
    return split_list(F.coalesce(genre, F.lit(UNKNOWN)))


def genre_names(genre: Column) -> Column:
    """Names from either a comma list or a list-of-dicts literal; blanks and ``Unknown`` carry no name."""
    literal = F.when(F.ltrim(genre).startswith("["), genre)
    for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
        literal = F.regexp_replace(literal, rf":\s*{word}\b", f": {value}")
    parsed = F.from_json(literal, "array<struct<name:string>>")
    other_list = F.from_json(literal, "array<string>").isNotNull()
    from_literal = F.filter(F.transform(parsed, lambda entry: strip(entry["name"])), lambda name: name != "")
    from_commas = F.filter(split_list(genre), lambda name: (name != "") & (name != UNKNOWN))
    empty = F.array().cast("array<string>")
    nameless = genre.isNull() | genre.isin("", UNKNOWN) | (parsed.isNull() & other_list)
    return F.when(nameless, empty).otherwise(F.coalesce(from_literal, from_commas))


def genre_text(genre: Column) -> Column:
    """Genre names as lower-case tokens: ``Science Fiction, Drama`` gives ``science_fiction drama``."""
    tokens = F.transform(genre_names(genre), lambda name: F.replace(F.lower(name), F.lit(" "), F.lit("_")))
    return F.array_join(tokens, " ")


def first_genre(genre: Column) -> Column:
    return strip(F.split(F.coalesce(genre, F.lit(UNKNOWN)), ",")[0])


def has_genre(genre: Column) -> Column:
    return genre.isNotNull() & ~genre.isin("", UNKNOWN)


def match_key(title: Column) -> Column:
    """Key under which titles are compared: lower case, stripped."""
    return strip(F.lower(title))


def title_equals(title: Column, wanted: str) -> Column:
    return F.lower(title) == F.lit(wanted.lower())


def title_contains(title: Column, wanted: str, regex: bool = False) -> Column:
    """Case-insensitive search; literal by default, ``regex=True`` reads ``wanted`` as a pattern."""
    lowered = F.lower(title)
    return lowered.rlike(wanted.lower()) if regex else lowered.contains(wanted.lower())
