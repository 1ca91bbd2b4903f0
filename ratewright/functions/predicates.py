"""Boolean column functions used by filters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewright.functions import scalars as S

# State names and postal codes.
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS", "Missouri": "MO",
    "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH", "New Jersey": "NJ",
    "New Mexico": "NM", "New York": "NY", "North Carolina": "NC", "North Dakota": "ND", "Ohio": "OH",
    "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA", "Rhode Island": "RI", "South Carolina": "SC",
    "South Dakota": "SD", "Tennessee": "TN", "Texas": "TX", "Utah": "UT", "Vermont": "VT",
    "Virginia": "VA", "Washington": "WA", "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}

# Words in the name of a file that holds prices and is no index.
PRICING_NAME_WORDS = ("in-network", "in_network", "allowed-amount", "allowed_amount")


def _any(conditions: Iterable[Column]) -> Column:
    result = None
    for condition in conditions:
        result = condition if result is None else result | condition
    return F.lit(True) if result is None else result


def code_matches(code: Column | str, prefixes: Sequence[str] | None) -> Column:
    """The trimmed code starts with one of the prefixes; no prefixes let everything pass."""
    filled = set(map(str.strip, prefixes or ())) - {""}
    trimmed = S.strip(S.blank(code))
    return _any(trimmed.startswith(begin) for begin in sorted(filled))


def _like_word(url: Column, word: str) -> Column:
    return url.ilike("%" + word.replace("\\", "\\\\") + "%")


def url_contains(url: Column | str, words: Sequence[str]) -> Column:
    """Some word occurs, in any case.  ``%`` and ``_`` in a word keep their LIKE meaning."""
    url = S._col(url)
    return _any(_like_word(url, w) for w in words)


def url_skip(url: Column | str, words: Sequence[str]) -> Column:
    """No word occurs, in any case."""
    return ~url_contains(url, words) if words else F.lit(True)


def mentions_state(url: Column | str, states: Sequence[str]) -> Column:
    """A state name occurs anywhere, or its code stands between dashes or underscores.

    All names share one pattern and so do all codes: a URL is scanned twice, not once per
    state.  A name outside the table uses its first two letters as the code.
    """
    url = S._col(url)
    codes = [STATE_CODES.get(name, name.upper()[:2]) for name in states]
    names = "|".join(re.escape(name) for name in states)
    return url.rlike(f"(?i){names}") | url.rlike(f"(?i)[-_](?:{'|'.join(map(re.escape, codes))})[-_]")


def state_rule(url: Column | str, skip: Sequence[str], target: Sequence[str] = ()) -> Column:
    """Keep a URL unless it mentions a skipped state and no target state."""
    if not skip:
        return F.lit(True)
    skipped = mentions_state(url, skip)
    return ~(skipped & ~mentions_state(url, target)) if target else ~skipped


def has_location(url: Column | str) -> Column:
    url = S._col(url)
    return url.isNotNull() & (url != "")


def size_cap(max_bytes: int | None = None, max_gb: float | None = None) -> int | None:
    """The byte limit in force: gigabytes, when given, win."""
    return int(max_gb * 1_000_000_000) if max_gb is not None else max_bytes


def within_size(size: Column | str, max_bytes: int | None = None, max_gb: float | None = None) -> Column:
    """Size known and not above the limit; no limit lets everything pass."""
    cap = size_cap(max_bytes, max_gb)
    return F.lit(True) if cap is None else F.coalesce(S._col(size) <= F.lit(cap), F.lit(False))


def is_index(url: Column | str) -> Column:
    """The file name holds "index" and ends like a JSON file."""
    url = S._col(url)
    path = S.url_path(url)
    name = F.lower(S.last_segment(F.when(path == "", url).otherwise(path)))
    return name.contains("index") & (name.endswith(".json") | name.endswith(".json.gz"))


def is_index_object(name: Column | str) -> Column:
    """As :func:`is_index`, for an object name that is a path and no URL."""
    last = F.lower(S.last_segment(S._col(name)))
    return last.contains("index") & (last.endswith(".json") | last.endswith(".json.gz"))


def not_pricing_name(url: Column | str) -> Column:
    """The file name has none of the words that mark price files."""
    name = F.lower(S.url_filename(url))
    return ~_any(name.contains(word) for word in PRICING_NAME_WORDS)


def is_supported(url: Column | str) -> Column:
    """A web address, or a plain path (whether it exists is for the reader to say)."""
    url = S._col(url)
    scheme = S.url_scheme(url)
    return (S.strip(url) != "") & scheme.isin("http", "https", "file", "")
