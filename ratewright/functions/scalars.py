"""Scalar column functions.  Everything here stays inside Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the characters a string strip removes.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u2028\u2029\u3000"

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- text and lists


def strip(col: Column | str) -> Column:
    """Remove white space of every kind from both ends."""
    return F.trim(_col(col), F.lit(WHITESPACE))


def blank(col: Column | str) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(_col(col), F.lit(""))


def sponsor_name(plan: Column) -> Column:
    """Sponsor of a plan: the right spelling when filled, else the misspelt key as it stands."""
    return F.coalesce(F.nullif(plan["plan_sponsor_name"], F.lit("")), plan["plan_sponser_name"])


def list_join(array: Column | str) -> Column:
    """Pipe-joined list without null and empty entries; a null list gives ''.

    ``array_join`` leaves nulls out by itself.  No lambda is used, so that the projection
    stays in generated code.
    """
    return blank(F.array_join(F.array_remove(_col(array), ""), "|"))


def poly_list(col: Column | str) -> Column:
    """Scalar or list, read as STRING, as an array.

    The JSON reader hands a list over as its raw text; anything else is a scalar and
    becomes a list of one.
    """
    text = _col(col)
    parsed = F.from_json(text, T.ArrayType(T.StringType()))
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).otherwise(
        F.when(text.startswith("["), F.coalesce(parsed, F.array(text))).otherwise(F.array(text))
    )


def joined(col: Column, dtype: T.DataType) -> Column:
    """Pipe-joined text of a field that is either a declared list or a polymorphic string."""
    if isinstance(dtype, T.ArrayType):
        return list_join(col)
    # A scalar needs no parsing at all, and most values are scalars or short lists.
    return blank(F.when(col.startswith("["), list_join(poly_list(col))).otherwise(col))


def pipe_escape(col: Column | str) -> Column:
    """Null becomes '' and a pipe becomes a space."""
    return F.translate(blank(col), "|", " ")


# ---------------------------------------------------------------- numbers


_NUMBER = r"(?i)^\s*[-+]?(?:[0-9]+\.?[0-9]*(?:e[-+]?[0-9]+)?|\.[0-9]+(?:e[-+]?[0-9]+)?|nan|inf(?:inity)?)\s*$"


def safe_float(col: Column | str) -> Column:
    """Text to double; anything that is not a plain number gives null.

    The JVM also reads type suffixes and hexadecimal floats, which are not numbers here, and
    a cast that fails costs an exception per row; the pattern keeps both away from it.
    """
    text = _col(col)
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def safe_int(col: Column | str) -> Column:
    """Text to bigint; anything that is not a whole number gives null.

    Decimals are the usual misfits, so they are told apart before the cast has to fail.
    """
    text = _col(col)
    return F.when(~text.contains("."), text).try_cast("bigint")


def safe_ints(array: Column | str) -> Column:
    """Texts to bigints as :func:`safe_int`; decimals are left out, other misfits give null."""
    return F.filter(_col(array), lambda x: ~x.contains(".")).try_cast("array<bigint>")


# ---------------------------------------------------------------- URLs


def url_scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_col(url), _SCHEME, 1))


def url_authority(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _AUTHORITY, 1)


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _PATH, 1)


def url_query(url: Column | str) -> Column:
    return F.regexp_extract(_col(url), _QUERY, 1)


def last_segment(path: Column) -> Column:
    """Last name in a path; a closing slash does not count."""
    return F.regexp_extract(F.regexp_replace(path, r"(?:/\.?)+$", ""), r"([^/]*)$", 1)


def percent_decode(text: Column) -> Column:
    """Decode %XX only: a plus sign and a stray percent sign stay as they are."""
    guarded = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))


def _form_decode(text: Column) -> Column:
    return F.url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def form_encode(text: Column) -> Column:
    """Query-string encoding in which only letters, digits and ``_.-~`` stay plain."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def path_encode(text: Column) -> Column:
    """Path-segment encoding: as :func:`form_encode`, with %20 for a space."""
    return F.replace(form_encode(text), F.lit("+"), F.lit("%20"))


def url_filename(url: Column | str) -> Column:
    """Last segment of the decoded path."""
    return last_segment(percent_decode(url_path(strip(url))))


def source_name(url: Column | str) -> Column:
    """Stable stem ``host__file`` of a URL; characters outside words and dashes become ``_``."""
    url = _col(url)
    authority, name = url_authority(url), last_segment(url_path(url))
    host = F.when(authority == "", F.lit("local")).otherwise(authority)
    name = F.when(name == "", F.lit("unknown")).otherwise(name)
    name = F.regexp_replace(name, r"(?i)\.json(\.gz)?$", "")
    clean = lambda c: F.regexp_replace(c, r"(?U)[^\w\-]", "_")
    return F.concat(clean(host), F.lit("__"), clean(name))


def repair_url(url: Column | str) -> Column:
    """Trim, and complete a scheme whose first letters were lost."""
    text = strip(url)
    lowered = F.lower(text)
    return (
        F.when(lowered.startswith("tps://"), F.concat(F.lit("ht"), text))
        .when(lowered.startswith("ttp://"), F.concat(F.lit("h"), text))
        .otherwise(text)
    )


def file_key(url: Column | str) -> Column:
    """Short stable key of a URL: 24 hex digits of its SHA-256."""
    return F.substring(F.sha2(_col(url), 256), 1, 24)


def parse_seed_url(url: Column | str, aliases: dict[str, str] | None = None, strict: bool = True) -> Column:
    """Split a signed object URL into base_url, container, prefix and query parameters.

    ``params`` keeps the order of first appearance; of a repeated key the last value
    counts.  ``aliases`` gives the host behind another one.  A URL with fewer than two path parts is
    an error, or null when not strict.
    """
    url = _col(url)
    parts = F.filter(F.split(url_path(url), "/"), lambda p: p != "")
    authority = url_authority(url)
    host = authority
    for alias, origin in (aliases or {}).items():
        host = F.when(F.lower(authority) == alias, F.lit(origin)).otherwise(host)
    folders = F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    prefix = F.when(F.size(folders) > 0, F.concat(F.array_join(folders, "/"), F.lit("/"))).otherwise("")
    entries = F.transform(
        F.filter(F.split(url_query(url), "&"), lambda p: p != ""),
        lambda p: F.struct(
            _form_decode(F.regexp_extract(p, r"^([^=]*)", 1)).alias("key"),
            _form_decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )
    params = F.transform(
        F.array_distinct(F.transform(entries, lambda e: e["key"])),
        lambda key: F.struct(
            key.alias("key"),
            F.element_at(F.filter(entries, lambda e: e["key"] == key), -1)["value"].alias("value"),
        ),
    )
    parsed = F.struct(
        F.concat(F.lit("https://"), host).alias("base_url"),
        F.get(parts, F.lit(0)).alias("container"),
        prefix.alias("prefix"),
        params.alias("params"),
    )
    ok = F.when(F.size(parts) >= 2, parsed)
    if strict:
        return ok.otherwise(
            F.raise_error(F.concat(F.lit("seed URL needs a container and an object path: "), url))
        )
    return ok


def blob_url(base_url: Column, container: Column, name: Column, params: Column) -> Column:
    """Object URL with an encoded path and query (``params`` as in :func:`parse_seed_url`)."""
    path = F.array_join(F.transform(F.split(name, "/"), path_encode), "/")
    query = F.array_join(
        F.transform(
            params, lambda p: F.concat(form_encode(p["key"]), F.lit("="), form_encode(p["value"]))
        ),
        "&",
    )
    return F.concat(base_url, F.lit("/"), container, F.lit("/"), path, F.lit("?"), query)


def month_prefix(month: Column | str) -> Column:
    """Listing prefix of a month: ``YYYY-MM-01/``."""
    month = F.lit(month) if isinstance(month, str) else month
    return F.concat(month, F.lit("-01/"))


def size_from_headers(content_length: Column | str, etag: Column | str) -> Column:
    """Content-Length; without one, the hexadecimal tail of the ETag; else 0.

    A Content-Length that is present but not a number gives 0, not the ETag.
    """
    length, etag = _col(content_length), _col(etag)
    tail = F.regexp_extract(blank(etag), r"-([0-9A-Fa-f]+)\"*$", 1)
    from_tag = F.when(tail != "", F.conv(tail, 16, 10).try_cast("bigint"))
    given = length.isNotNull() & (length != "")
    return F.coalesce(F.when(given, safe_int(length)).otherwise(from_tag), F.lit(0).cast("bigint"))
