"""Request-URL functions as Spark column expressions.

Rebuilt URLs are not valid URIs (a raw filter parameter keeps quotes, spaces and '<'), so
``parse_url`` is not used; the text is split with string and higher-order array functions,
all of which run row-local inside whole-stage code.

Parameters are kept as an ordered array of (key, values) entries rather than a map, so order
survives and no session setting is needed to override a key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportwide.operators.wide import col

Colish = Column | str

# Fixed value: the filter parameter that is appended last and never encoded.
RAW_PARAM = "cayenneExp"


def _c(x: Colish) -> Column:
    return col(x) if isinstance(x, str) else x


def url_base(url: Colish) -> Column:
    """scheme://host/path: fragment, query and path parameters removed, scheme lower-cased."""
    head = F.regexp_extract(_c(url), r"^([^?#]*)", 1)
    scheme = F.regexp_extract(head, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    rest = F.when(scheme == "", head).otherwise(F.substring(head, F.length(scheme) + 2, 1 << 30))
    rest = F.when(rest.startswith("//"), F.substring(rest, 3, 1 << 30)).otherwise(rest)
    # Path parameters: from the first ';' of the last path segment on.
    rest = F.regexp_replace(rest, r"^([^/]*/.*?);[^/]*$", "$1")
    return F.concat(F.lower(scheme), F.lit("://"), rest)


def url_query(url: Colish) -> Column:
    """Text between the first '?' and the fragment."""
    return F.regexp_extract(_c(url), r"^[^?#]*\?([^#]*)", 1)


def _decode(s: Column) -> Column:
    # '+' is a space; percent escapes decode as UTF-8; a '%' that starts no escape stays as it is.
    return F.url_decode(F.regexp_replace(s, r"%(?![0-9A-Fa-f]{2})", "%25"))


def url_pairs(url: Colish) -> Column:
    """Decoded (key, value) pairs in order (M1). Pieces without '=' and blank values drop."""
    parts = F.split(url_query(url), "&")
    parts = F.filter(parts, lambda p: F.instr(p, "=") > 0)
    pairs = F.transform(parts, lambda p: F.struct(
        F.substring_index(p, "=", 1).alias("key"),
        F.substring(p, F.instr(p, "=") + 1, 1 << 30).alias("value")))
    pairs = F.filter(pairs, lambda kv: F.length(kv["value"]) > 0)
    return F.transform(pairs, lambda kv: F.struct(_decode(kv["key"]).alias("key"),
                                                  _decode(kv["value"]).alias("value")))


def url_entries(url: Colish) -> Column:
    """Ordered (key, values) entries: repeated keys grouped at their first position (M1)."""
    pairs = url_pairs(url)
    keys = F.array_distinct(F.transform(pairs, lambda kv: kv["key"]))
    return F.transform(keys, lambda k: F.struct(
        k.alias("key"),
        F.transform(F.filter(pairs, lambda kv: kv["key"] == k), lambda kv: kv["value"]).alias("values")))


def url_params(url: Colish) -> Column:
    """map<key, array<value>> view of the entries (M1)."""
    e = url_entries(url)
    return F.map_from_arrays(F.transform(e, lambda x: x["key"]), F.transform(e, lambda x: x["values"]))


def quote_plus(s: Colish) -> Column:
    """Form encoding with '~' kept and '*' escaped, as Python's quote_plus does."""
    enc = F.url_encode(_c(s))
    return F.replace(F.replace(enc, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def set_param(entries: Colish, key: str, value: Colish) -> Column:
    """Replace a parameter's values in place, or append it when absent (M3, M4)."""
    e = _c(entries)
    v = _c(value) if not isinstance(value, (int, float)) else F.lit(str(value))
    v = F.array(v.cast("string"))
    present = F.exists(e, lambda x: x["key"] == F.lit(key))
    replaced = F.transform(e, lambda x: F.when(x["key"] == F.lit(key), F.struct(
        x["key"].alias("key"), v.alias("values"))).otherwise(x))
    appended = F.array_append(e, F.struct(F.lit(key).alias("key"), v.alias("values")))
    return F.when(present, replaced).otherwise(appended)


def rebuild_url(base: Colish, entries: Colish, raw_param: str = RAW_PARAM) -> Column:
    """base?k=v&... with every parameter encoded except ``raw_param``, appended last as is (M2)."""
    e = _c(entries)
    enc = F.filter(e, lambda x: x["key"] != F.lit(raw_param))
    pieces = F.flatten(F.transform(enc, lambda x: F.transform(
        x["values"], lambda v: F.concat(quote_plus(x["key"]), F.lit("="), quote_plus(v)))))
    query = F.array_join(pieces, "&")
    raw = F.filter(e, lambda x: x["key"] == F.lit(raw_param))
    raw_value = F.try_element_at(F.try_element_at(raw, F.lit(1))["values"], F.lit(1))
    tail = F.when(F.coalesce(F.length(raw_value), F.lit(0)) > 0,
                  F.concat(F.lit(f"&{raw_param}="), raw_value)).otherwise(F.lit(""))
    return F.concat(_c(base), F.lit("?"), query, tail)


def alter_url(url: Colish, start: Colish | int, limit: Colish | int) -> Column:
    """Set ``limit`` and ``start`` on a URL, other parameters and order kept (M3)."""
    e = set_param(url_entries(url), "limit", limit)
    e = set_param(e, "start", start)
    return rebuild_url(url_base(url), e)


def replace_param(url: Colish, key: str, value: Colish) -> Column:
    """Replace one parameter (the filter, by default the raw one) and rebuild (M4)."""
    return rebuild_url(url_base(url), set_param(url_entries(url), key, value))


def absolute_link(link: Colish, base: str, suffix: str = "") -> Column:
    """Base + relative link + suffix."""
    return F.concat(F.lit(base), _c(link), F.lit(suffix))
