"""URL canonicalisation with built-in column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayline import lexicon
from dayline.functions.once import let
from dayline.functions.text import strip

_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _decode(c: Column) -> Column:
    # A malformed escape stays as it is, as form decoding does.
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def _encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def is_http_url(c: Column) -> Column:
    return F.lower(strip(c)).rlike(r"^https?://[^/?#]+")


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(strip(c), _URL, 2))


def canonical_query(query: Column) -> Column:
    """Drop tracking parameters, decode, sort pairs and encode again."""
    parts = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(
        parts,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(
                F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, r"(?s)^[^=]*=", "")).otherwise(F.lit(""))
            ).alias("v"),
        ),
    )
    kept = F.filter(
        pairs,
        lambda p: ~(
            F.lower(p["k"]).isin(*lexicon.TRACKING_KEYS) | F.lower(p["k"]).startswith(lexicon.TRACKING_PREFIX)
        ),
    )
    return F.array_join(
        F.transform(F.sort_array(kept), lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&"
    )


def canonical_url(c: Column) -> Column:
    """Lower-case scheme and host, drop default port, fragment, tracking and trailing '/'."""
    return let(strip(c), _canonical)


def _canonical(url: Column) -> Column:
    scheme = F.lower(F.regexp_extract(url, _URL, 1))
    host = F.lower(F.regexp_extract(url, _URL, 2))
    path = F.regexp_extract(url, _URL, 3)
    query = F.regexp_extract(url, _URL, 4)
    host = (
        F.when((scheme == "http") & host.endswith(":80"), F.regexp_replace(host, ":80$", ""))
        .when((scheme == "https") & host.endswith(":443"), F.regexp_replace(host, ":443$", ""))
        .otherwise(host)
    )
    path = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
    query = let(canonical_query(query), lambda q: F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q)))
    return (
        F.when(url == "", F.lit(""))
        .when((scheme == "") | (F.regexp_extract(url, _URL, 2) == ""), F.lower(url))
        .otherwise(F.concat(scheme, F.lit("://"), host, path, query))
    )
