"""Canonical URLs and document identity as Column functions (F-01..F-05, F-34, F-36, F-37)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that only track, and prefixes of such keys.
TRACKING = ("ref", "ref_src", "fbclid", "gclid")
TRACKING_PREFIX = "utm_"
ARXIV = "arxiv.org"
DIGEST = 16

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def _part(url: Column, pattern: str) -> Column:
    return F.regexp_extract(url, pattern, 1)


def host_of(url: Column) -> Column:
    """Lower-case host name, without userinfo and port; empty where there is none."""
    return F.lower(F.regexp_extract(F.regexp_replace(_part(F.trim(url), _AUTHORITY), r"^.*@", ""), r"^(\[[^\]]*\]|[^:]*)", 1))


def port_of(url: Column) -> Column:
    """Port as written, null where there is none."""
    return F.nullif(F.regexp_extract(_part(F.trim(url), _AUTHORITY), r":(\d+)$", 1), F.lit(""))


def _decode(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def _encode(x: Column) -> Column:
    """Percent-encoding with + for a space; Java's encoder leaves * and encodes ~, the rule here is the reverse."""
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """https, lower-case host, no default port of the original scheme, no tracking keys, sorted query, no fragment, no trailing slashes."""
    url = F.trim(url)
    scheme, port = F.lower(_part(url, _SCHEME)), port_of(url)
    default = F.when(scheme == "https", F.lit("443")).when(scheme == "http", F.lit("80")).otherwise(F.lit(""))
    keep_port = port.isNotNull() & (port.cast("int").cast("string") != default)
    place = F.concat(host_of(url), F.when(keep_port, F.concat(F.lit(":"), port.cast("int").cast("string"))).otherwise(F.lit("")))
    path = _part(url, _PATH)
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    pairs = F.transform(
        F.filter(F.split(_part(url, _QUERY), "&"), lambda p: p != ""),
        lambda p: F.struct(_decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), _decode(F.regexp_extract(p, "^[^=]*=?(.*)$", 1)).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~p.k.isin(*TRACKING) & ~p.k.startswith(TRACKING_PREFIX)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p.k), F.lit("="), _encode(p.v))), "&")
    return F.concat(F.lit("https://"), place, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def is_arxiv(url: Column) -> Column:
    return host_of(url) == ARXIV


def arxiv_paper_id(url: Column) -> Column:
    """Last segment of the path without .pdf; an error if it is empty."""
    segment = F.regexp_replace(F.element_at(F.split(F.regexp_extract(canonical_url(url), r"^https://[^/?]*([^?]*)", 1), "/"), -1), r"\.pdf$", "")
    return F.when(segment == "", F.raise_error(F.concat(F.lit("no paper id in "), url)).cast("string")).otherwise(segment)


def doc_id(url: Column) -> Column:
    """arXiv:<paper id>, or news:<first hex digits of the canonical URL's SHA-256>."""
    return F.when(is_arxiv(url), F.concat(F.lit("arXiv:"), arxiv_paper_id(url))).otherwise(
        F.concat(F.lit("news:"), F.left(F.sha2(canonical_url(url), 256), F.lit(DIGEST))))


def source_for(url: Column) -> Column:
    return F.when(is_arxiv(url), F.lit("arxiv")).otherwise(F.lit("news"))


def locator_for(url: Column) -> Column:
    return F.when(is_arxiv(url), F.lit("abstract")).otherwise(F.lit("feed_excerpt"))


def registrable(host: Column) -> Column:
    """Last two labels of a host."""
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")


def endpoint(url: Column) -> Column:
    """host:port with the scheme's default port."""
    scheme = F.lower(_part(F.trim(url), _SCHEME))
    return F.concat(host_of(url), F.lit(":"), F.coalesce(port_of(url), F.when(scheme == "https", F.lit("443")).otherwise(F.lit("80"))))
