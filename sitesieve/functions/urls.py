"""URLs, hosts and sites as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitesieve.functions import fixed

_URL = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"


def host(value: Column) -> Column:
    """Lower-case host, without www. and port, of a URL, an address or a bare domain; empty if there is none."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    v = F.when(v.contains("@") & ~v.contains("/"), F.substring_index(v, "@", -1)).otherwise(v)
    return F.regexp_replace(F.regexp_extract(v, r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\.|\.+$", "")


def ascii_host(h: Column) -> Column:
    """Punycode of a host; hosts that cannot be converted (empty or over-long labels) stay as they are."""
    plain = lambda x: x.rlike(r"^[\x00-\x7f]*$") | x.rlike(r"\.\.|^\.|[^.]{50,}")
    code = lambda x: F.when(plain(x), x).otherwise(F.reflect(F.lit("java.net.IDN"), F.lit("toASCII"), F.when(plain(x), F.lit("")).otherwise(x)))
    return fixed.let(F.regexp_replace(F.lower(F.trim(F.coalesce(h, F.lit("")))), r"\.+$", ""), code)


def shown_host(h: Column) -> Column:
    """Punycode labels as they are shown to people."""
    return F.reflect(F.lit("java.net.IDN"), F.lit("toUnicode"), h)


def _labels(h: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(h, F.lit(""))), r"\."), lambda x: x != "")


def _last(labels: Column, k: int) -> Column:
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), F.lit(k)), ".")


def registrable(h: Column) -> Column:
    """The registrable domain: two labels, or three under a suffix of two."""
    x = _labels(h)
    return F.when((F.size(x) >= 3) & _last(x, 2).isin(*fixed.TWO_PART_SUFFIXES), _last(x, 3)).otherwise(_last(x, 2))


site = registrable


def own_site(h: Column) -> Column:
    """The unit that is one company's: the registrable domain, or the label before a shared suffix (the longest counts)."""
    under = lambda x, k: (F.size(x) > k) & _last(x, k).isin(*fixed.SHARED_SUFFIXES)
    bare = lambda x: F.when((F.try_element_at(x, F.lit(1)) == "www") & (F.size(x) > 2), F.slice(x, 2, 99)).otherwise(x)
    unit = lambda x: F.when(under(x, 3), _last(x, 4)).when(under(x, 2), _last(x, 3)).otherwise(_last(x, 2))
    return fixed.let(_labels(ascii_host(h)), lambda x: fixed.let(bare(x), unit))


def core(h: Column) -> Column:
    """The brand's part of a domain."""
    return F.substring_index(registrable(h), ".", 1)


def own_core(h: Column) -> Column:
    """The brand's part of the company's site, as people read it."""
    return F.substring_index(shown_host(own_site(h)), ".", 1)


def is_aggregator(h: Column) -> Column:
    return F.arrays_overlap(F.array(h, own_site(h), registrable(h)), F.array(*map(F.lit, dict.fromkeys(fixed.AGGREGATORS))))


def is_free_mail(h: Column) -> Column:
    return h.isin(*fixed.FREE_MAIL) | registrable(h).isin(*fixed.FREE_MAIL)


def is_connection_error(error: Column, markers: list[str]) -> Column:
    """A failure of the connection, not an answer: the error starts with one of the markers."""
    out = F.lit(False)
    for m in markers:
        out = out | F.coalesce(error, F.lit("")).startswith(m)
    return out


def path(url: Column) -> Column:
    return F.regexp_extract(url, _URL + r"[^/?#]*([^?#]*)", 1)


def comparable(url: Column) -> Column:
    """Without scheme, www., port, fragment and the path's last slashes."""
    url = F.trim(url)
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]+)", 1)
    return F.concat(host(url), F.regexp_replace(path(url), r"/+$", ""), query)


def without_tracking(url: Column) -> Column:
    """Without fragment and the parameters ref, utm_* and gclid."""
    x = F.regexp_replace(F.regexp_replace(url, r"#.*$", ""), r"([?&])(?:ref|utm_[a-z]+|gclid)=[^&]*", "$1")
    return F.regexp_replace(F.regexp_replace(x, r"&+", "&"), r"[?&]+$", "")


def clean_path(p: Column) -> Column:
    """Dot segments (spelled %2e too) removed, a fold over the segments; one at the end leaves its slash."""
    segments = F.slice(F.split(p, "/", -1), 2, 1 << 20)
    n = F.size(segments)
    dots = lambda s: F.regexp_replace(s, "(?i)%2e", ".")
    fold = lambda acc, s: F.when(dots(s) == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(dots(s) == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(segments, F.expr("cast(array() as array<string>)"), fold)
    tail = F.when((n > 0) & dots(F.element_at(F.concat(F.array(F.lit("")), segments), -1)).isin(".", ".."), F.array(F.lit(""))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.when(p == "", "").otherwise(F.concat(F.lit("/"), F.array_join(F.concat(kept, tail), "/")))


def requested(url: Column) -> Column:
    """A URL as it is asked for: dot segments, fragment, an empty query, tabs and line ends go; others stay as they are."""
    x = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[\t\r\n]", "")
    base, query = F.regexp_extract(x, r"^(?i:https?)(://[^/?#]+)", 0), F.regexp_extract(x, r"^[^?#]*(\?[^#]+)", 1)
    base = F.concat(F.lower(F.substring_index(base, ":", 1)), F.substr(base, F.length(F.substring_index(base, ":", 1)) + 1))
    return F.when(x.rlike(r"^(?i:https?)://[^/?#]"), F.concat(base, clean_path(path(x)), query)).otherwise(url)


def is_robots_file(url: Column) -> Column:
    return path(url) == "/robots.txt"
