"""URL parts, normalization, safety and canonical keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank

# Query parameters that only track, and hosts that list other people's work.
TRACKING = ["ref", "referrer", "source", "fbclid", "gclid", "ncid", "ocid"]
AGGREGATORS = [
    "example.com", "github.com", "techcrunch.com", "venturebeat.com", "theverge.com", "arxiv.org", "huggingface.co", "remoteok.com",
    "arbeitnow.com", "ycombinator.com", "himalayas.app",
]
# Names of the machine itself, and path owners that are pages of the site.
LOOPBACK_NAMES = ["localhost", "localhost.localdomain", "broadcasthost"]
SITE_WORDS = ["topics", "trending", "features", "explore", "pricing", "collections", "events", "readme", "about", "site"]

#: IPv4 ranges that are not public: (first octets as a number, prefix length)
BLOCKED_V4 = [
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 29), ("192.0.0.170", 31),
    ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4),
]

_PARTS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, i: int) -> Column:
    return F.regexp_extract(F.trim(blank(url)), _PARTS, i)


def host_port(url: Column) -> Column:
    """Lower-case network location, port kept."""
    return F.lower(_part(url, 2))


def host(url: Column) -> Column:
    """Lower-case host without user, port and brackets."""
    h = F.regexp_replace(host_port(url), r"^.*@", "")
    return F.when(h.startswith("["), F.regexp_extract(h, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_replace(h, r":\d*$", ""))


def registrable_domain(url: Column) -> Column:
    """Last two labels of the host."""
    return F.array_join(F.slice(F.split(host(url), r"\."), F.greatest(F.size(F.split(host(url), r"\.")) - 1, F.lit(1)), 2), ".")


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, no default port, fragment, tracking parameter or trailing slash; an empty path is ``/``."""
    scheme, loc = F.lower(_part(url, 1)), host_port(url)
    port = F.when((scheme == "http") & loc.endswith(":80"), ":80").when((scheme == "https") & loc.endswith(":443"), ":443").otherwise("")
    loc = F.substring(loc, F.lit(1), F.length(loc) - F.length(port))
    path = F.regexp_replace(_part(url, 3), "/+$", "")
    path = F.when(path == "", "/").otherwise(path)
    name = lambda p: F.lower(F.substring_index(p, "=", 1))
    kept = F.filter(F.split(_part(url, 4), "&"), lambda p: (p != "") & ~name(p).startswith("utm_") & ~name(p).isin(TRACKING))
    query = F.array_join(F.transform(kept, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&")
    return F.when(scheme == "", F.lit("")).otherwise(F.concat(scheme, F.lit("://"), loc, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _number(ip: str) -> int:
    a, b, c, d = map(int, ip.split("."))
    return (a << 24) + (b << 16) + (c << 8) + d


def _v4(text: Column) -> Column:
    """IPv4 literal as a number; null otherwise."""
    p = F.split(text, r"\.")
    ok = text.rlike(r"^(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}$")
    n = sum((F.get(p, F.lit(i)).try_cast("long") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0))
    return F.when(ok, n)


def ip_blocked(text: Column) -> Column:
    """Whether the text is an IP literal that is private, loopback, link-local or reserved, NAT64 forms included."""
    low = F.lower(blank(text))
    hexes = F.regexp_extract(low, r"^64:ff9b::([0-9a-f]{1,4}):([0-9a-f]{1,4})$", 1), F.regexp_extract(low, r"^64:ff9b::([0-9a-f]{1,4}):([0-9a-f]{1,4})$", 2)
    nat = F.when(hexes[0] != "", F.conv(hexes[0], 16, 10).cast("long") * 65536 + F.conv(hexes[1], 16, 10).cast("long"))
    n = F.coalesce(_v4(low), _v4(F.regexp_extract(low, r"^64:ff9b::([0-9.]+)$", 1)), nat)
    v4 = F.lit(False)
    for ip, bits in BLOCKED_V4:
        v4 = v4 | ((n >= _number(ip)) & (n < _number(ip) + (1 << (32 - bits))))
    v6 = low.rlike(r"^(::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|2001:db8:.*|100::.*)$")
    return F.coalesce(v4, F.lit(False)) | v6


def safe_url(url: Column) -> Column:
    """Scheme http or https, a host, and no literal of an internal address. Names are not resolved."""
    return F.lower(_part(url, 1)).isin("http", "https") & (host(url) != "") & ~host(url).isin(LOOPBACK_NAMES) & ~ip_blocked(host(url))


def owner_repo(text: Column) -> Column:
    """Last two path parts, lower case."""
    p = F.filter(F.split(F.lower(F.trim(blank(text))), "/"), lambda x: x != "")
    return F.array_join(F.slice(p, F.greatest(F.size(p) - 1, F.lit(1)), 2), "/")


def canonical_key(repo: Column, url: Column, name: Column) -> Column:
    """``gh:`` repository, else ``url:`` without scheme and www, else ``name:`` of letters and digits."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(F.trim(url)), "/+$", ""), r"^https?://(www\.)?", "")
    return (
        F.when(blank(repo) != "", F.concat(F.lit("gh:"), F.trim(F.lower(repo))))
        .when(blank(url) != "", F.concat(F.lit("url:"), bare))
        .otherwise(F.concat(F.lit("name:"), F.regexp_replace(F.lower(blank(name)), "[^a-z0-9]", "")))
    )


def repo_owner(url: Column) -> Column:
    """Owner of a repository URL; null for site pages and other hosts."""
    o = F.regexp_extract(blank(url), r"github\.com/([^/\s?#]+)", 1)
    return F.when((o != "") & ~F.lower(o).isin(SITE_WORDS), o)


def official_domain(domain: Column, key: Column) -> Column:
    """Whether a domain may be the entity's own: no aggregator, and its stem and the name hold one another."""
    stem = F.substring_index(domain, ".", 1)
    return (blank(domain) != "") & (blank(key) != "") & ~domain.isin(AGGREGATORS) & (F.contains(key, stem) | F.contains(stem, key))


def product_url_excluded(url: Column) -> Column:
    return url.rlike(r"\.(md|png|jpg|svg)$") | url.contains("#") | url.contains("awesome.re")


def external_link(html: Column, own_host: str) -> Column:
    """First http link of a snippet that leads away from ``own_host``; null without one."""
    links = F.regexp_extract_all(blank(html), F.lit('(?i)href="(https?://[^"]+)"'), F.lit(1))
    return F.get(F.filter(links, lambda x: ~F.lower(x).rlike("^https?://" + own_host.replace(".", r"\."))), F.lit(0))
