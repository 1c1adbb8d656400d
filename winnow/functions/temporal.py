"""Dates from many forms, and freshness against an explicit ``now``. Nothing reads the wall clock.

``now`` is a value or a column, but not a subquery: all but :func:`is_fresh` work inside higher-order
functions, which take none (``engine.fixed`` makes a value of one).
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank

# Meta tags that carry a date, in order.
META_KEYS = [
    ("property", "article:published_time"),
    ("property", "og:article:published_time"),
    ("name", "article:published_time"),
    ("name", "publish_date"),
    ("name", "pubdate"),
    ("name", "date"),
    ("name", "sailthru.date"),
    ("name", "dc.date"),
    ("name", "dc.date.issued"),
]
JSON_LD_KEYS = ["datePublished", "dateCreated", "uploadDate"]
PATTERNS = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z"]
#: dates as people write them
WRITTEN = [f"{d}{t}" for d in ("MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy", "d MMM yyyy", "d MMMM yyyy", "MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd", "yyyy-MM-dd") for t in ("", " HH:mm:ss", " HH:mm", " h:mm a")]
SECONDS = {"hour": 3600, "minute": 60, "min": 60, "sec": 1, "day": 86400, "week": 7 * 86400, "month": 30 * 86400, "year": 365 * 86400}


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def relative_time(text: Column, now: Column) -> Column:
    """``N units ago``, an hour ago, yesterday, today and just now; a month counts 30 days, a year 365."""
    ago = rf"\b(\d+)\s*({'|'.join(SECONDS)})[a-z]*\s*ago\b"
    back = lambda k, s: F.timestamp_seconds(F.unix_timestamp(k["now"]) - s)

    def parts(k: Column) -> Column:
        t = k["t"]
        n, unit, word = F.regexp_extract(t, ago, 1).try_cast("long"), F.regexp_extract(t, ago, 2), F.regexp_extract(t, r"\b(just\s+now|yesterday|today)\b", 1)
        return F.when(t.rlike("ago|now|day"), F.struct(n.alias("n"), unit.alias("unit"), word.alias("word"), k["now"].alias("now")))

    def told(k: Column) -> Column:
        each = F.coalesce(*[F.when(k["unit"] == u, F.lit(s)) for u, s in SECONDS.items()])
        return F.when(k["n"].isNotNull(), back(k, k["n"] * each)).when(k["word"] == "yesterday", back(k, F.lit(86400))).when(k["word"] != "", k["now"])

    t = F.regexp_replace(F.lower(blank(text)), r"\ban?\s+(?=[a-z]+\s+ago\b)", "1 ")
    return once(F.struct(t.alias("t"), now.alias("now")), lambda k: once(parts(k), told))


def _shape(text: Column) -> Column:
    """The text with ``a`` for each run of letters and ``0`` for each number, its sign included."""
    return F.regexp_replace(F.regexp_replace(text, r"\p{L}+", "a"), r"(?<!\d)[+-]?\d+", "0")


def _pattern_shape(pattern: str) -> str:
    """The shape of every text that a date pattern without offset or zone reads."""
    return re.sub(r"(MMM+|a)|[A-Za-z]+", lambda m: "a" if m[1] else "0", pattern)


def _stated(text: Column) -> Column:
    """A date by PATTERNS; only those that read texts of this shape are tried, as one that fails costs far more than one that reads."""
    offset, plain, spaced, day, named, signed = (F.try_to_timestamp(text, F.lit(p)) for p in PATTERNS)

    def by_shape(s: Column) -> Column:
        iso = F.when(s.startswith("0-0-0a0:0:0"), F.when(s.rlike(r"(a|[+-]0:0)$"), offset).otherwise(plain))
        return iso.when(s == "0-0-0 0:0:0", spaced).when(s == "0-0-0", day).when(s == "0 a 0 0:0:0 0", F.coalesce(signed, named)).when(s.startswith("0 a 0 0:0:0 "), F.coalesce(named, signed))

    return once(_shape(text), by_shape)


def _written(text: Column) -> Column:
    """A date as people write it, tried where the text looks like one: some letters of a month, or slashes, or a bare time of day."""
    looks = text.rlike(r"(?i)^((jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\s+\d|\d{1,2}\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)|\d{1,4}/\d|\d{4}-\d{2}-\d{2}\s+\d)")
    shapes: dict[str, list[str]] = {}
    for p in WRITTEN:
        shapes.setdefault(_pattern_shape(p), []).append(p)

    def by_shape(s: Column) -> Column:
        tried = [(s == shape, F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])) for shape, patterns in shapes.items()]
        return reduce(lambda out, t: out.when(*t), tried[1:], F.when(*tried[0]))

    return F.when(looks, once(_shape(text), by_shape))


NUMBER = r"^\d+(\.\d+)?$"


def _epoch(number: Column) -> Column:
    n = number.try_cast("double")
    return F.when(n > 0, F.when(n > 1e11, F.timestamp_millis(n.cast("long"))).otherwise(F.timestamp_seconds(n)))


def parse_date(value: Column, now: Column) -> Column:
    """UTC time of epoch seconds, epoch milliseconds (above 1e11), ISO, RFC or relative text; null for blank, 0 and the rest."""

    def told(k: Column) -> Column:
        v = k["v"]
        bare = F.regexp_replace(v, r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+", "")
        plain = lambda b: F.regexp_replace(F.regexp_replace(b, r"(?i)\b(\d{1,2})(st|nd|rd|th)\b", "$1"), r"(?i)\s+(utc|gmt|at)\b|\.(?=\s)", "")
        text = once(bare, lambda b: F.coalesce(_stated(b), once(plain(b), _written)))
        return F.when(v.rlike(NUMBER), _epoch(v)).when(v != "", F.coalesce(text, relative_time(v, k["now"])))

    return once(F.struct(F.trim(blank(value.cast("string"))).alias("v"), now.alias("now")), told)


def is_fresh(ts: Column, now: Column, hours: int = 24, ahead_minutes: int = 10) -> Column:
    """Age from ``-ahead_minutes`` to ``hours``, both ends included; a null time is not fresh."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return F.coalesce(age.between(-ahead_minutes * 60_000_000, hours * 3_600_000_000), F.lit(False))


# A date in a path.
URL_DATE = r"/(\d{4})[/-](\d{1,2})[/-](\d{1,2})/"


def date_from_url(url: Column) -> Column:
    y, m, d = (F.regexp_extract(blank(url), URL_DATE, i).try_cast("int") for i in (1, 2, 3))
    return F.try_to_timestamp(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd"))


def _first(dates: Column) -> Column:
    """First element that is not null."""
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def date_from_meta(html: Column, now: Column) -> Column:
    def date_of(tags: Column) -> Column:
        tag = lambda attr, key: F.get(F.filter(tags, lambda t: t.rlike(rf"""(?is)<meta\b[^>]*\b{attr}=["']{key.replace(".", r"[.]")}["'][^>]*>""")), F.lit(0))
        found = F.array(*[F.regexp_extract(tag(*k), r"""(?is)\bcontent=["']([^"']*)["']""", 1) for k in META_KEYS])
        return F.when(F.size(tags) > 0, _first(F.transform(F.filter(found, lambda v: v != ""), lambda v: parse_date(v, now))))

    return once(F.regexp_extract_all(blank(html), F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)), date_of)


def date_from_json_ld(html: Column, now: Column) -> Column:
    """The first date of any item of any script, scripts and items in order, a field's rank deciding within an item."""
    bodies = F.regexp_extract_all(blank(html), F.lit(r"""(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"""), F.lit(1))
    item = "MAP<STRING, STRING>"
    listed = lambda b: F.when(F.ltrim(b).startswith("["), F.from_json(b, f"ARRAY<{item}>")).otherwise(F.array(F.from_json(b, item)))
    items = F.flatten(F.filter(F.transform(bodies, listed), lambda x: x.isNotNull()))
    dates = F.flatten(F.transform(items, lambda m: F.array(*[F.try_element_at(m, F.lit(k)) for k in JSON_LD_KEYS])))
    return _first(F.transform(F.filter(dates, lambda v: v.isNotNull()), lambda v: parse_date(v, now)))


def date_from_time_tag(html: Column, now: Column) -> Column:
    """The first time element with a date in its attribute or, without one, in its text."""
    tags = F.regexp_extract_all(blank(html), F.lit(r"(?is)<time\b[^>]*>.*?</time>"), F.lit(0))

    def date_of(tag: Column) -> Column:
        attr = F.regexp_extract(tag, r"""(?is)^<time\b[^>]*?\bdatetime=["']([^"']*)["']""", 1)
        return parse_date(F.when(attr != "", attr).otherwise(F.regexp_extract(tag, r"(?is)^<time\b[^>]*>(.*?)</time>$", 1)), now)

    return _first(F.transform(tags, date_of))


def date_from_html(html: Column, url: Column, now: Column) -> Column:
    """URL, meta tags, JSON-LD, time element, in order, over the first 25,000 characters; null for an empty page."""
    head = F.substring(html, 1, 25_000)
    tiers = F.coalesce(date_from_url(url), date_from_meta(head, now), date_from_json_ld(head, now), date_from_time_tag(head, now))
    return F.when(blank(html) != "", tiers)


# Offsets and words that tell when a text was written, and phrases that call it new.
RECENT_OFFSET = r"\b(\d+\s*(?:hours?|minutes?|secs?|seconds?)\s*ago)\b"
RECENT_WORD = r"\b(just\s+now|yesterday|today)\b"
RECENT_PHRASES = ["breaking news", "just announced", "today announced"]
#: a part of each of these; a text without any tells no time
RECENT_PARTS = "ago|now|day|breaking news|announced"


def infer_recency(text: Column, now: Column) -> Column:
    """A time told by the first 2,000 characters of a text; null where they tell none."""

    def told(k: Column) -> Column:
        lead, now = k["lead"], k["now"]
        told_by = lambda pattern: once(F.regexp_extract(lead, pattern, 1), lambda x: F.when(x != "", relative_time(x, now)))
        return F.coalesce(told_by(RECENT_OFFSET), told_by(RECENT_WORD), F.when(reduce(or_, [lead.contains(p) for p in RECENT_PHRASES]), now))

    return once(F.struct(F.lower(F.substring(blank(text), 1, 2000)).alias("lead"), now.alias("now")), told)


def fresh_only(ts: Column, now: Column, hours: int = 24) -> Column:
    """The time where it is fresh, else null."""
    return F.when(is_fresh(ts, now, hours), ts)


def _dated(date: Column, inferred: Column) -> Column:
    return F.struct(date.alias("date"), (date.isNotNull() & inferred).alias("inferred"))


def job_date(posted: Column, title: Column, novel: Column, now: Column, hours: int = 24) -> Column:
    """(date, inferred) of a posting; a null date rejects it.

    A stated date must be fresh, whatever else is known. Without one, the title may tell a
    fresh time; else a posting not seen in an earlier run counts as new.
    """
    stated = F.trim(blank(posted)) != ""
    told = F.when(stated, parse_date(posted, now)).otherwise(infer_recency(title, now))
    known = F.struct(told.alias("told"), stated.alias("stated"), novel.alias("novel"), now.alias("now"))

    def choose(k: Column) -> Column:
        seen_first = ~k["stated"] & F.coalesce(k["novel"], F.lit(False))
        return _dated(F.coalesce(fresh_only(k["told"], k["now"], hours), F.when(seen_first, k["now"])), ~k["stated"])

    # most postings state a number, or nothing and their title no time: for these plain expressions do, which are compiled
    v = F.trim(blank(posted))
    quiet = ~F.lower(blank(title)).rlike(RECENT_PARTS)
    number = _dated(fresh_only(_epoch(v), now, hours), F.lit(False))
    silent = _dated(F.when(F.coalesce(novel, F.lit(False)), now), F.lit(True))
    return F.when(v.rlike(NUMBER), number).when((v == "") & quiet, silent).otherwise(once(known, choose))


def news_date(posted: Column, html: Column, url: Column, text: Column, novel: Column, now: Column, hours: int = 24) -> Column:
    """(date, inferred) of an article; a null date rejects it.

    Tiers: the feed's date, the page's, one told by the text, each if fresh. A key not seen
    before counts as new only if neither feed nor page state a date. A feed date that can
    be read and is stale rejects at once.
    """
    known = F.struct(parse_date(posted, now).alias("feed"), date_from_html(html, url, now).alias("page"), infer_recency(text, now).alias("told"))

    def choose(k: Column) -> Column:
        feed, page, told = k["feed"], k["page"], k["told"]
        sure = fresh_only(feed, now, hours)
        stated = (F.trim(blank(posted)) != "") | page.isNotNull()
        guess = F.coalesce(fresh_only(page, now, hours), fresh_only(told, now, hours), F.when(~stated & F.coalesce(novel, F.lit(False)), now))
        return _dated(F.when(feed.isNotNull() & sure.isNull(), F.lit(None).cast("timestamp")).otherwise(F.coalesce(sure, guess)), sure.isNull())

    return once(known, choose)


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait: a number or the distance to a date; null if neither."""
    wait = (F.unix_timestamp(parse_date(value, now)) - F.unix_timestamp(now)).cast("double")
    return F.coalesce(value.try_cast("double"), F.when(wait < 0, F.lit(0.0)).otherwise(wait))
