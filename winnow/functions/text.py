"""Column functions over names, titles and free text. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fold import fold

# Tokens that a company name loses.
CORPORATE_SUFFIXES = ["inc", "corp", "corporation", "llc", "ltd", "limited", "incorporated", "plc", "gmbh", "sas", "bv", "pbc", "co", "company"]
TECH_NOISE = ["ai", "technologies", "technology", "tech", "labs", "laboratory", "laboratories", "systems", "solutions"]

# Publishers that a title may end with, and media tags.
PUBLISHERS = "TechCrunch|The Verge|VentureBeat|MIT Technology Review|Hacker News|Ars Technica|Wired|Gizmodo"
MEDIA_TAGS = r"\[video\]|\[pdf\]|\[audio\]"

# Inline credentials, and keys whose values are masked.
CREDENTIAL = r"(?i)(bearer\s+[a-zA-Z0-9_\-\.]{15,}|(api_?key|token|secret)\s*[:=]\s*['\"]?[a-zA-Z0-9_\-\.]{8,}['\"]?)"
SENSITIVE_KEY = r"(?i)(password|token|secret|api_?key|authorization|jwt|creditcard|ssn)"


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def stripped(c: Column) -> Column:
    """White space of every kind off both ends; null is empty."""
    return F.regexp_replace(blank(c), r"^\s+|\s+$", "")


def unaccent(c: Column) -> Column:
    """Lower case, decomposed for comparison (NFKD), without combining marks."""
    return fold(F.lower(c))


def tokens(c: Column) -> Column:
    """White-space tokens of the text with everything but letters, digits and ``_`` read as a space."""
    return F.filter(F.split(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "), r"\s+"), lambda t: t != "")


def name_key(name: Column) -> Column:
    """Comparison key of a company name: no case, accents, punctuation, legal suffixes or noise words."""
    drop = [*CORPORATE_SUFFIXES, *TECH_NOISE]
    return F.array_join(F.filter(tokens(unaccent(F.trim(blank(name)))), lambda t: ~t.isin(drop)), " ")


def title_key(title: Column) -> Column:
    """Comparison key of a headline: no publisher at the end, media tags, accents or punctuation."""
    t = F.regexp_replace(blank(title), rf"(?i)\s*(?:[-|–—]|\()\s*({PUBLISHERS})\s*\)?\s*$", "")
    t = F.regexp_replace(t, f"(?i){MEDIA_TAGS}", "")
    return F.array_join(tokens(unaccent(F.trim(t))), " ")


def first_line(text: Column) -> Column:
    return F.substring_index(blank(text), "\n", 1)


def word_budget(text: Column, words: int) -> Column:
    """At most the first ``words`` white-space words. A stand-in for a token budget."""
    return F.array_join(F.slice(F.split(F.trim(blank(text)), r"\s+"), 1, words), " ")


def lead_summary(text: Column, sentences: int = 3, chars: int = 500) -> Column:
    """The first sentences of more than 15 characters, cut to ``chars``."""
    parts = F.transform(F.split(blank(text), r"(?<=[.!?])\s+"), stripped)
    return F.substring(F.array_join(F.slice(F.filter(parts, lambda s: F.length(s) > 15), 1, sentences), " "), 1, chars)


def redact(text: Column) -> Column:
    return F.regexp_replace(text, CREDENTIAL, "[REDACTED_CREDENTIAL]")


def redact_map(m: Column) -> Column:
    """Values under sensitive keys masked."""
    return F.transform_values(m, lambda k, v: F.when(k.rlike(SENSITIVE_KEY), F.lit("[REDACTED]")).otherwise(v))


def unfenced(text: Column) -> Column:
    """JSON without the code fence around it."""
    t = F.trim(blank(text))
    inner = F.regexp_replace(F.regexp_replace(t, r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")
    return F.trim(F.when(t.startswith("```"), inner).otherwise(t))


def repo_path(text: Column) -> Column:
    """First ``owner/repo`` of a repository link in a text; null without one."""
    found = F.regexp_extract(blank(text), r"https?://github\.com/([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+)", 1)
    found = F.regexp_replace(F.regexp_replace(found, r"[.,;:)'\"]+$", ""), r"\.git$", "")
    return F.nullif(found, F.lit(""))


def html_text(html: Column) -> Column:
    """Text of a page: script-like elements and tags go, white space collapses."""
    gone = r"(?is)<(script|style|nav|footer|header|noscript|svg|form)\b[^>]*>.*?</\1\s*>"
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(blank(html), gone, " "), r"(?s)<[^>]+>", " "), r"\s+", " "))


#: words of a block that speaks for itself, and the share of linked letters of a menu
BLOCK_WORDS, LINK_SHARE = 10, 1 / 3
BLOCK_TAGS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|figcaption|footer|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
HIDDEN_TAGS = ["script", "style", "noscript", "svg", "form", "template", "title"]
MARGIN_TAGS = ["nav", "footer", "header", "aside"]


def text_blocks(html: Column) -> Column:
    """Table of a page's text blocks in order: (text, words, share of its letters that are linked, heading)."""
    gone = rf"(?is)<({'|'.join(HIDDEN_TAGS + MARGIN_TAGS)})\b[^>]*>.*?</\1\s*>|<!--.*?-->"
    t = F.regexp_replace(F.translate(blank(html), "\u0001\u0002\u0003\u0004", ""), gone, "\u0001")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<a\b[^>]*>", "\u0002"), r"(?i)</a\s*>", "\u0003")
    t = F.regexp_replace(F.regexp_replace(t, r"(?i)<h[1-6]\b[^>]*>", "\u0001\u0004"), rf"(?i)</?({BLOCK_TAGS})\b[^>]*>", "\u0001")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", "")

    def shaped(b: Column) -> Column:
        text = F.trim(F.regexp_replace(F.translate(b, "\u0002\u0003\u0004", ""), r"\s+", " "))
        linked = F.array_join(F.regexp_extract_all(b, F.lit("\u0002([^\u0003]*)\u0003"), F.lit(1)), "")
        linked = F.length(F.regexp_replace(linked, r"\s+", ""))
        letters = F.length(F.replace(text, F.lit(" "), F.lit("")))
        words = F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))
        return F.struct(text.alias("text"), words.alias("words"), (linked / F.greatest(letters, F.lit(1))).alias("share"), F.contains(b, F.lit("\u0004")).alias("heading"))

    return F.filter(F.transform(F.split(t, "\u0001"), shaped), lambda b: b.words > 0)


def main_text(html: Column) -> Column:
    """The main text of a page, a block a line: from its first to its last block of prose, a heading right before it included, without menus.

    Prose has at least BLOCK_WORDS words of which at most LINK_SHARE of the letters are linked; a block with
    more links is a menu wherever it stands. Margins (nav, footer, header, aside) never count. A
    page without prose gives the text of :func:`html_text`; null is empty.
    """

    def chosen(bs: Column) -> Column:
        good = F.transform(bs, lambda b: (b.words >= BLOCK_WORDS) & (b.share <= LINK_SHARE))
        first, last = F.array_position(good, True), F.size(bs) + 1 - F.array_position(F.reverse(good), True)
        titled = F.coalesce(F.get(bs, F.greatest(first - 2, F.lit(0)).cast("int"))["heading"], F.lit(False)) & (first > 1)
        start = F.when(titled, first - 1).otherwise(first)
        kept = F.filter(F.slice(bs, F.greatest(start, F.lit(1)).cast("int"), F.greatest(last - start + 1, F.lit(0)).cast("int")), lambda b: b.share <= LINK_SHARE)
        return F.when(first > 0, F.array_join(F.transform(kept, lambda b: b.text), "\n"))

    found = F.get(F.transform(F.array(text_blocks(html)), chosen), F.lit(0))
    return F.coalesce(found, html_text(html))


def authors(text: Column) -> Column:
    """Names of an author line: tags go, ``,`` and ``;`` separate."""
    parts = F.split(F.regexp_replace(blank(text), "<[^>]+>", " "), "[,;]")
    return F.filter(F.transform(parts, lambda a: F.trim(F.regexp_replace(a, r"\s+", " "))), lambda a: a != "")


def setting_list(text: Column) -> Column:
    """Items of a comma-separated setting, in order, blanks and repeats dropped."""
    return F.array_distinct(F.filter(F.transform(F.split(blank(text), ","), lambda x: F.trim(x)), lambda x: x != ""))


def hash_pick(key: Column, n: int) -> Column:
    """Stable choice among ``n`` by CRC-32."""
    return F.crc32(key.cast("binary")) % n


def duration(seconds: Column) -> Column:
    return F.when(seconds >= 60, F.format_string("~%d min", F.round(seconds / 60).cast("int"))).otherwise(F.format_string("%.1fs", seconds))
