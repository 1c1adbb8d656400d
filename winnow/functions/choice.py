"""Choices among candidate values: news texts, tiers of extraction, admission rules, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import REMOTE, holds_any, pricing, role
from .temporal import is_fresh, once, parse_date
from .text import blank, html_text, lead_summary, stripped

#: shortest body or summary that counts, preview of a full text, longest summary
LEAST, PREVIEW, LONGEST = 20, 300, 500


def full_text(html: Column, title: Column, forum: Column) -> Column:
    """(text, is_full): the page's text if long enough; else the title for a forum post and nothing for others."""
    body = html_text(html)
    other = F.when(F.coalesce(forum, F.lit(False)), blank(title)).otherwise("")
    return F.when(F.length(body) >= LEAST, F.struct(body.alias("text"), F.lit(True).alias("is_full"))).otherwise(F.struct(other.alias("text"), F.lit(False).alias("is_full")))


def summary(enriched: Column, snippet: Column, text: Column, title: Column, forum: Column) -> Column:
    """(summary, is_enriched): the enriched one where there is a text and it is long enough, else the feed's snippet (not for a forum), else the text's head, else the title."""
    head = F.when(blank(text) != "", F.substring(text, 1, PREVIEW)).otherwise(blank(title))
    clean = F.when(F.coalesce(forum, F.lit(False)), "").otherwise(html_text(snippet))
    own = F.when(clean != "", clean).otherwise(head)
    good = (blank(text) != "") & (F.length(stripped(enriched)) >= LEAST)
    return F.struct(F.substring(F.when(good, stripped(enriched)).otherwise(own), 1, LONGEST).alias("summary"), good.alias("is_enriched"))


def news_text(text: Column, short: Column, title: Column) -> Column:
    return F.coalesce(F.nullif(blank(text), F.lit("")), F.nullif(blank(short), F.lit("")), title)


def first_tier(tiers: list[tuple[str, Column, Column]], last: tuple[str, Column]) -> Column:
    """(value, tier) of the first (name, value, valid) tier that is valid, else of the last one; a null verdict is invalid."""
    out = F.struct(last[1].alias("value"), F.lit(last[0]).alias("tier"))
    for name, value, ok in reversed(tiers):
        out = F.when(F.coalesce(ok, F.lit(False)), F.struct(value.alias("value"), F.lit(name).alias("tier"))).otherwise(out)
    return out


def answer_valid(usefulness: Column, quality: Column, differentiation: Column, notes: Column) -> Column:
    """Whether an evaluation lies in its bounds (30, 25, 5), is not zero in both main scores and has notes."""
    inside = usefulness.between(0, 30) & quality.between(0, 25) & differentiation.between(0, 5)
    return F.coalesce(inside & ~((usefulness == 0) & (quality == 0)) & (stripped(notes) != ""), F.lit(False))


def deterministic(text: Column) -> dict[str, Column]:
    """What rules alone extract from a text: title, summary, remote flag, role and pricing."""
    lines = F.filter(F.transform(F.split(blank(text), r"\R"), stripped), lambda s: s != "")
    first = F.coalesce(F.get(lines, F.lit(0)), F.lit("Untitled"))
    lead = lead_summary(text)
    none = F.lit("")
    return {
        "title": F.substring(first, 1, 200),
        "summary": F.when(lead != "", lead).otherwise(F.substring(F.coalesce(F.get(lines, F.lit(1)), first), 1, LONGEST)),
        "is_remote": holds_any(F.lower(blank(text)), REMOTE),
        "role_family": role(text),
        "pricing": pricing(none, none, blank(text)),
    }


def admission(shard: Column, name: Column, repo: Column, status: Column) -> Column:
    """Status of a candidate after its probe.

    A verified probe is verified. In the registry shard any named row that was not
    rejected is verified; in the directory shard a row with a repository is rejected and
    one without stays pending; elsewhere the probe's own status holds.
    """
    has = blank(repo) != ""
    s = F.coalesce(status, F.lit("PENDING"))
    registry = F.when((s == "REJECTED") & has, s).when(stripped(name) != "", "VERIFIED").otherwise("PENDING")
    directory = F.when(has, "REJECTED").otherwise("PENDING")
    return F.when(has & (s == "VERIFIED"), "VERIFIED").when(shard == "registry", registry).when(shard == "directory", directory).otherwise(s)


def eta_minutes(collected: Column, target: Column, elapsed_minutes: Column) -> Column:
    """Minutes until the target at the rate so far; null without a rate."""
    rate = F.when((collected > 0) & (elapsed_minutes > 0), collected / elapsed_minutes)
    return F.round(F.greatest(target - collected, F.lit(0)) / rate)


def ladder(attempts: DataFrame, rounds: int = 4) -> DataFrame:
    """The attempt that serves each request: ``attempts(request, round, key, model, valid)``.

    Rounds from 0, in each the keys outside and the models inside; the first valid answer
    serves. A request without one in ``rounds`` rounds is UNSCORED.
    """
    place = F.struct("round", "key", "model")
    ok = F.coalesce("valid", F.lit(False)) & (F.col("round") < rounds)
    best = attempts.groupBy("request").agg(F.min(F.when(ok, place)).alias("at"), F.count_if(F.col("round") < rounds).alias("tried"))
    return best.select("request", "at.round", "at.key", "at.model", F.when(F.col("at").isNull(), "UNSCORED").otherwise("SCORED").alias("outcome"), "tried")


def source_list(setting: Column, default: Column) -> Column:
    """(name, url) sources of a JSON setting; the default where it is blank, broken or empty, or a source lacks name or url."""
    got = F.from_json(setting, "ARRAY<STRUCT<name: STRING, url: STRING>>")
    ok = F.forall(got, lambda x: (blank(x["name"]) != "") & (blank(x["url"]) != "")) & (F.size(got) > 0)
    return F.when(F.coalesce(ok, F.lit(False)), got).otherwise(default)


def early_reject(title: Column, link: Column, posted: Column, now: Column, forum: str = "news.ycombinator.com") -> Column:
    """Why an entry is dropped before its page is read: no title or link, a link inside the forum, a stated date that is stale; else null."""
    stale = once(F.struct(parse_date(posted, now).alias("date"), now.alias("now")), lambda k: k["date"].isNotNull() & ~is_fresh(k["date"], k["now"]))
    return (
        F.when((stripped(title) == "") | (stripped(link) == ""), "blank")
        .when(blank(link).contains(forum), "forum")
        .when(stale, "stale")
    )
