"""Names to canonical entities: domain, alias, normalized and fuzzy tiers, with an audit log."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import token_sorted
from ..functions.text import blank, name_key
from ..functions.urls import official_domain
from ..store import stored
from .automaton import contained
from .dedup import numbered
from .name_index import EQUAL, alike, nearest_names


def fuzzy_candidates(names: DataFrame, registry: DataFrame, k: int = 3, least: float = 0.0) -> DataFrame:
    """(raw, canonical, score, rank): the ``k`` registry names nearest to each distinct raw name, ties by name, of scores from ``least``."""
    return nearest_names(names, registry, k, least)


def _matched(names: DataFrame, registry: DataFrame, aliases: DataFrame, domains: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(names with what each tier finds: _dom, _alias, _norm, _fuzzy with score; the fuzzy finds alone)."""
    keyed = names.withColumn("_a", F.lower(F.trim("raw"))).withColumn("_k", name_key(F.col("raw")))
    # a registry that is met again and again brings its keys along
    by_key = (registry if "_k" in registry.columns else registry.withColumn("_k", name_key(F.col("canonical")))).select("_k", "canonical").where("_k <> ''").groupBy("_k").agg(F.min("canonical").alias("_norm"))
    # an alias or a domain of several entities is the first's by name, so a name stays one row
    al = aliases.groupBy(F.lower(F.trim("alias")).alias("_a")).agg(F.min("canonical").alias("_alias"))
    dom = domains.groupBy(F.col("domain").alias("_d")).agg(F.min("canonical").alias("_dom"))
    # no hints: the planner broadcasts a dimension only where its size allows
    d = keyed.join(dom, F.col("domain") == F.col("_d"), "left").join(al, "_a", "left").join(by_key, "_k", "left")
    open_names = d.where("_dom is null and _alias is null and _norm is null").select("raw").where(blank(F.trim("raw")) != "")
    best = fuzzy_candidates(open_names, registry, 1, least).select(F.col("raw").alias("_raw"), F.col("canonical").alias("_fuzzy"), "score")
    return d.join(best, F.col("raw") == F.col("_raw"), "left"), best


def resolve(names: DataFrame, registry: DataFrame, aliases: DataFrame, domains: DataFrame, accept: float = 90.0, tie_break: Column | None = None, budget: int = 100) -> DataFrame:
    """``names(raw, domain)`` with canonical, method and confidence.

    Tiers in order: domain, alias, normalized name, fuzzy score of at least
    ``accept``, the injected ``tie_break`` for scores from 70, else a new entity. The
    ``budget`` first such names (by name) are given to it at most. A blank name is
    ``Unknown`` by manual override. A key that is empty never matches.
    """
    d, best = _matched(names, registry, aliases, domains, 70.0)  # no tier looks at a score under 70
    band = F.lit(None).cast("string")
    if tie_break is not None:
        asked = best.where((F.col("score") >= 70) & (F.col("score") < accept)).orderBy("_raw").limit(budget).select(F.col("_raw").alias("_asked"))
        d = d.join(F.broadcast(asked), F.col("raw") == F.col("_asked"), "left")  # at most ``budget`` names
        band = F.when(F.col("_asked").isNotNull(), tie_break)
    tiers = [
        (blank(F.trim("raw")) == "", F.lit("Unknown"), "MANUAL_OVERRIDE", F.lit(0.0)),
        (F.col("_dom").isNotNull(), F.col("_dom"), "NORMALIZATION_EXACT", F.lit(1.0)),
        (F.col("_alias").isNotNull(), F.col("_alias"), "ALIAS_MATCH", F.lit(1.0)),
        (F.col("_norm").isNotNull(), F.col("_norm"), "NORMALIZATION_EXACT", F.lit(1.0)),
        (F.col("score") >= accept, F.col("_fuzzy"), "FUZZY_TOKEN_SORT", F.round(F.col("score") / 100, 2)),
        (band.isNotNull(), band, "LLM_DISAMBIGUATION", F.lit(0.85)),
    ]
    out = None
    for test, name, method, conf in tiers:
        s = F.struct(name.alias("canonical"), F.lit(method).alias("method"), conf.alias("confidence"))
        out = F.when(test, s) if out is None else out.when(test, s)
    new = F.struct(F.trim("raw").alias("canonical"), F.lit("NEW_ENTITY").alias("method"), F.lit(0.5).alias("confidence"))
    return d.withColumn("_r", out.otherwise(new)).select(*names.columns, "_r.*")


def learn(resolved: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry with new entities added: of names with one key the first by name; names without a key are left out."""
    new = resolved.where("method = 'NEW_ENTITY'").select("canonical").distinct().withColumn("k", name_key(F.col("canonical"))).where("k <> ''")
    return registry.select("canonical").unionByName(new.groupBy("k").agg(F.min("canonical").alias("canonical")).select("canonical")).distinct()


#: names of the first and of the largest block of learning in order, which one task settles
FIRST_NAMES, MOST_NAMES = 8_192, 131_072
SETTLED = "raw string, domain string, canonical string, method string, confidence double, fresh boolean, grounds boolean"


def _settled(accept: float):
    """Streams one block in order of arrival, with what earlier blocks know of each name, through the tiers."""

    def work(batches):
        keys: dict[str, str] = {}
        domains: dict[str, str] = {}
        new: dict[int, str] = {}
        same: dict[str, str] = {}  # the first by name of the new entities with one text
        for pdf in batches:
            out = []
            for n, raw, domain, key, dom, alias, norm, fuzzy, score, text, near, official in zip(*(pdf[c] for c in ("_n", "raw", "domain", "_k", "_dom", "_alias", "_norm", "_fuzzy", "score", "_s", "near", "official")), strict=True):
                name = (raw or "").strip(" ")
                # the nearest of the registry and of the block's own new entities, ties by name
                found = [(-score, fuzzy)] if fuzzy is not None else []
                found += [(-p["score"], new[p["a"]]) for p in (near if near is not None else []) if p["a"] in new]
                found += [(-EQUAL, same[text])] if accept == EQUAL and text in same else []
                fresh = False
                if not name:
                    got = ("Unknown", "MANUAL_OVERRIDE", 0.0)
                elif dom is not None or domain in domains:
                    got = (dom if dom is not None else domains[domain], "NORMALIZATION_EXACT", 1.0)
                elif alias is not None:
                    got = (alias, "ALIAS_MATCH", 1.0)
                elif norm is not None or key in keys:
                    got = (norm if norm is not None else keys[key], "NORMALIZATION_EXACT", 1.0)
                elif found and -min(found)[0] >= accept:
                    got = (min(found)[1], "FUZZY_TOKEN_SORT", round(-min(found)[0] / 100, 2))
                else:
                    got, fresh = (name, "NEW_ENTITY", 0.5), True
                    new[n] = name
                    same[text] = min(name, same.get(text, name))
                    if key:
                        keys[key] = name
                grounds = bool(official) and dom is None and domain not in domains
                if grounds:
                    domains[domain] = got[0]
                out.append((raw, domain, *got, fresh, grounds))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SETTLED.split(", ")])

    return work


def learn_in_order(
    names: DataFrame, registry: DataFrame, aliases: DataFrame, domains: DataFrame, accept: float = 90.0, block: int = FIRST_NAMES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(resolved, registry, domains) when ``names(raw, domain, seq)`` arrive one after the other and each may rest on what those before it taught.

    A new entity joins the registry with its key at once, and an official domain is grounded by the
    first name that brings it; tiers are those of :func:`resolve` without a tie-break. Each distinct
    (raw, domain) counts at its first seq, ties by raw and domain. Names go in blocks of doubling
    size up to MOST_NAMES: a block is matched with all that earlier ones taught, names in it with each
    other only where one of them may be new, and then one task takes the block in order. Where only
    equal texts are accepted, that task finds those of its block by itself. resolved has
    (raw, domain, canonical, method, confidence) of each distinct pair.
    """
    first = names.groupBy("raw", "domain").agg(F.min("seq").alias("seq"))
    rows = stored(numbered(first, "_n", "seq", "raw", "domain"))
    total, low, parts = rows.count(), 0, []
    keyed = lambda d: d.select("canonical").distinct().withColumn("_k", name_key(F.col("canonical")))
    entities, grounded = stored(keyed(registry)), stored(domains.groupBy("domain").agg(F.min("canonical").alias("canonical")))
    while low < total:
        now = rows.where((F.col("_n") >= low) & (F.col("_n") < low + block))
        d = _matched(now, entities, aliases, grounded, accept)[0].withColumn("official", official_domain(F.col("domain"), F.col("_k")))
        d = stored(d.withColumn("_s", token_sorted(F.trim("raw"))))
        undecided = d.where("_dom is null and _alias is null and _norm is null").where(blank(F.trim("raw")) != "")
        if accept >= EQUAL:
            d = d.withColumn("near", F.lit(None).cast("array<struct<a: long, score: double>>"))
        else:
            texts = undecided.select(F.col("_n").alias("id"), F.col("_s").alias("s"), "_fuzzy")
            near = alike(texts.where("_fuzzy is null").select("id", "s"), texts.select("id", "s"), (block, block), accept, rising=True)
            near = stored(near.groupBy("b").agg(F.collect_list(F.struct("a", "score")).alias("near")))
            d = d.join(near, F.col("_n") == F.col("b"), "left")
        d = d.select("_n", "raw", "domain", "_k", "_dom", "_alias", "_norm", "_fuzzy", "score", "_s", "near", "official")
        done = stored(d.repartition(1).sortWithinPartitions("_n").mapInPandas(_settled(accept), SETTLED))
        parts.append(done)
        entities = stored(entities.unionByName(keyed(done.where("fresh"))).distinct())
        grounded = stored(grounded.unionByName(done.where("grounds").select("domain", "canonical")))
        low, block = low + block, min(2 * block, max(block, MOST_NAMES))
    out = reduce(DataFrame.unionByName, parts) if parts else names.sparkSession.createDataFrame([], SETTLED)
    return out.drop("fresh", "grounds"), entities.select("canonical"), grounded


def learn_domains(resolved: DataFrame, domains: DataFrame) -> DataFrame:
    """Grounded domains: those of ``resolved(raw, domain, canonical)`` that may be an entity's own, over the known ones; ties by name."""
    new = resolved.where(official_domain(F.col("domain"), name_key(F.col("raw")))).groupBy("domain").agg(F.min("canonical").alias("canonical"))
    return domains.select("domain", "canonical").join(new.select("domain"), "domain", "left_anti").unionByName(new)


def mentions(titles: DataFrame, names: DataFrame) -> DataFrame:
    """(id, name) of each title that contains a name of at least 3 characters, case ignored."""
    return contained(titles, names, 3)
