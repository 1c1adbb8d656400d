"""Input to expected facts for functions, readers, writers and state machines."""

import collections
import datetime as dt
import json
import random
import re
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from winnow.functions import classify as C
from winnow.functions import temporal as T
from winnow.functions import text as X
from winnow.functions import urls as U
from winnow.functions.fold import decomposed, fold
from winnow.functions.fuzzy import indel_ratio, lcs_lengths, token_sorted
from winnow.operators import automaton as AC
from winnow.operators import dedup as D
from winnow.operators import history as H
from winnow.operators import name_index as NI
from winnow.operators import resolve as RS
from winnow.operators import scoring as S
from winnow.sources import commits
from winnow.sources import readers as R
from winnow.sources import sinks as K
from winnow.streaming import stateful as ST


T_STRING = StringType()


def values(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(expr).collect()]


def one(spark, expr, texts):
    return values(spark, expr(F.col("t")), [(t,) for t in texts], "t string")


def test_names_and_titles(spark):
    assert one(spark, X.name_key, ["Mistral AI SAS", " OpenAI, Inc. ", "Café Labs", "AI Labs", None]) == ["mistral", "openai", "cafe", "", ""]
    assert one(spark, X.title_key, ["Big News! [Video] | TechCrunch", "Éclair – Wired", ""]) == ["big news", "eclair", ""]


def test_urls(spark):
    got = one(spark, U.normalize_url, ["HTTPS://Example.com:443/path/?utm_source=x&ref=y#frag", "http://example.com:80/", "https://example.com", "https://example.com/a?q=1&utm_campaign=z", None])
    assert got == ["https://example.com/path", "http://example.com/", "https://example.com/", "https://example.com/a?q=1", ""]
    assert one(spark, U.ip_blocked, ["10.1.2.3", "127.0.0.1", "169.254.1.1", "240.0.0.1", "64:ff9b::a00:1", "93.184.216.34", "example.com", ""]) == [True] * 5 + [False] * 3
    assert one(spark, U.safe_url, ["", None, "ftp://a.b/", "http://", "http://localhost/x", "http://10.0.0.1/admin", "http://[::1]/", "https://a.org/x"]) == [False] * 7 + [True]
    assert one(spark, U.registrable_domain, ["https://api.openai.com/v1", "http://x", None]) == ["openai.com", "x", ""]
    assert one(spark, U.repo_owner, ["https://github.com/openai/tool", "https://github.com/topics/agents", "https://other.org/a/b", "https://github.com/org"]) == ["openai", None, None, "org"]
    keys = values(spark, U.canonical_key(F.col("r"), F.col("u"), F.col("n")), [("Org/Repo", None, "x"), (None, "https://myapp.ai/", "x"), (None, None, "Custom Tool!")], "r string, u string, n string")
    assert keys == ["gh:org/repo", "url:myapp.ai", "name:customtool"]


def test_classifiers(spark):
    price = lambda t: C.pricing(F.lit(""), F.lit(""), t)
    assert one(spark, price, ["Custom pricing for enterprise teams", "Plans start at $20/mo subscription", "Open source tool licensed under MIT", "Free tier available with upgrades"]) == ["ENTERPRISE", "PAID", "FREE", "FREEMIUM"]
    roles = ["AI Research Scientist", "Senior Python Backend Engineer", "AI Product Manager", "UI/UX Designer", "Enterprise Account Executive", "Growth Marketing Lead", "Head of Operations", "General Specialist"]
    assert one(spark, C.role, roles) == ["Research", "Engineering", "Product", "Design", "Sales", "Marketing", "Operations", "Other"]
    remote = C.is_remote(F.col("l"), F.lit(None).cast("array<string>"), F.col("t"))
    rows = [("United States (Remote)", "x"), ("", "x"), ("   ", "x"), ("London, UK", "x"), ("Germany", "Engineer Remote")]
    assert values(spark, remote, rows, "l string, t string") == [True, True, True, False, True]
    assert one(spark, C.on_topic, ["Machine Learning Engineer", "Senior Data Scientist", "LLM Alignment Specialist", "Claims Validation Handler", "Vehicle Detailer", "Campaigns & Content Specialist"]) == [True] * 3 + [False] * 3
    split = values(spark, C.company_title(F.col("t"), F.col("a"), True), [("Acme: Staff AI Engineer", None), ("Acme is hiring a dev", None), ("Dev", None)], "t string, a string")
    assert [tuple(r) for r in split] == [("Acme", "Staff AI Engineer"), ("Acme", "Acme is hiring a dev"), ("AI Startup", "Dev")]
    lines = [tuple(r) for r in one(spark, C.first_line_parts, ["Acme | Senior AI Engineer | San Francisco", "| Title | NYC", "plain"])]
    assert lines == [("Acme", "Senior AI Engineer", "San Francisco"), ("", "Title", "NYC"), (None, "plain", "")]
    makers = values(spark, C.maker(F.lit("Tool"), F.col("t"), F.lit("https://x.org")), [("A great tool by OpenAI is widely used.",), ("Built from Anthropic",)], "t string")
    assert makers == ["OpenAI", "Anthropic"]
    assert one(spark, C.is_challenge, ["Please solve this CAPTCHA", "x", "", None, "captcha" + "x" * 5000]) == [True, False, False, False, False]


def test_dates(spark):
    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    ago = lambda **k: dt.datetime(2026, 9, 4, 12, tzinfo=dt.UTC) - dt.timedelta(**k)
    rows = [ago(minutes=-5), ago(minutes=-10), ago(minutes=-11), ago(hours=23, minutes=50), ago(hours=24), ago(hours=24, minutes=5), None]
    assert values(spark, T.is_fresh(F.col("t"), now), [(r,) for r in rows], "t timestamp") == [True, True, False, True, True, False, False]
    show = lambda e: F.date_format(e, "yyyy-MM-dd HH:mm")
    got = one(spark, lambda t: show(T.parse_date(t, now)), ["1700000000", "1700000000000", "2024-05-06T07:08:09Z", "Mon, 06 May 2024 07:08:09 GMT", "2024-05-06", "3 hours ago", "0", "", "nonsense"])
    assert got == ["2023-11-14 22:13", "2023-11-14 22:13", "2024-05-06 07:08", "2024-05-06 07:08", "2024-05-06 00:00", "2026-09-04 09:00", None, None, None]
    pages = [("", "https://a/2024/05/06/x"), ("<p>", "https://a/2024-5-6/x"), ('<meta property="article:published_time" content="2024-01-02">', ""), ('<script type="application/ld+json">{"dateCreated": "2024-01-03"}</script>', ""), ('<time datetime="2024-01-04">x</time>', ""), ("<p>x</p>", "")]
    got = values(spark, show(T.date_from_html(F.col("h"), F.col("u"), now)), pages, "h string, u string")
    assert got == [None, "2024-05-06 00:00", "2024-01-02 00:00", "2024-01-03 00:00", "2024-01-04 00:00", None]
    assert one(spark, lambda t: show(T.infer_recency(t, now)), ["posted 2 hours ago", "Breaking news!", "old", "yesterday we"]) == ["2026-09-04 10:00", "2026-09-04 12:00", None, "2026-09-03 12:00"]
    assert one(spark, lambda t: T.retry_after(t, now), ["30", "Fri, 04 Sep 2026 12:01:00 GMT", "x"]) == [30.0, 60.0, None]


def test_text(spark):
    assert one(spark, X.redact, ["key: token = abcdefgh12345 end", "plain"]) == ["key: [REDACTED_CREDENTIAL] end", "plain"]
    assert one(spark, X.unfenced, ['```json\n{"a":1}\n```', "{}"]) == ['{"a":1}', "{}"]
    assert one(spark, X.repo_path, ["see https://github.com/a/b.git.", "none"]) == ["a/b", None]
    assert one(spark, X.authors, ["A B, <i>C</i>; ,D"]) == [["A B", "C", "D"]]
    masked = spark.sql("SELECT map('api_key', 'x', 'name', 'y') AS m").select(X.redact_map(F.col("m"))).first()[0]
    assert masked == {"api_key": "[REDACTED]", "name": "y"}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_token_sort_ratio(spark):
    pairs = [("anthropic inc", "anthropik"), ("b a", "a b"), ("", ""), ("x", ""), ("Mistral AI", "mistral ai"), ("abcde " * 10 + "x", "bcd " * 15), ("ab" * 35, "ba" * 40), ("q" * 61, "q" * 70), ("abc xyz " * 30, "bca zyx " * 33), ("z" * 60 + "y" * 60, "y" * 60 + "zy" * 40), ("d" * 120, "e" * 130)]
    got = values(spark, indel_ratio(token_sorted(F.col("a")), token_sorted(F.col("b"))), pairs, "a string, b string")
    for (a, b), r in zip(pairs, got):
        a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        assert r == pytest.approx(100.0 if not a + b else 200 * lcs(a, b) / len(a + b))


def test_batch_scores_equal_the_native_ones(spark):
    from winnow.functions.fuzzy import indel_scores, lcs_lengths

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcé \U0001f600z") for _ in range(n))
    pairs = [(word(rng.randrange(90)), word(rng.randrange(90))) for _ in range(300)] + [("", ""), ("a" * 63, "a" * 64), ("ab" * 40, "ba" * 40), (None, "a"), ("b", None)]
    d = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    rows = d.select("i", indel_ratio(F.col("a"), F.col("b")).alias("x"), indel_scores("a", "b").alias("y")).orderBy("i").collect()
    assert all(r.x == pytest.approx(r.y) if r.x is not None else r.y is None for r in rows) and rows[-1].y is None
    assert lcs_lengths(["abcbdab", "x"], ["bdcaba", ""]).tolist() == [4, 0]


def test_fuzzy_first_wins_in_blocks(spark):
    rng = random.Random(5)
    base = ["the quick model wins again " + w for w in ("today", "here", "there", "soon", "never")]
    titles = []
    for i in range(120):
        t = list(rng.choice(base) + f" {rng.choice(['alpha', 'beta', 'gamma delta', 'epsilon zeta eta'])}")
        t[rng.randrange(len(t))] = rng.choice("qxz")
        titles.append("".join(t))
    kept = []
    for i, t in enumerate(titles):
        s = " ".join(sorted(t.split()))
        if all(200 * lcs(s, k) / (len(s) + len(k)) < 90 for _, k in kept):
            kept.append((i, s))
    d = spark.createDataFrame(list(enumerate(titles)), "id long, t string")
    for block in (7, 1000):
        assert sorted(r.id for r in D.fuzzy_first_wins(d, "id", "t", 90.0, block).collect()) == [i for i, _ in kept]


def test_greedy_first_wins(spark):
    base = "new model beats every benchmark in the field today"
    titles = [base, base + "s", "other story about chips", base.replace("new", "now"), "chips other about story", base + " again and much longer than before"]
    d = spark.createDataFrame(list(enumerate(titles)), "id long, t string")
    kept = []
    for i, t in enumerate(titles):
        s = " ".join(sorted(t.split()))
        if all(200 * lcs(s, k) / (len(s) + len(k)) < 90 for _, k in kept):
            kept.append((i, s))
    got = D.greedy_kept(d, D.fuzzy_pairs(d, "id", "t", 90.0), "id")
    assert sorted(r.id for r in got.collect()) == [i for i, _ in kept]


def test_fuzzy_first_wins_settles_copies_before_pairs(spark):
    rows = [(3, "b a c d e f g h"), (1, "a b c d e f g h"), (2, "h g f e d c b a"), (4, "a b c d e f g x"), (5, None), (6, " "), (7, None), (8, "quite another one")]
    d = spark.createDataFrame(rows, "id long, t string")
    assert sorted(r.id for r in D.fuzzy_first_wins(d, "id", "t", 90.0).collect()) == [1, 5, 6, 7, 8]
    assert D.fuzzy_first_wins(d.limit(0), "id", "t", 90.0).count() == 0


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_greedy_kept_settles_a_long_chain(spark, small):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(12)], "a long, b long")
    assert sorted(r.id for r in D.greedy_kept(spark.range(13), pairs, "id", small).collect()) == list(range(0, 13, 2))


def test_folding_equals_the_library_for_every_code_point(spark):
    code = F.col("id")
    wide = F.hex(0xD800 + F.floor((code - 0x10000) / 1024)), F.hex(0xDC00 + (code - 0x10000) % 1024)
    ch = F.decode(F.unhex(F.when(code < 0x10000, F.lpad(F.hex(code), 4, "0")).otherwise(F.concat(*wide))), "UTF-16BE")
    points = spark.range(1, sys.maxunicode + 1).where("id not between 55296 and 57343").select("id", ch.alias("c"))
    bad = [r for r in points.select("id", fold(F.col("c")).alias("got")).toLocalIterator() if r.got != decomposed(chr(r.id))]
    assert not bad, bad[:5]
    texts = ["", "plain", "Škoda ﬁnd Ａpp", "한국어 각 x", "e\u0301 \u0378 \U0001d400", "ﷺ½", None]
    assert one(spark, fold, texts) == [t if t is None else decomposed(t) for t in texts]
    assert one(spark, X.name_key, ["Škoda Inc.", "Ő", "ﬁnd Ａpp"]) == ["skoda", "o", "find app"]


def brute_nearest(raws, regs, k, least):
    ratio = lambda a, b: 100.0 if not a + b else 200.0 * lcs_lengths([a], [b])[0] / (len(a) + len(b))
    key = lambda t: " ".join(sorted(t.split()))
    out = []
    for r in set(raws):
        best = sorted((-ratio(key(r), key(c)), c) for c in set(regs))[:k]
        out += [(r, c, -s, i + 1) for i, (s, c) in enumerate(best) if -s >= least]
    return sorted(out)


@pytest.mark.parametrize(("k", "least"), [(3, 0.0), (1, 70.0), (5, 40.0)])
def test_nearest_names_equal_a_full_scan(spark, monkeypatch, k, least):
    rng = random.Random(k)
    word = lambda: "".join(rng.choice("aabcdeéiorstЖ漢") for _ in range(rng.randrange(1, 9)))
    regs = [" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(150)] + ["", "a" * 70, "ab " * 120, "Acme Inc", "Inc Acme"]
    raws = [" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(80)] + [regs[3] + "x", regs[7][1:], "", "b" + "a" * 80, "ab " * 119, "acme inc", "\U0001d400"]
    monkeypatch.setattr(NI, "BLOCK", 60)
    monkeypatch.setattr(NI, "ROWS", 16)
    got = RS.fuzzy_candidates(spark.createDataFrame([(r,) for r in [*raws, None, raws[0]]], "raw string"), spark.createDataFrame([(r,) for r in [*regs, None]], "canonical string"), k, least)
    assert "NestedLoop" not in got._jdf.queryExecution().toString() and "Cartesian" not in got._jdf.queryExecution().toString()
    assert sorted(map(tuple, got.collect())) == brute_nearest(raws, regs, k, least)
    assert RS.fuzzy_candidates(spark.createDataFrame([], "raw string"), spark.createDataFrame([("x",)], "canonical string")).count() == 0


def test_mentions(spark, monkeypatch):
    titles = [(1, "OpenAI and Anthropic ship"), (2, "anthropics"), (3, None), (4, "ai"), (5, ""), (6, "abcabcd bcd"), (7, "ushers"), (8, "ÉTÉ été")]
    names = ["OpenAI", "Anthropic", "ai", None, "Zzz", "abc", "abcd", "bcd", "cabc", "her", "hers", "she", "usher", "HERS", "été"]
    want = sorted({(i, n) for i, t in titles for n in names if t and n and len(n) >= 3 and n.lower() in t.lower()})
    rows, dim = spark.createDataFrame(titles, "id long, title string"), spark.createDataFrame([(n,) for n in [*names, "her"]], "name string")
    for letters in (4_000_000, 9):
        monkeypatch.setattr(AC, "BLOCK_LETTERS", letters)
        got = RS.mentions(rows, dim)
        assert sorted(map(tuple, got.collect())) == want and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_automaton_finds_what_a_scan_finds():
    rng = random.Random(2)
    patterns = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(30)})
    automaton = AC.Automaton(patterns)
    for _ in range(200):
        text = "".join(rng.choice("abc") for _ in range(rng.randrange(20)))
        assert automaton.found(text) == {i for i, p in enumerate(patterns) if p in text}


def test_main_text(spark):
    prose = ["One two three four five six seven eight nine ten eleven.", "Short one.", "Alpha beta gamma delta epsilon zeta eta theta <a href='/x'>with a link</a> iota kappa lambda."]
    menu = "<div><ul>" + "".join(f"<li><a href='/{i}'>Section {i} of this site and its many parts, all of them here</a></li>" for i in range(4)) + "</ul></div>"
    page = f"<html><head><title>T</title><script>var a = '<p>';</script></head><body>{menu}<div>Ad text</div><h1>The title</h1>" + "".join(f"<p>{p}</p>" for p in prose[:2]) + f"{menu}<p>{prose[2]}</p><div>(c) a footer</div><footer>{prose[0]}</footer></body></html>"
    plain = re.sub("<[^>]+>", "", prose[2])
    got = one(spark, X.main_text, [page, None, "", "<p>only a few words</p>", "no tags but quite a lot of words in this text here"])
    assert got == ["\n".join(["The title", prose[0], "Short one.", plain]), "", "", "only a few words", "no tags but quite a lot of words in this text here"]


def test_main_text_of_pages_with_planted_margins(spark, sf_dir):
    """Words of the article found, and found words that are of the article, over pages whose menus and footers stand in plain divisions."""
    menu = "<div class='m'>" + "".join(f"<a href='/{w}'>{w} zzmenu</a> " for w in "home about contact archive imprint topics authors".split()) + "</div>"
    html = F.regexp_replace(F.regexp_replace(F.col("html"), "<nav>", F.lit(menu + "<nav>")), "</article>", "</article><div>zzfoot all rights kept</div>" + menu)
    article = F.regexp_replace(F.regexp_extract("html", "(?s)<article>(.*)</article>", 1), r"<br>|</?(p|h1|b)>", " ")
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").where(F.col("html").contains("<article>")).select(X.main_text(html).alias("got"), article.alias("want")).collect()
    hit = sum((collections.Counter(r.got.split()) & collections.Counter(r.want.split())).total() for r in rows)
    found, there = sum(len(r.got.split()) for r in rows), sum(len(r.want.split()) for r in rows)
    assert hit >= 0.95 * found and hit >= 0.95 * there, (hit / found, hit / there)
    print("main text: precision", hit / found, "recall", hit / there)


def test_written_dates(spark):
    want = dt.datetime(2026, 9, 3)
    day = ["September 3, 2026", "Sep 3, 2026", "Sep 3 2026", "3 Sep 2026", "3rd September 2026", "Thursday, September 3, 2026", "Thu, 3 Sep 2026 00:00:00 GMT", "09/03/2026", "9/3/2026", "2026/09/03", "Sep. 3, 2026", "2026-09-03 00:00", "Sep 3, 2026 at 12:00 AM"]
    now = F.lit("2026-09-03 12:00:00").cast("timestamp")
    parse = lambda c: F.date_format(T.parse_date(c, now), "yyyy-MM-dd HH:mm:ss")
    assert one(spark, parse, day) == [str(want)] * len(day)
    ago = ["2 hours ago", "3 days ago", "an hour ago", "1 week ago", "yesterday", "a minute ago", "some unparseable nonsense text", "   ", "may be 4 things"]
    at = dt.datetime(2026, 9, 3, 12)
    hours = [2, 72, 1, 168, 24, 1 / 60]
    assert one(spark, parse, ago) == [*(str(at - dt.timedelta(hours=h)) for h in hours), None, None, None]


@pytest.mark.parametrize("range_rows", [1_000_000, 150])
def test_pacing_scan_equals_a_loop(spark, range_rows):
    rng = random.Random(range_rows)
    calls = [(0, i, rng.uniform(0, 3000)) for i in range(1500)] + [(rng.randrange(1, 9), i, rng.uniform(0, 90)) for i in range(300)] + [(None, i, 5.0) for i in range(5)]
    calls = list({(k, i): (k, i, t) for k, i, t in calls}.values())
    last, want = {}, []
    for k, i, t in sorted(calls, key=lambda c: (c[0] is None, c[0] or 0, c[1])):
        last[k] = max(t, last[k] + 2.5) if k in last else t
        want.append((k, i, round(last[k], 6)))
    rng.shuffle(calls)
    got = H.pacing_slots(spark.createDataFrame(calls, "token long, seq long, ts double"), 2.5, range_rows)
    assert sorted(((r.token, r.seq, round(r.slot, 6)) for r in got.collect()), key=str) == sorted(want, key=str)
    assert H.pacing_slots(spark.createDataFrame([], "token long, seq long, ts double"), 2.5).count() == 0


def test_a_raw_name_stays_one_row(spark):
    reg = spark.createDataFrame([("Acme One",), ("Acme Two",)], "canonical string")
    al = spark.createDataFrame([("acme", "Acme Two"), ("ACME", "Acme One")], "alias string, canonical string")
    dom = spark.createDataFrame([("a.com", "Acme Two"), ("a.com", "Acme One")], "domain string, canonical string")
    names = spark.createDataFrame([("Acme", None), ("Other", "a.com")], "raw string, domain string")
    assert sorted((r.raw, r.canonical) for r in RS.resolve(names, reg, al, dom).collect()) == [("Acme", "Acme One"), ("Other", "Acme One")]


def test_resolver(spark):
    reg = spark.createDataFrame([("Mistral AI",), ("Anthropic",)], "canonical string")
    al = spark.createDataFrame([("mistralai", "Mistral AI")], "alias string, canonical string")
    dom = spark.createDataFrame([("anthropic.com", "Anthropic")], "domain string, canonical string")
    names = spark.createDataFrame([("mistralai", None), ("Foo", "anthropic.com"), ("Anthropic, PBC", None), ("Anthropicc", None), ("", None), ("Newco", None)], "raw string, domain string")
    got = {r.raw: (r.canonical, r.method, r.confidence) for r in RS.resolve(names, reg, al, dom).collect()}
    assert got["mistralai"] == ("Mistral AI", "ALIAS_MATCH", 1.0) and got["Foo"] == ("Anthropic", "NORMALIZATION_EXACT", 1.0)
    assert got["Anthropic, PBC"][1] == "NORMALIZATION_EXACT" and got["Anthropicc"] == ("Anthropic", "FUZZY_TOKEN_SORT", 0.95)
    assert got[""] == ("Unknown", "MANUAL_OVERRIDE", 0.0) and got["Newco"] == ("Newco", "NEW_ENTITY", 0.5)


def plain_learning(spark, rows, registry, aliases, domains):
    """The resolver as a loop over arrivals."""
    frame = spark.createDataFrame([(i, r, d) for i, (r, d) in enumerate(rows)], "i int, raw string, domain string")
    facts = frame.select("i", X.name_key(F.col("raw")).alias("k"), U.official_domain(F.col("domain"), X.name_key(F.col("raw"))).alias("o")).collect()
    key_of = {r.i: (r.k, r.o) for r in facts}
    entities, grounded, out = set(registry), dict(domains), {}
    keys = dict(zip(one(spark, X.name_key, sorted(registry)), sorted(registry)))
    ratio = lambda a, b: 200.0 * lcs_lengths([a], [b])[0] / (len(a) + len(b))
    order = lambda t: " ".join(sorted(t.split()))
    for i, (raw, domain) in enumerate(rows):
        name, (key, official) = (raw or "").strip(), key_of[i]
        if not name:
            got = ("Unknown", "MANUAL_OVERRIDE")
        elif domain in grounded:
            got = (grounded[domain], "NORMALIZATION_EXACT")
        elif name.lower() in aliases:
            got = (aliases[name.lower()], "ALIAS_MATCH")
        elif key and key in keys:
            got = (keys[key], "NORMALIZATION_EXACT")
        else:
            best = min(((-ratio(order(name), order(e)), e) for e in entities), default=(0, None))
            got = (best[1], "FUZZY_TOKEN_SORT") if -best[0] >= 90 else (name, "NEW_ENTITY")
        if got[1] == "NEW_ENTITY":
            entities.add(name)
            if key:
                keys[key] = name
        if official:
            grounded[domain] = got[0]
        out.setdefault((raw, domain), got)
    return out, entities, grounded


@pytest.mark.parametrize("block", [5, 8192])
def test_learning_in_order_equals_a_loop(spark, block):
    rng = random.Random(block)
    stems = ["acme", "northwind traders", "globex energy", "initech soft", "umbrella bio", "zeta robotics", "omega data mill"]
    def name():
        t = list(rng.choice(stems))
        if rng.random() < 0.5:
            t[rng.randrange(len(t))] = rng.choice("xyz")
        return "".join(t) + rng.choice(["", "", " Inc", " Labs", "s", " AI"])
    rows = list(dict.fromkeys((name(), rng.choice([None, None, "acme.com", "globex.io", "zeta.ai", "known.org"])) for _ in range(120)))
    rows[40:40] = [(None, None), (" ", None), ("AI Labs", None), ("AI Lab", None), ("the alias", "acme.com"), ("The Alias", None)]
    registry, aliases, domains = ["Acme Inc", "Initech Software"], {"the alias": "Aliased"}, {"known.org": "Known"}
    want, entities, grounded = plain_learning(spark, rows, registry, aliases, domains)
    frame = spark.createDataFrame([(r, d, i) for i, (r, d) in enumerate(rows)] + [(*rows[3], 900)], "raw string, domain string, seq long")
    pairs = lambda held, ddl: spark.createDataFrame(list(held), ddl)
    got, names, known = RS.learn_in_order(frame.repartition(3), pairs([(e,) for e in registry], "canonical string"), pairs(aliases.items(), "alias string, canonical string"), pairs(domains.items(), "domain string, canonical string"), block=block)
    assert {(r.raw, r.domain): (r.canonical, r.method) for r in got.collect()} == want
    assert {r.canonical for r in names.collect()} == entities
    assert {r.domain: r.canonical for r in known.collect()} == grounded


def test_scores(spark):
    assert values(spark, S.activity(F.col("d"), F.lit(False)), [(10.0,), (60.0,), (120.0,), (250.0,), (None,)], "d double") == [15, 10, 5, 0, 0]
    assert values(spark, S.adoption(F.col("s")), [(0,), (None,), (5,), (42,), (250,), (1500,), (5000,)], "s int") == [0, 0, 2, 4, 6, 8, 10]


def test_history(spark):
    runs = spark.createDataFrame([("a", i, n) for i, n in enumerate([9, 3, 0, 1, 0, 0])] + [("b", 0, 0)], "source string, run int, n long")
    got = {r.source: (r.history, r.latest, r.trailing_zeros, r.stale) for r in H.source_health(runs).collect()}
    assert got == {"a": ("3,0,1,0,0", 0, 2, True), "b": ("0", 0, 1, False)}


def test_state_machines():
    assert ST.taken(ST.Limiter(2, 60), zip([0, 1, 2, 60, 61])) == [True, True, False, True, True]
    assert ST.taken(ST.Breaker(3, 600, 1800), [(0, True), (1, True), (2, True), (3, True), (1803, True)]) == ["pass", "pass", "trip", "open", "pass"]
    assert ST.taken(ST.Breaker(3, 600, 1800), [(0, True), (1, True), (2, False), (3, True)]) == ["pass"] * 4
    assert ST.taken(ST.Breaker(3, 600, 1800), [(0, True), (1, True), (700, True)]) == ["pass"] * 3


def test_limiter_stream_equals_batch(spark, tmp_path):
    rows = [(i % 3, i, float(i * 7 % 50)) for i in range(60)]
    d = spark.createDataFrame(rows, "key long, seq long, t double")
    d.write.parquet(f"{tmp_path}/in")
    try:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        s = ST.limited_stream(spark.readStream.schema(d.schema).parquet(f"{tmp_path}/in"), "key", 3, 10.0)
        q = s.writeStream.format("memory").queryName("limited").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination(60)
        got = {r.seq: r.granted for r in spark.table("limited").collect()}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    for key in range(3):
        own = sorted((t, s) for k, s, t in rows if k == key)
        assert [got[s] for _, s in own] == ST.taken(ST.Limiter(3, 10.0), zip([t for t, _ in own]))


@pytest.mark.parametrize("machine", ["breaker", "limiter"])
def test_a_stopped_stream_gives_the_rows_of_batch(spark, sf_dir, tmp_path, machine):
    """Files of events out of order, a query that is stopped half way and started again, late rows, and rows that wait at the end."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 20).alias("key"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "error").alias("flag"))
    day, place = 86_400, f"{tmp_path}/in"
    rows = sorted(e.collect(), key=lambda r: (r.ts, r.seq))
    cut = [sorted(rows, key=lambda r: (r.ts.timestamp() // (3 * day), r.seq % 7))[i * len(rows) // 4 : (i + 1) * len(rows) // 4] for i in range(4)]
    last = max(r.ts for r in rows)
    files = [*cut, [(0, -1, rows[0].ts, True), (1, -2, rows[1].ts, False)], [(99, -3, last + dt.timedelta(days=30), False)]]
    stream = lambda: spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(place)

    def go():
        s = ST.broken_stream(stream(), 2, 5 * day, 2 * day, "4 days") if machine == "breaker" else ST.granted_stream(stream(), 3, day, "4 days")
        q = s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        assert q.awaitTermination(240)

    def put(some):
        for part in some:
            spark.createDataFrame(part, e.schema).coalesce(1).write.mode("append").parquet(place)

    kept = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        put(files[:2])
        go()
        before = spark.read.parquet(f"{tmp_path}/out").count()
        put(files[2:])
        go()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert 0 < before < len(got)
    assert {r.seq for r in got if r.late} == {-1, -2}
    batch = ST.broken(e, "key", "ts", "seq", "flag", 2, 5 * day, 2 * day) if machine == "breaker" else ST.limited(e, "key", "ts", "seq", 3, day)
    assert sorted((r.key, r.seq, r.said) for r in got if not r.late) == sorted((r.key, r.seq, str(r[2])) for r in batch.collect())


def test_machines_meet_a_key_over_many_batches(spark):
    rows = [(None if i % 3 == 0 else i % 3, i, float(i // 3), i % 2 == 0) for i in range(900)]
    want = []
    for key in (None, 1, 2):
        own = [(t, b) for k, _, t, b in rows if k == key]
        want += zip([key] * len(own), [s for k, s, _, _ in rows if k == key], ST.taken(ST.Breaker(2, 3, 5), own))
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
        d = spark.createDataFrame(rows, "key long, seq long, t double, b boolean")
        got = ST.by_key(d, "key", ["t", "b"], lambda: ST.Breaker(2, 3, 5), "state", T_STRING).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    assert sorted(((r.key, r.seq, r.state) for r in got), key=str) == sorted(want, key=str)


def test_readers(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A</title><link>l</link><pubDate>x</pubDate></item><item><title>B</title></item></channel></rss>")
    assert [r.title for r in R.read_feed(spark, f"file://{tmp_path}/f.xml").collect()] == ["A", "B"]
    both = R.read_each(spark, {"ok": f"file://{tmp_path}/f.xml", "gone": f"file://{tmp_path}/none.xml"}, R.read_feed)
    assert {r.source for r in both.collect()} == {"ok"}
    md = spark.createDataFrame([("- [A](https://a.org) - first\n* [B](https://b.org/x.md)\n- [C](https://c.org)\n\n## [Big](https://big.ai)\ntag line\n- [Website](https://site.ai)\n### Description\nlong text\n### More",)], "t string")
    assert [tuple(r) for r in R.markdown_bullets(md, "t").where("name in ('A', 'B', 'C')").collect()] == [("A", "https://a.org", "first"), ("C", "https://c.org", "")]
    assert [tuple(r) for r in R.markdown_sections(md, "t").collect()] == [("Big", "https://site.ai", "long text")]
    p = spark.createDataFrame([(json.dumps({"data": [{"title": "T", "url": "http://ok/x", "created_at": 0}, {"title": "U", "url": "http://skip.me/x"}]}),)], "j string")
    assert [r.title for r in R.jobs_of_data(p, "j", "skip.me").collect()] == ["T"]
    n = spark.createDataFrame([('["legal notice", "job"]',)], "j string")
    assert [r["item"] for r in R.jobs_after_notice(n, "j").collect()] == ["job"]
    page = spark.createDataFrame([('<h1>My Srv</h1><meta name="description" content="d"><p>42 Stars Free</p><a href="https://github.com/o/r">x</a><a href="https://dir.org/z">z</a><a href="https://o.org">o</a>',)], "h string")
    r = page.select(*[c.alias(k) for k, c in R.detail_page(F.col("h"), "dir.org").items()]).first()
    assert tuple(r) == ("My Srv", "d", None, "Free", 42, "o/r", "https://o.org")


def test_wal_csv_and_state(spark, tmp_path):
    root = f"file://{tmp_path}"
    d = spark.createDataFrame([("k1", "a"), ("k2", "b")], "k string, v string")
    K.append_wal(d, "k", f"{root}/wal")
    (tmp_path / "wal" / commits.snapshot(spark, f"{root}/wal").parts[commits.ROWS][0] / "x.json").write_text('not json\n{"key": "k1", "data": {"k": "k1", "v": "late"}}\n')
    assert sorted(r.key for r in R.replay_wal(spark, f"{root}/wal", "k STRING, v STRING").collect()) == ["k1", "k2"]
    assert K.write_tables({"a": d, "b": d.limit(0)}, f"{root}/out") == ["a"]
    assert sorted(map(tuple, R.read_csv(spark, f"{root}/out/a").collect())) == [("k1", "a"), ("k2", "b")]
    K.write_state(spark.createDataFrame([("news", "1"), ("jobs", "2")], "crawler string, key string"), f"{root}/st")
    K.write_state(spark.createDataFrame([("news", "3")], "crawler string, key string"), f"{root}/st")
    assert sorted((r.crawler, r.key) for r in K.read_state(spark, f"{root}/st", "crawler string, key string").collect()) == [("jobs", "2"), ("news", "3")]
    assert [r.batch for r in K.sheet_batches(d, "k", size=1).orderBy("k").collect()] == [0, 1]


def test_more_state_machines():
    assert ST.taken(ST.Backoff(2, 5), [(0, False), (1, False), (2, True), (3, False), (4, True), (10, True), (11, False)]) == ["go", "go", "go", "spent", "paused", "go", "spent"]
    requests = [(0, True, False), (1, True, True), (2, True, False), (3, True, False), (4, False, False), (5, True, True), (700, True, False)]
    assert ST.taken(ST.Escalation(2, 600, 100), requests) == ["failed", "trip", "open", "open", "ok", "open", "failed"]
    assert ST.taken(ST.Escalation(2, 600, 100), [(0, True, True), (1, True, True)]) == ["escalated", "escalated"]


def test_a_source_that_fails_in_its_rows_leaves_the_others(spark):
    def late(s):  # fails when it is read, not when it is planned
        return s.range(5).select(F.expr("assert_true(id < 3, 'broken row')").cast("string").alias("title"))

    sources = [R.Source("good", lambda s: s.range(2).select(F.col("id").cast("string").alias("title"))), R.Source("bad", late), R.Source("none", lambda s: s.table("no_such_table"))]
    rows, failed = R.read_sources(spark, sources, "title string")
    assert {r.source for r in rows.collect()} == {"good"} and set(failed) == {"bad", "none"}
    assert R.read_sources(spark, sources[1:], "title string")[0].count() == 0


def test_page_dates_are_looked_for_in_every_place(spark):
    now = F.lit("2026-09-04 12:00:00").cast("timestamp")
    crumbs = '<script type="application/ld+json">{"@type": "BreadcrumbList", "itemListElement": []}</script>'
    pages = [crumbs + '<script type="application/ld+json">{"datePublished": "2026-09-03"}</script>', '<script type="application/ld+json">[{"a": 1}, {"dateCreated": "2026-09-02"}]</script>',
             '<time datetime="">no</time><time>x</time><time datetime="2026-09-01">y</time>', crumbs + "<time>z</time>", '<script type="application/ld+json">broken {</script><time>2026-08-31</time>']
    got = one(spark, lambda h: F.date_format(T.date_from_html(h, F.lit(""), now), "MM-dd"), pages)
    assert got == ["09-03", "09-02", "09-01", None, "08-31"]


def test_token_budget(spark):
    vocabulary = pytest.importorskip("public_tokenizers")
    from winnow.functions.tokens import encoder, token_budget

    path, pattern = str(vocabulary.path("byte_bpe_50k.tiktoken")), vocabulary.PATTERN
    texts = ["", "one two", "é" * 50, "longwordslikethese and others, too! " * 40, "<|endoftext|>" * 9]
    enc = encoder(path, pattern)
    want = [t if len(enc.encode_ordinary(t)) <= 20 else enc.decode(enc.encode_ordinary(t)[:20]) for t in texts]
    assert one(spark, lambda t: token_budget(t, 20, path, pattern), texts) == want and any(a != b for a, b in zip(texts, want))
    assert one(spark, lambda t: token_budget(t, 20, path, pattern), [None]) == [""]


def test_a_date_meets_only_the_patterns_of_its_shape(spark):
    now = F.lit("2026-09-03 12:00:00").cast("timestamp")
    # the shape of a text that a pattern reads is the pattern's own
    at = spark.sql("SELECT timestamp'2026-09-03 07:08:09' AS t")
    for p in T.WRITTEN:
        assert at.select(T._shape(F.date_format("t", p))).first()[0] == T._pattern_shape(p), p
    whole = ["2026-09-03T07:08:09Z", "2026-09-03T09:08:09+02:00", "2026-09-03T07:08:09.000", "2026-09-03 07:08:09", "Thu, 3 Sep 2026 07:08:09 GMT", "3 Sep 2026 09:08:09 +0200", "3 Sep 2026 07:08:09 UTC", "2026/09/03 07:08:09"]
    assert one(spark, lambda t: T.parse_date(t, now).cast("string"), whole) == ["2026-09-03 07:08:09"] * len(whole)
    assert one(spark, lambda t: T.parse_date(t, now).cast("string"), ["2026-09-03T", "2026-9-3", "Sept 3, 2026", "13/13/2026"]) == [None] * 4
    # a stated date is worked out once, however often a gate looks at it
    d = spark.createDataFrame([], "a string").select(T.job_date(F.col("a"), F.col("a"), F.lit(True), now))
    shown = d._jdf.queryExecution().analyzed().expressions().mkString("\n")
    assert shown.count("try_to_timestamp") <= 2 * len(T.PATTERNS + T.WRITTEN) + 8


def test_names_of_equal_texts_only_are_learned_without_pairs(spark, monkeypatch):
    """Where only a ratio of 100 is accepted no pair of names is scored, and the answers are those of the scores."""
    rows = [("Beta Alpha", None, 0), ("alpha  beta", None, 1), ("Gamma Co", "g.io", 2), ("beta, alpha", "b.io", 3), ("!!!", None, 4), ("???", None, 5), (" ", None, 6), (None, None, 7), ("Old Thing", None, 8), ("thing old", None, 9)]
    names = spark.createDataFrame(rows, "raw string, domain string, seq long")
    registry, none = spark.createDataFrame([("Thing  Old",), ("Old thing",)], "canonical string"), spark.createDataFrame([], "alias string, canonical string")
    learned = lambda accept, block: {(r.raw, r.domain): (r.canonical, r.method, r.confidence) for r in RS.learn_in_order(names, registry, none, none.withColumnRenamed("alias", "domain"), accept, block)[0].collect()}
    for block in (3, 100):
        want = learned(99.9999, block)
        with monkeypatch.context() as m:
            m.setattr(RS, "alike", None)
            m.setattr(NI, "_nearest", None)
            assert learned(100.0, block) == want
    assert len(want) == len(rows) and want["beta, alpha", "b.io"][0] == "Beta Alpha"


def test_dates_of_plain_postings_are_those_of_the_whole_rule(spark):
    """Numbers, and rows without a word of time, take a shorter way to the same date."""
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    numbers = ["1717236000000", " 1717236000.5 ", "1717236000", "1717149600", "1717149599", "0", "-5", "1e5", "99999999999", "2024-06-01T10:00:00Z", "3 hours ago", "soon", "", " ", None]
    titles = ["Engineer", "Posted 2 HOURS AGO", "Just  now", "JUST ANNOUNCED: x", "Monday person", "Nowhere", "x" * 2000 + " today", "", None]
    rows = [(p, t, n) for p in numbers for t in titles for n in (True, False, None)]
    d = spark.createDataFrame(rows, "p string, t string, n boolean")
    stated = F.trim(F.coalesce("p", F.lit(""))) != ""
    told = T.fresh_only(F.when(stated, T.parse_date(F.col("p"), now)).otherwise(T.infer_recency(F.col("t"), now)), now)
    want = F.coalesce(told, F.when(~stated & F.coalesce("n", F.lit(False)), now))
    got = d.select(T.job_date(F.col("p"), F.col("t"), F.col("n"), now).alias("g"), want.alias("w"), (want.isNotNull() & ~stated).alias("i")).collect()
    assert [(r.g.date, r.g.inferred) for r in got] == [(r.w, r.i) for r in got] and len({r.w for r in got}) > 4
