"""Token alignment, periodic runs and URL verdicts, against brute force and SQL."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import periodic_runs, queries, token_alignment, url_filter
from tests.conftest import SF_SMALL
from tests.parity import compare, duck

DOCS = "doc_id bigint, text string, lang string"
TOKENIZERS = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def docs_of(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], schema)


@pytest.fixture(scope="module")
def tokens():
    return token_alignment.Tokens(*TOKENIZERS)


# --------------------------------------------------------------------------- token alignment


def _aligned(tokens, text):
    """Ids of both sides and their groups, straight from the libraries and the byte offsets."""
    if not text:
        return [], [], []
    a = tokens.a.encode(" " + text, add_special_tokens=False).ids
    b = tokens.b.encode(text)
    whole = (" " + text).encode()
    bytes_a, bytes_b = [tokens.bytes_a[i] for i in a], [tokens.bytes_b[i] for i in b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], []
    ends_a = [sum(map(len, bytes_a[: k + 1])) for k in range(len(a))]
    ends_b = [sum(map(len, bytes_b[: k + 1])) for k in range(len(b))]
    groups, last = [], 0
    for cut in sorted({*ends_a} & {*ends_b}):
        groups.append(([x for x, e in zip(a, ends_a) if last < e <= cut], [x for x, e in zip(b, ends_b) if last < e <= cut]))
        last = cut
    return a, b, groups


def _spelled(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def _odd_texts(rng, n):
    parts = [*"ab éß\n\t <>|1.,中文ñ\x00", "<s>", "</s>", "<|endoftext|>", "'ll", " the", "ing", "▁", "‍", "😀", "कि", " ", "  ", "====="]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_alignment_equals_brute_force(tokens):
    rng = random.Random(11)
    texts = ["", " ", "▁a", "<s>", "a" * 900, " " * 700, "中" * 300, "=" * 333, *_odd_texts(rng, 900)]
    windows = token_alignment.Windows(tokens)
    for start in range(0, len(texts), 41):
        part = texts[start : start + 41]
        got = {k: v.to_pylist() for k, v in token_alignment._chunk(part, tokens, windows).items()}
        for k, text in enumerate(part):
            a, b, groups = _aligned(tokens, text)
            assert (got["n_a"][k], got["n_b"][k], got["n_groups"][k]) == (len(a), len(b), len(groups)), text
            assert got["groups"][k] == _spelled(groups)
            linked = Counter((x, y) for left, right in groups for x in left for y in right)
            assert {(p["a"], p["b"]): p["n"] for p in got["pairs"][k]} == linked
            assert got["n_links"][k] == sum(linked.values())


def test_window_memo_changes_nothing(tokens, monkeypatch):
    texts = _odd_texts(random.Random(5), 60)
    plain = token_alignment._chunk(texts, tokens, token_alignment.Windows(tokens))
    monkeypatch.setattr(token_alignment, "MEMO_WINDOWS", 3)
    monkeypatch.setattr(token_alignment, "KEY", 8)
    windows = token_alignment.Windows(tokens)
    for k, text in enumerate(texts):
        one = token_alignment._chunk([text], tokens, windows)
        assert [v[0].as_py() for v in one.values()] == [plain[c][k].as_py() for c in one]


def test_settled_characters_are_cut_alike(tokens):
    """Every character that the quicker encoder may see gives the library's ids in all positions of the pattern."""
    settled = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and not token_alignment._OTHER.search(chr(c))]
    assert len(settled) > 30_000
    contexts = "a{0}b 1{0}2 {0}{0} .{0}! {0}\n{0}  {0}'s"
    texts = ["".join(contexts.format(c) for c in settled[k : k + 50]) for k in range(0, len(settled), 50)]
    library = [e.ids for e in tokens.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert tokens._ranks is not None and tokens.encode_a(texts) == library


def test_quicker_encoder_follows_the_merges(tokens):
    rng = random.Random(8)
    words = [t.decode() for t in tokens.bytes_a if t.isascii()]
    texts = ["".join(rng.choice(words) for _ in range(rng.randrange(1, 9))) + "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(25))) for _ in range(8000)]
    assert tokens.encode_a(texts) == [e.ids for e in tokens.a.encode_batch_fast(texts, add_special_tokens=False)]


@pytest.mark.parametrize("frequent", [0, 7, 1 << 19])
def test_link_counts_equal_brute_force(spark, tokens, frequent):
    rng = random.Random(frequent)
    texts = [None, "", "▁", "the cat", "the cat", *_odd_texts(rng, 40), "a b " * 2000]
    rows = [*((i, t) for i, t in enumerate(texts)), (3, "the cat"), (None, "the cat"), (None, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, pairs int, strata_row string")
    got = token_alignment.link_counts(token_alignment.align_tokens(df, *TOKENIZERS), frequent).collect()
    links = [Counter((x, y) for left, right in _aligned(tokens, t)[2] for x in left for y in right) for _, t in rows]
    held = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    expect = [(i, sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items())) for (i, _), c in zip(rows, links)]
    assert sorted((str(r.doc_id), r.n_links, r.n_best, r.count_sum) for r in got) == sorted((str(i), *rest) for i, *rest in expect)


def test_alignment_query_and_empty_table(spark, tokens):
    got = {r.doc_id: r for r in queries.op11_token_alignment(spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert got.keys() == texts.keys()
    for i, text in list(texts.items())[:12]:
        a, b, groups = _aligned(tokens, text)
        assert (got[i].n_a, got[i].n_b) == (len(a), len(b))
        assert got[i].groups_sha256 == (hashlib.sha256(_spelled(groups).encode()).hexdigest() if a else "")
    none = token_alignment.align_tokens(docs_of(spark, []), *TOKENIZERS)
    assert token_alignment.link_counts(none).collect() == []


# --------------------------------------------------------------------------- periodic runs


def _runs(words, least, times):
    """Runs by trying every period and checking every smaller one."""
    out = []
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = (r for r in range(1, q) if all(words[k] == words[k + r] for k in range(i, i + length - r)))
            if j > i and length >= max(least, times * q) and next(smaller, None) is None:
                out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=500, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=7).flatmap(lambda w: st.integers(1, 7).map(lambda k: w * k)), max_size=5),
    st.sampled_from([(24, 3), (6, 2), (4, 3), (1, 2), (12, 4)]),
)
def test_runs_equal_brute_force(parts, limits):
    words = [w for part in parts for w in part]
    expect = _runs(words, *limits)
    assert periodic_runs.runs_of(words, *limits) == expect
    if expect:
        assert periodic_runs._repeated([[b"x"], words, []], periodic_runs.lcp_floor(*limits))[1]


def test_runs_of_fibonacci_and_random_words():
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 400:
        a, b = b, b + a
    rng = random.Random(4)
    for words in (b[:400], [rng.choice([b"0", b"1"]) for _ in range(400)]):
        for limits in ((6, 2), (4, 3), (24, 3)):
            assert periodic_runs.runs_of(words, *limits) == _runs(words, *limits)


def test_positions_keep_their_order(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_BLOCK", 4)
    rng = random.Random(2)
    places = rng.sample(range(1000), 300)
    held = periodic_runs.Positions(places[0])
    for k, x in enumerate(places[1:], 1):
        below, above = [p for p in places[:k] if p < x], [p for p in places[:k] if p > x]
        assert held.add(x) == (max(below, default=-1), min(above, default=-1))
    assert list(held) == sorted(places)


def _cycled(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


def test_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(6)
    texts = [None, "", " \n\t", "one", *(" ".join(rng.choice("abcd") for _ in range(rng.randrange(90))) for _ in range(150)), "a b\x0bc\x0cd  " * 20, "x " * 60, "p q\u00a0r s\u2003" * 30]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(None, "a " * 30, "en", "s", 0), (7, texts[7], "en", "s", 0), (-3, "u v w " * 11, "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, runs string, words int").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(queries.op12_periodic_runs(spark, str(tmp_path)).collect(), key=str)
    expect = []
    for i, text, *_ in rows:
        words = _cycled(i, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        runs = _runs(words, 24, 3)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        milli = 1000 * best[1] // best[2] if best else None
        expect.append((i, len(runs), *(best or (None,) * 3), milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()))
    assert sum(e[1] > 0 for e in expect) > 5
    assert [tuple(r) for r in got] == sorted(expect, key=lambda e: str(type(got[0])(*e)))


def test_runs_of_long_texts_and_empty_tables(spark):
    cycle = [b"%d" % (k % 5000) for k in range(60_000)]
    assert periodic_runs.runs_of(cycle) == [(0, 60_000, 5000)]
    assert periodic_runs.collapsed(cycle, [(0, 60_000, 5000)]) == b" ".join(cycle[:5000])
    (row,) = periodic_runs.find_runs(docs_of(spark, ["a " * 100_000])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 100_000, 1)] and row.collapsed == "a"
    assert periodic_runs.find_runs(docs_of(spark, [])).collect() == []


# --------------------------------------------------------------------------- URL verdicts


URLS = [
    None, "", "no scheme", "http://", "https://a.net", "https://a.net/", "http://net/x", "HTTP://WWW.Example.NET/en/1?x=://b", "http://example.net/EN/2", "http://xexample.net/en/3",
    "http://example.com/de/", "http://m.example.com/de/4#t", "http://example.com/de", "https://example.com/en/5", "http://a.org/fr/6", "http://a.org/de/7", "http://org/fr/",
    "a://b://c.net/d", "http://a.net:80/x", "http://u@a.org/fr/x", "http://ex\nample.org/fr/\n?q", "http://é😀.org/de/ß", "http://a.org?/fr/", "//x.net/", "http://\x02\x03.com/",
]


def _parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", url or ""
    rest = url[at + 3 :]
    raw = re.match(r"[^/?#]*", rest).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in raw)
    after = rest[len(raw) :]
    return host, re.match(r"[^?#]*", after).group(), host + after


def _rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def _verdicts(urls, order):
    """Models, limit and verdicts in plain Python."""
    rows = [(*_parts(u), _rule(*_parts(u)[:2])) for u in urls]
    held = [rule is not None and hashlib.md5(t.encode()).hexdigest()[0] in url_filter.HELD_OUT for *_, t, rule in rows]

    def grams(text):
        s = "\x02" + text + "\x03"
        return [s[max(0, i - order) : i + 1] for i in range(1, len(s))]

    counts = {v: Counter() for v in ("allow", "block")}
    for (*_, text, rule), aside in zip(rows, held):
        if rule and not aside:
            counts[rule.verdict].update(g[-k:] for g in grams(text) for k in range(1, len(g) + 1))
    symbols = len({g for c in counts.values() for g in c if len(g) == 1})
    after = {v: defaultdict(list) for v in counts}
    for v, c in counts.items():
        for g, n in c.items():
            after[v][g[:-1], len(g)].append(n)

    def probability(v, gram):
        shorter = probability(v, gram[1:]) if len(gram) > 1 else 1 / (symbols + 1)
        seen = after[v][gram[:-1], len(gram)]
        return (counts[v][gram] + len(seen) * shorter) / (sum(seen) + len(seen)) if seen else shorter

    def score(text):
        return [round((math.log(probability("allow", g)) - math.log(probability("block", g))) * 1_000_000) for g in grams(text)]

    steps = [(max(-20_000, min(20_000, math.floor(sum(s) / (len(s) * 1000)))), rule.verdict) for (*_, t, rule), aside in zip(rows, held) if aside for s in [score(t)]]
    good, bad = ([x for x, v in steps if v == side] for side in ("allow", "block"))
    gains = {x: sum(y >= x for y in good) * len(bad) - sum(y >= x for y in bad) * len(good) for x, _ in steps}
    limit = max((x for x in gains if gains[x] == max(gains.values())), default=0) if max(gains.values(), default=0) > 0 else 0
    out = []
    for host, path, text, rule in rows:
        s = score(text)
        out.append((host, path, rule and rule.name, rule.verdict if rule else "allow" if sum(s) >= limit * 1000 * len(s) else "block"))
    return out


@pytest.mark.parametrize("order", [1, 5])
def test_url_verdicts_equal_brute_force(spark, order):
    rng = random.Random(order)
    hosts = ["cheap", "news", "shop", "blog", "m", "wiki"]
    made = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}.{rng.choice(hosts)}.example.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{rng.randrange(300)}" for _ in range(300)]
    urls = URLS + made + made[:9]
    pages = spark.createDataFrame([(i, u, "x", 0) for i, u in enumerate(urls)], "page_id bigint, url string, host string, row int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.url_verdicts(pages, order=order).collect()}
    assert [got[i] for i in range(len(urls))] == _verdicts(urls, order)


def test_url_query_matches_sql(spark):
    result = compare(spark, "op13_url_filter", queries.op13_url_filter, queries.ORACLES["op13_url_filter"], SF_SMALL, duck(SF_SMALL))
    assert result["status"] == "ok", result


def test_url_query_stays_native(spark):
    df = queries.op13_url_filter(spark, SF_SMALL)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


def test_url_joins_never_broadcast_what_grows(spark, monkeypatch):
    def plan(df):
        return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")

    plans, write = [], url_filter.scratch
    monkeypatch.setattr(url_filter, "scratch", lambda df, label: plans.append(plan(df)) or write(df, label))
    # Tables this small would all be broadcast if Spark chose.
    verdicts = url_filter.url_verdicts(spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string"))
    assert verdicts.count() == len(URLS)
    plans.append(plan(verdicts))
    # One join for each longer context, one with the ratios, two back to the pages.
    assert sum(p.count("SortMergeJoin") for p in plans) == url_filter.ORDER + 3
    assert not any("Broadcast" in p for p in plans)


def test_urls_without_rules_long_and_empty(spark):
    schema = "page_id bigint, url string"
    pages = spark.createDataFrame([(1, "http://a.com/x"), (None, None), (2, "http://a.com/" + "p" * 200_000)], schema)
    got = url_filter.url_verdicts(pages, rules=[]).collect()
    assert [r.verdict for r in got] == ["allow"] * 3 and {r.score for r in got} == {0.0}
    assert url_filter.url_verdicts(spark.createDataFrame([], schema)).collect() == []


def test_longest_rule_wins(spark):
    rules = [url_filter.Rule("block", "b.c", "/"), url_filter.Rule("allow", "c", "/xy"), url_filter.Rule("block", "a.b.c", "/x")]
    cases = {"http://a.b.c/xyz": "a.b.c/x", "http://b.c/xyz": "b.c/", "http://d.c/xyz": "c/xy", "http://a.b.c/q": "b.c/", "http://abc/xy": None}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)], "page_id bigint, url string")
    got = {r.page_id: r.rule for r in url_filter.url_verdicts(pages, rules=rules).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
