"""Map-side text operators against brute force: decontamination, tokens, surrogates, segmentations, WARC."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import decontam, pii, sentencepiece_topk, token_counts, warc

DOCS = "doc_id bigint, text string, lang string"


def docs_of(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], schema)


# --------------------------------------------------------------------------- decontamination


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _contamination(texts, items, width):
    """Marks and items by comparing every window with every position."""
    out = []
    for text in texts:
        words, hit, found = _words(text), set(), set()
        for name, item in items:
            w = _words(item)
            n = min(width, len(w))
            for a in range(len(w) - n + 1) if n else ():
                for b in range(len(words) - n + 1):
                    if words[b : b + n] == w[a : a + n]:
                        hit |= set(range(b, b + n))
                        found.add(str(name) if name is not None else "")
        out.append((len(words), len(hit), sorted(found)))
    return out


def _texts(rng, n, words, vocabulary="abcdE"):
    return ["".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "é "]) for _ in range(rng.randint(0, words))) for _ in range(n)]


@pytest.mark.parametrize("width,shard", [(3, 1 << 20), (4, 12), (2, 40)])
def test_decontamination_equals_brute_force(spark, width, shard):
    rng = random.Random(width * shard)
    items = [(i, t) for i, t in enumerate(_texts(rng, 25, 9))] + [(None, "b c d E a b"), (3, "a"), (99, None), (100, "...")]
    texts = [None, "", "...", *_texts(rng, 60, 25), "a b " * 3000]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {r.doc_id: r for r in decontam.find_contamination(docs_of(spark, texts), bench, width=width, shard_bytes=shard).collect()}
    assert len(got) == len(texts)
    for i, (n, hit, found) in enumerate(_contamination(texts, items, width)):
        row = got[i]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, hit, len(found), hit > 0), (i, texts[i])
        assert row.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


@pytest.mark.parametrize("shard", [1 << 20, 60])
def test_removal_leaves_no_window_and_keeps_clean_texts(spark, shard):
    item = "one two three four five six seven eight nine ten eleven twelve"
    other = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    half = " ".join(item.split()[:5])
    rest = " ".join(item.split()[5:])
    filler = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", filler, f"{filler} {item} {filler}", item, f"{filler} {half} {other} {rest} {filler}"]
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id bigint, text string")
    df = docs_of(spark, texts).selectExpr("*", "'x' as marks", "array(1) as items")
    out = decontam.remove_contamination(df, bench, shard_bytes=shard)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] is None and got[1] == "" and got[2] == filler
    assert 4 not in got  # nothing but benchmark
    for i in (3, 5):
        left = " ".join(_words(got[i]))
        assert f"w59 w0" in left and other not in left
    if shard > 60:
        assert all(hit == 0 for _, hit, _ in _contamination(list(got.values()), [(1, item), (2, other)], 10))


def test_removal_goes_over_all_shards_again(spark):
    """Cutting one item joins a window of another, which may lie in any other shard."""
    items = [(i, f"p{i} q{i} r{i} s{i}") for i in range(12)]
    texts = [f"one two three four p{a} q{a} p{b} q{b} p{c} q{c} r{c} s{c} r{b} s{b} r{a} s{a} five six seven eight nine ten eleven twelve thirteen" for a, b, c in zip(range(12), [*range(1, 12), 0], [*range(2, 12), 0, 1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for shard in (1 << 20, 20):
        left = decontam.remove_contamination(docs_of(spark, texts), bench, width=4, shard_bytes=shard).collect()
        assert len(left) == 12 and {tuple(r.text.split()) for r in left} == {tuple("one two three four five six seven eight nine ten eleven twelve thirteen".split())}


def test_decontamination_of_empty_tables(spark):
    none, bench = docs_of(spark, []), spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.find_contamination(none, bench).collect() == []
    (row,) = decontam.find_contamination(docs_of(spark, ["a b c"]), bench).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (3, 0, False)
    assert decontam.remove_contamination(docs_of(spark, ["a b c"]), bench).count() == 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=8), max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c", b"x"]), max_size=30), st.integers(1, 4))
def test_automaton_marks_what_windows_cover(items, words, width):
    named = [(str(i), w) for i, w in enumerate(items)]
    marks, found = decontam.SuffixAutomaton(named, width).scan(words)
    hit, names = set(), set()
    for name, w in named:
        n = min(width, len(w))
        for a in range(len(w) - n + 1) if n else ():
            for b in range(len(words) - n + 1):
                if words[b : b + n] == w[a : a + n]:
                    hit |= set(range(b, b + n))
                    names.add(name)
    assert {i for i, m in enumerate(marks or ()) if m} == hit and found == names


# --------------------------------------------------------------------------- token counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _library(text):
    return len(token_counts._tokenizer(WORD_BPE).encode(text, add_special_tokens=False).ids)


def test_token_counts_equal_the_library(spark):
    texts = [None, "", " \n", "Hello, hello world!", "<|endoftext|> a <|ENDOFTEXT|>", "x" * 50_000, "Σας ΣΑΣ ﬁ é é  b", "the cat " * 3000]
    rows = token_counts.token_counts(docs_of(spark, texts + texts), WORD_BPE, limit=10, frequent=3, cache=4).collect()
    got = collections.Counter((r.doc_id % len(texts), r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    for i, t in enumerate(texts):
        n = _library(t or "")
        assert got[i, len((t or "").encode()), n, n > 10] == 2, t
    assert token_counts.token_counts(docs_of(spark, []), WORD_BPE).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(" \t\n'sreSTL<|>endoftext"))), max_size=30))
def test_pretoken_lengths_add_up(text):
    lengths = token_counts._Lengths(WORD_BPE, {}, 1000, 16)
    words = token_counts._fold(text.encode()).split()
    lengths.learn(set(words))
    assert sum(map(lengths.__getitem__, words)) == _library(text)


# --------------------------------------------------------------------------- surrogates


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.text(max_size=5))
def test_derangement_is_one_to_one_and_moves_all(size, domain):
    image = [pii.derange("key", domain, x, size) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert size == 1 or all(a != b for a, b in enumerate(image))


ENTITIES = [
    ("email", "Bob.Smith+x@Mail3.example.com"),
    ("phone", "+1 (017) 555-7713"),
    ("phone", "020 7946 0958"),
    ("card", "4111 1111 1111 1111"),
    ("card", "4952935900253052"),
    ("ipv4", "169.122.221.182"),
    ("ipv4", "192.168.1.7"),
    ("secret", "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"),
    ("ssn", "123-45-6789"),
]


@pytest.mark.parametrize("kind,entity", ENTITIES)
def test_surrogates_keep_type_and_format(kind, entity):
    text = f"see {'token = ' if kind == 'secret' else ''}{entity}, thanks"
    assert [(k, text[a:b]) for k, a, b in pii.entities(text)] == [(kind, entity)]
    new = pii.surrogate("k", kind, entity)
    assert new != entity and new == pii.surrogate("k", kind, entity) and new != pii.surrogate("other", kind, entity)
    assert [k for k, _, _ in pii.entities(text.replace(entity, new))] == [kind]
    shape = lambda s: [("0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c) for c in s]
    if kind == "secret":
        assert re.fullmatch(r"[0-9a-f]{40}", new)
    elif kind == "ipv4":
        assert new.startswith("192.168.") == entity.startswith("192.168.")
    else:
        assert shape(new) == shape(entity)
    if kind == "card":
        digits = lambda s: [int(c) for c in s if c.isdigit()]
        assert pii._luhn(digits(new)) == pii._luhn(digits(entity))


def test_names_keep_gender_script_and_case():
    new, found = pii.replace_text("k", "Dear Frau Anna Schmidt and Mr. JOHN went to the Господин Иван Петров")
    assert [e for _, e, _ in found] == ["Anna Schmidt", "JOHN", "Иван Петров"]
    (anna, _), (john,), (ivan, petrov) = [s.split(" ") for _, _, s in found]
    assert anna.lower() in pii.GIVEN_NAMES["latin", "f"] and anna != "Anna"
    assert john.lower() in pii.GIVEN_NAMES["latin", "m"] and john.isupper()
    assert ivan.lower() in pii.GIVEN_NAMES["cyrillic", "m"] and re.fullmatch("[А-Я][а-я]+", petrov)
    assert new.endswith(f"{ivan} {petrov}") and " went to the " in new


def test_surrogates_are_distinct_and_coherent(spark):
    rng = random.Random(4)
    mails = [f"{a}{b}@x{c}.com" for a in "abAB" for b in "cd" for c in range(4)]
    cards = ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(300)]
    texts = [None, "", "no entity", *(" and ".join(rng.choice(mails + cards) for _ in range(9)) for _ in range(200))]
    df = docs_of(spark, texts + texts).selectExpr("*", "1 as n_entities", "text as kind")
    out = pii.replace_pii(df, entities_col="found")
    assert out.columns == [*df.columns, "found"]
    assert pii.collisions(out, "found").collect() == []
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[0].text is None and rows[1].text == "" and rows[2].text == "no entity"
    assert all(rows[i].text == rows[i + len(texts)].text for i in range(len(texts)))
    left = " ".join(r.text for r in rows.values() if r.text)
    assert not any(c in left for c in cards)
    lower = {}
    for r in rows.values():
        for f in r.found:
            assert lower.setdefault(f["entity"].lower(), f["surrogate"].lower()) == f["surrogate"].lower()
    assert pii.replace_pii(docs_of(spark, [])).collect() == []


# --------------------------------------------------------------------------- segmentations

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_topk.Pieces(PIECES, 0.3)


def _all_paths(pieces, text):
    whole = "▁" + text.replace(" ", "▁")

    def paths(i):
        if i == len(whole):
            yield (), 0.0
            return
        for j, ids, lp in pieces.edges(whole, i):
            for rest, more in paths(j):
                yield ids + rest, lp + more

    every = list(paths(0))
    total = math.log(sum(math.exp(x) for _, x in every))
    return {ids: x - total for ids, x in every}


@pytest.mark.parametrize("text", ["the", "a cat", "ünt€", "x,  y²."])
def test_samples_follow_the_distribution_without_replacement(pieces, text):
    every = _all_paths(pieces, text)
    sampler, runs = sentencepiece_topk.Sampler(pieces), 3000
    first, second, weight = collections.Counter(), collections.Counter(), 0.0
    for n in range(runs):
        got = sampler.topk([text], 3, [np.random.Generator(np.random.Philox(key=[n, 1]))])[0]
        ids = [tuple(g[0]) for g in got]
        assert len(set(ids)) == len(ids) == min(3, len(every))
        assert all(abs(every[i] - g[1]) < 1e-9 for i, g in zip(ids, got))
        assert [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        first[ids[0]] += 1
        second[ids[1]] += 1
        weight += sum(math.exp(g[1]) / g[3] for g in got)
    assert abs(weight / runs - 1) < 0.05  # the inclusion scores make the estimate unbiased
    for a, lp in every.items():
        p = math.exp(lp)
        q = sum(math.exp(x) * p / (1 - math.exp(x)) for b, x in every.items() if b != a)
        assert abs(first[a] / runs - p) < 0.045 and abs(second[a] / runs - q) < 0.045


def test_all_segmentations_of_a_small_lattice_are_found(pieces):
    every = _all_paths(pieces, "the")
    got = sentencepiece_topk.Sampler(pieces).topk(["the"], 50, [np.random.default_rng(3)])[0]
    assert {tuple(g[0]) for g in got} == set(every) and all(g[3] == 1.0 for g in got)


def test_runs_are_looked_up_by_length_and_spelled_from_arrays(pieces, monkeypatch):
    runs = ["▁segmentation", "▁unt€rschied!", "▁aaaaaaaaaaaa", "▁中文字中文字中文字中文字"]
    calls, find = [], sentencepiece_topk.Pieces.find
    monkeypatch.setattr(sentencepiece_topk.Pieces, "find", lambda self, hashes: calls.append(len(hashes)) or find(self, hashes))
    solved = sentencepiece_topk.Solved(pieces, runs)
    assert len(calls) <= len(runs[0])  # not one for each substring
    lattices = [sentencepiece_topk.Lattice(pieces, run) for run in runs]
    for u in (None, np.array([0.999, 0.2, 0.9, 0.99])):
        cuts, ids = solved.best_paths() if u is None else solved.pick(np.arange(4), u)[:2]
        flat, counts = sentencepiece_topk.joined(pieces, runs, cuts, ids)
        paths = [sentencepiece_topk.ends_of(c) for c in cuts]
        assert [x for run, path in zip(runs, paths) for x in pieces.spell(run, path)] == flat.tolist()
        assert counts.sum() == len(flat)
        if u is None:
            assert paths == [lattice.best for lattice in lattices]
        else:
            logp = solved.pick(np.arange(4), u)[2]
            assert all(abs(lattice.path_logp(path) - lp) < 1e-9 for lattice, path, lp in zip(lattices, paths, logp))


def test_segmentations_decode_to_the_text(spark):
    texts = [None, "", " ", "a  b ", "Ünïcödé 中文字 😀\n\ttabs", "a" * 3000, "word " * 4000, "▁x"]
    df = docs_of(spark, texts + texts)
    rows = sentencepiece_topk.sample_segmentations(df, PIECES, k=3)
    again = {r.doc_id: r.samples for r in rows.collect()}
    assert again == {r.doc_id: r.samples for r in rows.repartition(3).collect()}
    assert [list(s.ids) for s in again[0]] == [[]] and again[0][0].inclusion == 1.0
    flat = rows.selectExpr("doc_id", "explode(samples.ids) as ids", "'x' as text")
    seen = collections.Counter()
    for r in sentencepiece_topk.decode_ids(flat, PIECES).collect():
        assert r.text == (texts[r.doc_id % len(texts)] or "").replace("▁", " ")
        seen[r.doc_id] += 1
    assert seen[5] == seen[6] == 3
    assert sentencepiece_topk.sample_segmentations(docs_of(spark, []), PIECES).collect() == []


# --------------------------------------------------------------------------- WARC


def test_derivatives_are_linked_to_their_responses(spark):
    page = "<html><head><title>A &amp; B</title><script>x<p>y</script></head><body><p>One<br>two &lt;three&gt;</p><!-- c --><a href='/l?a=1'>link</a></body></html>"
    pages = spark.createDataFrame([(1, "http://a/x", page), (1, "http://a/x", page), (2, None, None), (3, "u", "ü" * 200_000)], "page_id bigint, url string, html string")
    responses = warc.response_records(pages.selectExpr("*", "1 as record", "2 as record_type"))
    source = {}
    for r in responses.collect():
        fields, block = warc.parse(bytes(r.record))
        assert fields["warc-block-digest"] == warc.digest(block)
        source[r.page_id] = fields
    rows = warc.derivatives(responses).collect()
    assert collections.Counter((r.page_id, r.record_type) for r in rows) == {(1, "metadata"): 2, (1, "conversion"): 2, (2, "metadata"): 1, (2, "conversion"): 1, (3, "metadata"): 1, (3, "conversion"): 1}
    for r in rows:
        fields, block = warc.parse(bytes(r.record))
        assert bytes(r.record).endswith(b"\r\n\r\n") and block == bytes(r.block)
        assert r.refers_to == fields["warc-refers-to"] == source[r.page_id]["warc-record-id"]
        assert fields["warc-source-payload-digest"] == source[r.page_id]["warc-payload-digest"]
        assert fields["warc-block-digest"] == warc.digest(block) and fields["warc-date"] == warc.DATE
        assert {h["name"] for h in r.source_headers} == {"Content-Type", "Content-Length"}
    text = {(r.page_id, r.record_type): bytes(r.block).decode() for r in rows}
    assert text[1, "conversion"] == "A & B\nOne\ntwo <three>\nlink"
    assert "title: A & B\r\n" in text[1, "metadata"] and "outlink: /l?a=1\r\n" in text[1, "metadata"]
    assert text[2, "conversion"] == "" and text[3, "conversion"] == "ü" * 200_000


def test_other_and_broken_records_give_nothing(spark):
    plain = warc.build([("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("Content-Type", "application/http")], b"HTTP/1.1 404 No\r\nContent-Type: text/plain;\r\n charset=latin-1\r\n\r\n\xfc")
    image = warc.build([("WARC-Type", "response"), ("WARC-Record-ID", "<y>")], b"HTTP/1.1 200 OK\nContent-Type: image/png\n\n\x89PNG")
    info = warc.build([("WARC-Type", "warcinfo")], b"software: x")
    rows = [(0, plain), (1, image), (2, info), (3, b"junk"), (4, None), (5, plain[:-20]), (6, b"")]
    got = collections.Counter()
    for r in warc.derivatives(spark.createDataFrame(rows, "page_id int, record binary")).collect():
        got[r.page_id, r.record_type] += 1
        if r.record_type == "conversion":
            assert bytes(r.block).decode() == "ü"
    assert got == {(0, "metadata"): 1, (0, "conversion"): 1, (1, "metadata"): 1}


# --------------------------------------------------------------------------- hostile pages and long entities

_PLAIN_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_PLAIN_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["<a ", "<A", "<a\n", "href=", "HREF = ", '"', "'", ">", "x", " ", "<title", "<title>", "</title>", "</title ", "<p>", "</p", "<b", "=", "<abbr>", "<", "/"]), max_size=25))
def test_page_scanners_equal_single_patterns(parts):
    page = "".join(parts)
    title = _PLAIN_TITLE.search(page)
    assert warc.title_of(page) == (title and title[1])
    assert list(warc.links_of(page)) == ["".join(m) for m in _PLAIN_LINK.findall(page)]
    assert warc._without_tags(page, "\n") == warc._TAG.sub("", warc._BREAK.sub("\n", page))


@pytest.mark.parametrize("unit", ["<a ", "<title>", '<a href="', "<p ", "<!--", "</title ", "<a href "])
def test_hostile_pages_take_linear_time(spark, unit):
    def seconds(size):
        page = unit * (size // len(unit))
        started = time.process_time()
        warc.plain_text(page), list(warc.links_of(page)), warc.title_of(page)
        return time.process_time() - started

    assert seconds(4_000_000) < 60  # a quadratic scan takes hours


def test_derivatives_of_a_hostile_page(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "<title>" * 100_000 + "text" + "<a " * 100_000)], "page_id bigint, url string, html string")
    assert {r.record_type for r in warc.derivatives(warc.response_records(pages)).collect()} == {"metadata", "conversion"}


@pytest.mark.parametrize("text", ["token: " + "aZ" * 1550, "token: " + "f0" * 2000, "x" * 4000 + "@example.com", "Dr B" + "b" * 4000, "token: " + "Zq9" * 350_000])
def test_long_entities_are_replaced_whole(text):
    new, ((kind, entity, given_name),) = pii.replace_text("k", text)
    assert len(new) == len(text) and len(entity) > 3000
    at = [k for k, (a, b) in enumerate(zip(entity, given_name)) if a == b]
    assert len(at) < len(entity) / 5  # changed throughout, not at one end only
    assert pii.replace_text("k", text) == (new, [(kind, entity, given_name)])


def test_long_formats_stay_one_to_one():
    texts = ["".join(p) * 40 for p in itertools.product("abc", "abc", "01")] + [c * 60 + "q" for c in "abcdef"] + ["a" * 60 + c for c in "abcdef"]
    assert len({pii._by_format("k", "d", t) for t in texts}) == len(set(texts))
    assert all(pii._by_format("k", "d", t) != t for t in texts)


def test_entities_column_must_be_new(spark):
    with pytest.raises(ValueError, match="already has"):
        pii.replace_pii(docs_of(spark, ["a"]), entities_col="Lang")
    assert pii.replace_pii(docs_of(spark, []), entities_col="found").collect() == []
