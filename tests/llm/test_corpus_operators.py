"""Operators that compare rows with each other, against brute force."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import chat, components, embedding_dedup, quality_lm, simhash, suffix_array, suffix_dedup
from strata.llm.common import table
from tests.conftest import SF_SMALL

DOCS = "doc_id bigint, text string, lang string"


def docs_of(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], schema)


def classes(n, linked):
    """The smallest member of each node's component, by plain union-find."""
    parent = list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --------------------------------------------------------------------------- components


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(60)] + [(500, 600 + i) for i in range(50)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), (3, None), *edges[:20]], "u bigint, v bigint")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    expect = classes(700, edges)
    assert got == {n: expect[n] for e in edges if e[0] != e[1] for n in e}
    assert components.connected_components(df.limit(0)).collect() == []


# --------------------------------------------------------------------------- SimHash


def _fingerprint(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + size]).encode(), 42) for k in range(max(1, len(words) - size + 1))] if words else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB é\t\n\x0b\xa0\x85 2")), max_size=40), st.integers(1, 4))
def test_fingerprints_follow_their_definition(text, size):
    assert simhash.fingerprint(text.encode(), size) == _fingerprint(text, size)


def _near_texts(rng):
    base = [" ".join(f"w{rng.randrange(4000)}" for _ in range(400)) for _ in range(6)]
    texts = [None, "", " \t", "One", "one", "one two"]
    for b in base:
        for _ in range(12):
            w = b.split()
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
            texts.append(" ".join(w))
    return texts + base + base[:2] * 3


@pytest.mark.parametrize("tile,hot", [(512, 50_000), (4, 3), (7, 1)])
def test_simhash_components_equal_all_pairs(spark, tile, hot):
    texts = _near_texts(random.Random(1))
    fps = [_fingerprint(t) for t in texts]
    linked = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 3]
    expect = classes(len(texts), linked)
    assert len(set(expect)) < len(set(fps))  # some classes are joined by differing fingerprints
    df = docs_of(spark, texts).selectExpr("*", "1 as fp", "2 as id", "3 as component_id")
    got = {r.doc_id: r for r in simhash.simhash_components(df, tile=tile, hot_group=hot).collect()}
    for i in range(len(texts)):
        assert (got[i].fingerprint, got[i].component_id, got[i].kept) == (f"{fps[i]:016x}", expect[i], expect[i] == i)
    kept = simhash.keep_one(df, tile=tile, hot_group=hot)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(expect))


def test_fingerprints_within_the_radius_share_a_group(spark):
    rng = random.Random(9)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(4)):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = spark.createDataFrame([(signed(x),) for p in pairs for x in p], "fp bigint").distinct()
    for hot in (50_000, 0):
        groups = collections.defaultdict(set)
        for r in simhash.grouped(fps, 3, hot).collect():
            groups[r.fp].add((r.key, r.sub))
        assert all(groups[signed(a)] & groups[signed(b)] for a, b in pairs)


def test_simhash_of_repeated_and_null_ids(spark):
    rows = [(5, "a b c d", 1), (5, "a b c d", 1), (2, "a b c d", 9), (None, "a b c d", 0), (None, "lone words stand here", 0), (7, "z", 0), (7, "quite another text", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    got = simhash.simhash_components(df).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (-1, 2, False), (2, 2, True), (5, 2, False), (5, 2, False), (7, 7, True), (7, 7, True)]
    assert sorted((r.doc_id or -1) for r in simhash.keep_one(df).collect()) == [-1, 2, 7, 7]
    assert simhash.simhash_components(df.limit(0)).collect() == [] and simhash.keep_one(df.limit(0)).collect() == []


def test_keep_one_keeps_a_row_of_every_component(spark):
    rows = [(7, "z", 0), (7, "quite another text", 1), (7, "quite another text", 2), (8, "quite another text", 3), (None, "lone words stand here", 4), (None, "and others over there", 5), (None, "z", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "and others over there"), (-1, "lone words stand here"), (7, "quite another text"), (7, "z")]


# --------------------------------------------------------------------------- embeddings


def _cosines(vectors):
    x = np.array(vectors, float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


@pytest.mark.parametrize("block,dim", [(4096, 48), (16, 48), (5, 3)])
def test_embedding_links_equal_brute_force(spark, block, dim):
    rng = np.random.default_rng(block)
    centres = rng.standard_normal((12, dim))
    vectors = [(c + rng.normal(0, s, dim)) * rng.uniform(0.1, 9) for c in centres for s in (0.02, 0.1, 0.2, 0.3) for _ in range(12)]
    vectors += [vectors[0]] * 30 + [v * 2 for v in vectors[:5]] + list(rng.standard_normal((200, dim)))
    n = len(vectors)
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [1.0] * (dim - 1) + [None], [float("inf")] + [0.0] * (dim - 1), [1.0] * (dim + 1), [2.0] * (dim + 1)]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)] + [(n + k, v, 1) for k, v in enumerate(odd)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, links int")
    got = {r.vec_id: r for r in embedding_dedup.embedding_components(df, block=block).collect()}
    near = _cosines(vectors) >= 0.9
    expect = classes(n, [(a, b) for a, b in zip(*np.nonzero(near)) if a > b])
    found = sum(got[i].n_links for i in range(n))
    assert all(got[i].n_links <= near[i].sum() - 1 for i in range(n))
    assert found >= 0.99 * (near.sum() - n)
    assert sum(got[i].component_id == expect[i] for i in range(n)) >= 0.99 * n
    assert [(got[n + k].n_links, got[n + k].component_id, got[n + k].kept) for k in range(6)] == [(0, n + k, True) for k in range(6)]
    assert (got[n + 6].n_links, got[n + 7].n_links, got[n + 7].component_id, got[n + 7].kept) == (1, 1, n + 6, False)


def test_code_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    unit = embedding_dedup.units(rng.standard_normal((400, 64)))
    errors, bounds = [], []
    for seed in range(8):
        rotated = unit @ embedding_dedup.rotation(64, seed)
        estimate, bound = embedding_dedup.estimates(rotated, *embedding_dedup.codes(rotated))
        off = ~np.eye(400, dtype=bool)
        errors.append((estimate - unit @ unit.T)[off])
        bounds.append(np.broadcast_to(bound, (400, 400))[off])
    errors, bounds = np.concatenate(errors), np.concatenate(bounds)
    assert abs(errors.mean()) < 0.002
    assert (np.abs(errors) > embedding_dedup.CONFIDENCE * bounds).mean() < 1e-5


def test_recall_on_the_given_table(spark):
    df = table(spark, SF_SMALL, "embeddings")
    rows = df.collect()
    noisy = [(10_000 + r.vec_id, [x + random.Random(r.vec_id * 1000 + k).gauss(0, 0.03) for k, x in enumerate(r.embedding)]) for r in rows]
    whole = [(r.vec_id, r.embedding) for r in rows] + noisy
    got = {r.vec_id: r.n_links for r in embedding_dedup.embedding_components(spark.createDataFrame(whole, "vec_id bigint, embedding array<float>")).collect()}
    near = (_cosines([np.array(v, np.float32) for _, v in whole]) >= 0.9).sum(axis=1) - 1
    assert near.sum() > 100 and sum(got.values()) >= 0.9 * near.sum()


def test_embeddings_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert embedding_dedup.embedding_components(df).collect() == []


# --------------------------------------------------------------------------- suffix arrays


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_is_sorted(symbols):
    assert suffix_array.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_suffix_array_of_periodic_and_long_texts():
    for symbols in ([1] * 3000, [2, 1] * 1500, [1, 2, 3, 2] * 700, list(np.random.default_rng(0).integers(1, 256, 20_000))):
        order = suffix_array.suffix_array([int(x) for x in symbols])
        raw = bytes(int(x) % 256 for x in symbols)
        assert order == sorted(range(len(raw)), key=lambda i: raw[i:])


def _removed(texts, length):
    counts = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        spans = [m.span() for m in re.finditer(rb"\x01+", bytes(marks))]
        out.append((len(t), spans, bytes(c for c, m in zip(t, marks) if not m)))
    return out


def _check_repeats(spark, texts, length, **options):
    df = docs_of(spark, texts).selectExpr("*", "1 as id", "2 as th", "3 as p")
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(df, length=length, **options).collect()}
    for i, (n, spans, kept) in enumerate(_removed([(t or "").encode() for t in texts], length)):
        assert (got[i].n_bytes, [(s.start, s.end) for s in got[i].spans], bytes(got[i].kept)) == (n, spans, kept), i


@pytest.mark.parametrize("length,options", [(7, {"group_rows": 2, "block": 10}), (8, {"group_rows": 5}), (21, {"group_rows": 1}), (12, {})])
def test_repeats_equal_brute_force_on_small_alphabets(spark, length, options):
    rng = random.Random(length)
    base = "".join(rng.choice("ab") for _ in range(60))
    parts = lambda: rng.choice([base[rng.randint(0, 50) :][: rng.randint(3, 30)], rng.choice("abcé"), "xyz"])
    texts = [None, "", "a" * 50, "ab" * 40, *("".join(parts() for _ in range(rng.randint(1, 12))) for _ in range(60))]
    _check_repeats(spark, texts, length, **options)


def test_repeats_of_passages_copies_and_boilerplate(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    line, passage, long = prose(25)[:130], prose(60), prose(400)
    texts = [prose(80) + line + prose(80) for _ in range(40)]
    texts += [prose(50) + passage + prose(50) for _ in range(10)] + [long, long, long[300:1500], passage, line, prose(4000) + long]
    _check_repeats(spark, texts, 200, group_rows=8)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)  # the candidates' list beyond its bound
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 1024)
    _check_repeats(spark, texts[30:], 200)


def test_repeats_of_repeated_and_null_ids(spark):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(300))
    rows = [(None, text), (None, text), (1, text[:250]), (1, "short"), (1, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((r.n_bytes, bytes(r.kept)) for r in got) == [(0, b""), (5, b"short"), (250, b""), (300, b""), (300, b"")]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


# --------------------------------------------------------------------------- language model


def _kneser_ney(texts, order):
    """Interpolated modified Kneser-Ney over characters, from the definitions; 0x1 pads the start."""
    alphabet = sorted({c for t in texts for c in t})
    counts = {order: collections.Counter()}
    for t in texts:
        padded = "\x01" * (order - 1) + t
        counts[order].update(padded[i : i + order] for i in range(len(t)))
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
    cuts = {}
    for k, table_ in counts.items():
        n = [sum(1 for c in table_.values() if c == x) for x in (1, 2, 3, 4)]
        if n[0] + n[1] == 0:
            cuts[k] = (0.5, 1.0, 1.5)
            continue
        y = n[0] / (n[0] + 2 * n[1])
        raw = [c - (c + 1) * y * n[c] / n[c - 1] if n[c - 1] else None for c in (1, 2, 3)]
        cuts[k] = tuple(0.5 * c if r is None else max(0.05, min(c - 0.05, r)) for c, r in zip((1, 2, 3), raw))

    followers = {k: collections.defaultdict(list) for k in counts}
    for k, table_ in counts.items():
        for g, c in table_.items():
            followers[k][g[:-1]].append(c)

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(alphabet) + 2)
        after = followers[k].get(gram[:-1])
        if not after:
            return p(gram[1:])
        d = lambda c: cuts[k][min(c, 3) - 1]
        c = counts[k].get(gram, 0)
        return ((c - d(c)) if c else 0) / sum(after) + sum(map(d, after)) / sum(after) * p(gram[1:])

    def logprob(text):
        padded = "\x01" * (order - 1) + text
        return sum(math.log(p(padded[i : i + order])) for i in range(len(text)))

    return logprob


@pytest.mark.parametrize("pack_rows", [1_000_000, 150])
def test_perplexity_equals_the_definition(spark, pack_rows):
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "cat", "sat", "on", "mat", "é", "a", "hat"])
    texts = [" ".join(word() for _ in range(rng.randint(1, 15))) for _ in range(40)] + ["zzz qq # the", "", None, "x", "a" * 900]
    rows = [(i, t, ("en", "de")[i % 2]) for i, t in enumerate(texts)] + [(900, "the cat", None), (901, "le chat", "fr"), (902, "", "fr")]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n_chars", "2 as shard", "3 as threshold")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(31, 1, 1), (33, 0, 0), (None, 1, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in quality_lm.quality_scores(docs, labels, order=3, quantile=1.0, margin=1.0, pack_rows=pack_rows, holdout=0).collect()}
    for lang in ("en", "de"):
        # The alphabet is shared by all languages; the model isn't.
        model = _kneser_ney([texts[i] for i in range(30) if rows[i][2] == lang], 3)
        limit = max(got[i].perplexity for i in range(30) if rows[i][2] == lang)
        shared = {c for t in texts[:30] for c in t}
        own = {c for i in range(30) if rows[i][2] == lang for c in texts[i]}
        assert own == shared  # so that both have the same floor
        for i, t, name in rows[: len(texts)]:
            if name != lang:
                continue
            if not t:
                assert got[i].perplexity is None and not got[i].accepted
                continue
            known = "".join(c if c in shared else "\x00" for c in t)
            assert got[i].perplexity == pytest.approx(math.exp(-model(known) / len(t)), rel=1e-9), t
            assert got[i].accepted == (got[i].perplexity <= limit)
    assert got[900].lang is None and got[900].perplexity is None and got[900].accepted and got[901].accepted and not got[902].accepted
    kept = quality_lm.keep_accepted(docs, labels, order=3, quantile=1.0, margin=1.0, pack_rows=pack_rows, holdout=0)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.accepted)


def test_quality_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality_lm.quality_scores(docs_of(spark, ["a", None, ""]), labels).collect()
    assert sorted((r.doc_id, r.accepted) for r in got) == [(0, True), (1, False), (2, False)]
    assert quality_lm.quality_scores(docs_of(spark, []), labels).collect() == []


def test_quality_accuracy_on_held_out_labels(spark):
    """Trained without a fourth of the labels, the classifier keeps the clean and rejects most of the rest of it."""
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = {r.doc_id: r for r in labels.where("pmod(hash(doc_id), 4) = 1").collect()}
    scores = quality_lm.quality_scores(docs, labels.where("pmod(hash(doc_id), 4) <> 1")).collect()
    clean = [r.accepted for r in scores if r.doc_id in held and held[r.doc_id].quality == 1]
    junk = [r.accepted for r in scores if r.doc_id in held and held[r.doc_id].quality == 0]
    assert len(clean) > 40 and sum(clean) / len(clean) >= 0.93
    assert len(junk) >= 4 and sum(junk) / len(junk) <= 0.5


def test_quality_rejects_junk_and_foreign_words(spark):
    """Kept shares of clean, junk and toxic documents without a label in training, by language."""
    sf = SF_SMALL.replace("sf0.001", "sf0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = {r.doc_id: r for r in labels.where("pmod(hash(doc_id), 4) = 1").collect()}
    kept = collections.defaultdict(list)
    for r in quality_lm.quality_scores(docs, labels.where("pmod(hash(doc_id), 4) <> 1")).where("n_chars > 0").collect():
        if r.doc_id in held:
            kept[r.lang, held[r.doc_id].quality, held[r.doc_id].toxic].append(r.accepted)
    share = {key: sum(x) / len(x) for key, x in kept.items()}
    assert all(share[lang, 1, 0] >= 0.95 for lang in ("en", "de", "es", "fr")), share
    # Only English has the documents that its stretches' limits need, and foreign words in its toxic ones.
    assert share["en", 0, 0] <= 0.1 and share["en", 1, 1] <= 0.2, share


def test_stretches_follow_their_definition():
    text = ("ab cd\u3000" + "x" * 70 + " " + "yz " * 60).encode()
    points, cost = quality_lm._points(text), np.random.default_rng(1).uniform(0.1, 9, len(text.decode()))
    words, at = [], 0
    for k in range(1, len(points) + 1):
        if k == len(points) or chr(points[k]).isspace() or k - at == quality_lm.WORD:
            words.append(cost[at:k].sum() / (k - at + 2))
            at = k
    windows = [cost[k : k + quality_lm.WINDOW].mean() for k in range(len(cost) - quality_lm.WINDOW + 1)]
    assert quality_lm.stretches(points, cost) == pytest.approx((max(words), max(windows), -min(windows)))
    assert quality_lm.stretches(points[:9], cost[:9])[1:] == (None, None)


def test_alphabets_lose_no_character(spark):
    wide = quality_lm.Alphabet([*range(0x4E00, 0x4E00 + 6000), 0x61, 0x10FFFF])
    points = np.array([0x61, 0x10FFFF, *range(0x4E00, 0x4E00 + 6000), 0x62, 0x4E00], np.uint32)
    symbols, starts = wide.symbols(points)
    parts = [tuple(x.tolist()) for x in np.split(symbols, starts[1:])]
    assert len(set(parts[:6002])) == 6002 and parts[6002] == (0,) and parts[6003] == parts[2] and symbols.max() < 1 << quality_lm.BITS
    assert all(0 not in x and 1 not in x for x in parts[:6002]) and {len(x) for x in parts[:6002]} == {1, 2}
    # A large language beside it changes nothing for a small one.
    rng = random.Random(6)
    small = [(i, "".join(rng.choice("ωψχφυ ") for _ in range(60)), "el") for i in range(12)]
    large = [(100 + i, "".join(chr(0x4E00 + (700 * i + k) % 5000) for k in range(1400)), "zh") for i in range(8)]
    got = []
    for rows in (small, small + large):
        labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id bigint, quality int, toxic int")
        scores = quality_lm.quality_scores(spark.createDataFrame(rows, DOCS), labels, pack_rows=2_000).collect()
        got.append({r.doc_id: r.perplexity for r in scores if r.lang == "el"})
        assert all(r.perplexity > 1 for r in scores)
    assert got[0] == pytest.approx(got[1])


# --------------------------------------------------------------------------- chat


def _cheapest(roles, costs):
    best = {chat.START: 0.0}
    for role in roles:
        new = {}
        for before, total in best.items():
            for after in (chat.SYSTEM, chat.USER, chat.ASSISTANT):
                base = total + (0 if after == role else costs.guess if role is None else costs.relabel)
                follows = chat._FOLLOWS
                options = [base] * (after in follows[before]) + [base + costs.merge] * (after == before)
                options += [base + costs.insert for x in (1, 2, 3) if x in follows[before] and after in follows[x]]
                new[after] = min([new.get(after, math.inf), *options])
        best = new
    return min(best.values())


@pytest.mark.parametrize("chunk", [3, 7, 4096])
def test_repairs_are_cheapest_and_legal(spark, chunk):
    rng = random.Random(3)
    names = [None, "", "system", "user", "assistant", "tool", "Human", "GPT "]
    rows = []
    for c in range(30):
        rows += [(c or None, t, rng.choice(names), rng.choice([None, "", "x y", f"t{t}"])) for t in range(rng.choice((1, 2, 3, 5, 9, 30)))]
    rows += [(99, t, rng.choice(names), f"h{t}" * 9) for t in range(400)]  # most of all rows
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as conv", "2 as chunk", "3 as position")
    got = sorted(chat.format_chats(df, chunk=chunk).collect(), key=lambda r: r.position)
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.conv_id].append(r)
    for conv, turns in by.items():
        source = sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])
        assert [t.turn for t in turns] == [x[1] for x in source]
        assert sum(t.cost for t in turns) == pytest.approx(_cheapest([chat.state_of(x[2]) for x in source], chat.Costs()))
        text = "".join(t.rendered for t in turns)
        parts = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.S)
        assert "".join(f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in parts) == text
        state = chat.START
        for role, _ in parts:
            after = chat.ROLES.index(role) + 1
            assert after in chat._FOLLOWS[state]
            state = after
        assert all((x[3] or "") in text for x in source)


def test_legal_conversations_stay_and_ties_are_ordered(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "q"), (2, 0, "user", "q"), (2, None, "assistant", "z"), (2, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = sorted(chat.format_chats(df).collect(), key=lambda r: r.position)
    assert [(r.action, r.cost) for r in got if r.conv_id == 1] == [("keep", 0.0)] * 3
    assert [(r.turn, r.action) for r in got if r.conv_id == 2] == [(0, "keep"), (0, "merge"), (1, "keep"), (None, "merge")]
    assert chat.format_chats(df.limit(0)).collect() == []
