"""The registered queries and the pipeline, on the given tables."""

from __future__ import annotations

import collections

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from strata.llm import decontam, pii, quality_lm, simhash
from strata.llm.common import table
from strata.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_text_operators import _contamination
from tests.parity import compare, duck

CONTRACTS = {
    "op1_decontamination": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op2_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op7_embedding_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op10_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op11_token_alignment": {"doc_id": "bigint", **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"), "bigint"), "groups_sha256": "string"},
    "op12_periodic_runs": {"doc_id": "bigint", **dict.fromkeys(("n_runs", "start", "length", "period", "exponent_milli"), "bigint"), "runs_sha256": "string", "collapsed_sha256": "string"},
    "op13_url_filter": {"page_id": "bigint", **dict.fromkeys(("host", "path", "rule", "verdict"), "string")},
}


def test_each_operator_has_one_query():
    numbers = collections.Counter(name.split("_")[0] for name in QUERIES)
    assert numbers == {f"op{n}": 1 for n in range(1, 14)}
    assert set(queries()) > {*QUERIES, "pipeline"} and set(oracle_sql()) > set(ORACLES)


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_queries_return_what_their_contract_says(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    types = dict(df.dtypes)
    assert {c: types.get(c) for c in CONTRACTS[name]} == CONTRACTS[name]
    source = table(spark, SF_SMALL, next((t for c, t in (("vec_id", "embeddings"), ("page_id", "pages")) if c in types), "documents"))
    assert df.count() == source.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    assert compare(spark, name, QUERIES[name], ORACLES[name], SF_SMALL, duck(SF_SMALL))["status"] == "ok"


def test_every_stage_does_its_work(spark):
    """Each stage against a plain version of it, on all that its predecessor kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "pii", "sentencepiece"]
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    def advance(k):
        nonlocal docs, rows
        before = rows
        docs = spark.createDataFrame(corpus_pipeline.STAGES[k][1](spark, docs, SF_SMALL).collect(), docs.schema) if k < 4 else corpus_pipeline.STAGES[k][1](spark, docs, SF_SMALL)
        rows = {r.doc_id: r for r in docs.collect()}
        return before

    before = advance(0)
    assert docs.columns == columns
    scores = quality_lm.quality_scores(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")).collect()
    assert {i for i in rows} == {r.doc_id for r in scores if r.accepted} and all(rows[i] == before[i] for i in rows)

    before = advance(1)
    ids = sorted(before)
    prints = [simhash.fingerprint((before[i].text or "").encode()) for i in ids]
    root = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert sorted(rows) == sorted({ids[r] for r in root}) and all(rows[i] == before[i] for i in rows)

    before = advance(2)
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    words = [(str(i), decontam.words_of(t.encode())) for i, t in items]
    automaton = decontam.SuffixAutomaton(words)
    for i, old in before.items():
        marks, _ = automaton.scan(decontam.words_of((old.text or "").encode()))
        if not marks:
            assert rows[i] == old
        elif i in rows:
            assert automaton.scan(decontam.words_of(rows[i].text.encode()))[0] is None and rows[i].n_chars == len(rows[i].text)
        else:
            assert sum(marks) > decontam.MAX_COVERAGE * len(marks)
    hit = [i for i, old in before.items() if i not in rows or rows[i].text != old.text]
    assert [bool(h) for _, h, _ in _contamination([before[i].text for i in hit[:3]], items, 10)] == [True] * len(hit[:3])

    before = advance(3)
    assert sorted(rows) == sorted(before)
    for i, old in before.items():
        found = [old.text[a:b] for _, a, b in pii.entities(old.text)]
        assert rows[i].n_chars == len(rows[i].text) and (found or rows[i] == old)
        assert not any(e in rows[i].text for e in found if len(e) > 7)

    before = advance(4)
    decoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(rows) == sorted(before)
    for i, old in before.items():
        assert all(decoder.decode(list(s.ids)) == old.text for s in rows[i].samples) and len({tuple(s.ids) for s in rows[i].samples}) == len(rows[i].samples)


def test_run_applies_all_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "samples"] and 100 < out.count() < table(spark, SF_SMALL, "documents").count()
