"""Operators against plain-Python brute force on random small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import daily_country_sales, deduplicate_latest
from strata.operators import quality as Q
from strata.schemas import GOLD_INPUT

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

gold_rows = st.lists(
    st.tuples(
        st.sampled_from(["O1", "O2", "O3", "O4", None]),
        st.sampled_from(["C1", "C2", None]),
        st.sampled_from(["IN", "US", None]),
        st.sampled_from([date(2026, 1, 1), date(2026, 1, 2), None]),
        st.one_of(st.none(), st.integers(-99_999, 99_999).map(lambda c: c / 100)),
    ),
    max_size=25,
)


def _half_up(x: Decimal) -> float:
    return float(x.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@SETTINGS
@given(gold_rows)
def test_daily_country_sales_matches_exact_decimal(spark, rows):
    got = {(r.order_date, r.country): tuple(r)[2:] for r in daily_country_sales(spark.createDataFrame(rows, GOLD_INPUT)).collect()}
    groups = defaultdict(list)
    for order_id, customer_id, country, day, amount in rows:
        groups[(day, country)].append((order_id, customer_id, amount))
    expected = {}
    for key, items in groups.items():
        amounts = [Decimal(str(a)) for _, _, a in items if a is not None]
        total = sum(amounts, Decimal(0))
        expected[key] = (
            len({o for o, _, _ in items if o is not None}),
            len({c for _, c, _ in items if c is not None}),
            _half_up(total) if amounts else None,
            _half_up(total / len(amounts)) if amounts else None,
        )
    assert got == expected


dedup_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.one_of(st.none(), st.integers(0, 3).map(lambda h: datetime(2026, 1, 1) + timedelta(hours=h))),
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 1000),
    ),
    max_size=20,
    unique_by=lambda r: r[3],
)


@SETTINGS
@given(dedup_rows)
def test_deduplicate_latest_matches_sorting(spark, rows):
    df = spark.createDataFrame(rows, "k string, ts timestamp, tie int, uid int")
    got = sorted((tuple(r) for r in deduplicate_latest(df, ["k"], "ts", tie_breakers=["tie", "uid"]).collect()), key=repr)
    best = {}
    for k, ts, tie, uid in rows:
        # greatest ts first (NULL last), then tie ascending (NULL first), then uid ascending
        rank = (ts is None, -(ts.timestamp()) if ts else 0, tie is not None, tie or 0, uid)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, ts, tie, uid))
    assert got == sorted((v for _, v in best.values()), key=repr)


keys = st.lists(st.sampled_from(["a", "b", "", " ", None]), max_size=15)


@SETTINGS
@given(keys, keys)
def test_profile_matches_counting(spark, source_keys, result_keys):
    src = spark.createDataFrame([(k,) for k in source_keys], "order_id string")
    res = spark.createDataFrame([(k,) for k in result_keys], "order_id string")
    row = Q.profile(src, res).first()
    distinct = len(set(result_keys))  # NULL counts as one key, as distinct() does
    assert (row.input_rows, row.output_rows) == (len(source_keys), len(result_keys))
    assert row.null_key_rows == sum(k is None for k in source_keys)
    assert row.duplicate_key_rows == len(result_keys) - distinct
    assert row.rejected_rows == max(len(source_keys) - len(result_keys), 0)


@SETTINGS
@given(st.lists(st.sampled_from([1, 2, 3, None]), max_size=15), st.lists(st.sampled_from([1, 2, 4, None]), max_size=15))
def test_multiset_difference_matches_counter(spark, left, right):
    lf = spark.createDataFrame([(v,) for v in left], "v int")
    rf = spark.createDataFrame([(v,) for v in right], "v int")
    got = {r.v: r.copies for r in Q.multiset_difference(lf, rf).collect()}
    assert got == dict(Counter(left) - Counter(right))


# ----------------------------------------------------------------------------- workflow markers vs a YAML parse

yaml = __import__("pytest").importorskip("yaml")

TRIGGERS = ["on: push", "on:\n  push:\n    branches: [main]", '"on": push', "'On': push", "true: x", "yes: x", "ON: push", "n: x", "onboard: x"]
PERMISSIONS = ["permissions:\n  contents: read", '"permissions": read-all', "'permissions':\n  a: b", "permissions: read-all", "permissions:", "permission: x", "env:\n  permissions: nested"]
JOBS = [
    "jobs:\n  build:\n    runs-on: x",
    "jobs: {}",
    "jobs: []",
    "jobs:",
    "jobs: null",
    "jobs: ~",
    "jobs:\n- a",
    "jobs: x",
    "jobs: 0",
    "jobs: false",
    "jobs: {a: 1}",
    "jobs:\n  # note\n\n  b: 1",
    "jobs:   # note\n  b: 1",
    "jobs: ''",
    '"jobs":\n  build:\n    runs-on: x',
    "'jobs': {}",
]
FLOW_KEYS = ["on: push", "'on': push", '"on":push', "permissions: read-all", '"permissions": {a: b}', "jobs: {a: {b: c}}", "jobs: {}", "jobs: [ ]", "jobs: {a: [{}]}", "jobs: ''"]
# Values that hold what looks like root keys, and are none.
DECOYS = [
    "name: {on: x, permissions: y, jobs: {a: b}}",
    "name: {\non: push\n, jobs: {a: b},\npermissions: x}",
    "name: [a,\n  {jobs: 1},\n  'on: x',\n]",
    "name: |\n  on: push\n  jobs: {\n\n   permissions: x",
    "name: >-\n   jobs:\n     a: b\n   don't [",
    "steps:\n  - run: |\n      {\n      jobs: \"\n    uses: x\n  - run: >2\n      '",
    "steps:\n- |\n  on: {\n- a",
    "name: \"on: x\n  jobs: y\"",
    "name: 'it''s {\n  permissions: [\n\n  on: z'",
    "name: plain {text [ with marks",
    "name: a # {",
    "if: ${{ github.ref }}",
    "list: [a, b] # on: [",
]

# At most one variant per top-level key: a repeated key is invalid for workflow
# files (a YAML loader would silently keep the last one).
documents = st.tuples(
    st.one_of(st.none(), st.sampled_from(TRIGGERS)),
    st.one_of(st.none(), st.sampled_from(PERMISSIONS)),
    st.one_of(st.none(), st.sampled_from(JOBS)),
    st.sampled_from([None, "top: CI"]),
    st.one_of(st.none(), st.sampled_from(DECOYS)),
).map(lambda parts: [p for p in parts if p is not None]).filter(bool).flatmap(st.permutations)


def _expected(text: str) -> set[str] | None:
    try:
        doc = yaml.safe_load(text)
    except yaml.YAMLError:
        return None
    if not isinstance(doc, dict):
        return None
    missing = set()
    if "on" not in doc and True not in doc:
        missing.add("missing_trigger")
    if "permissions" not in doc:
        missing.add("missing_permissions")
    if not doc.get("jobs"):
        missing.add("missing_jobs")
    return missing


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(documents, min_size=1, max_size=40))
def test_required_markers_match_a_yaml_parse(spark, docs):
    block = ["\n".join(d) + "\n" for d in docs]
    texts = [*block, *("# note\n\n" + "".join(f"   {x}\n" for x in t.splitlines()) for t in block)]
    _compare_markers(spark, texts)


flows = st.lists(st.sampled_from([*FLOW_KEYS, "name: x", "n: {on: x, jobs: {a: b}}", "n: [jobs, {permissions: x}]", "n: 'jobs: {a: b}, on: x'", 'n: "}, on: x"', "n: a:b", "n: {# on: x\n}"]), max_size=6, unique_by=lambda e: re.sub("[^a-z].*", "", e.strip("\"'"), flags=re.S))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(flows, st.sampled_from([", ", ",", "\n, ", ",\n"]), st.sampled_from(["", "# {on: x}\n", "---\n", "--- ", "  "])), min_size=1, max_size=30))
def test_required_markers_of_flow_roots_match_a_yaml_parse(spark, parts):
    _compare_markers(spark, [f"{head}{{{sep.join(entries)}}}\n" for entries, sep, head in parts])


def _compare_markers(spark, texts):
    from strata.operators import text as T

    expected = {i: _expected(t) for i, t in enumerate(texts)}
    rows = [(i, t) for i, t in enumerate(texts) if expected[i] is not None]
    if not rows:
        return
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got: dict[int, set[str]] = {i: set() for i, _ in rows}
    for r in T.required_markers(df).collect():
        got[r.doc_id].add(r.rule)
    wrong = [(t, sorted(expected[i]), sorted(got[i])) for i, t in rows if got[i] != expected[i]]
    assert not wrong, wrong[:3]


# ----------------------------------------------------------------------------- line rules vs Python re

FRAGMENTS = ["token", "password", "API_KEY", "client-secret", ":", " ", "${{", " secrets.X }}", '"', "'", "abcdefgh12", "x",
             "uses:", " actions/checkout", "@", "main", "master", "v4", "\n", "\r\n", "\r", "\t", "\u2028", "\x0c", "é", "\x1f", "\x1c"]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=14).map("".join), min_size=1, max_size=10))
def test_rule_scan_matches_python_re(spark, texts):
    import re

    from strata.operators import text as T

    expected = set()
    for i, text in enumerate(texts):
        for lineno, line in enumerate(text.splitlines(), start=1):
            for name, pattern, _ in T.LINE_RULES:
                if re.search(pattern, line):
                    expected.add((i, lineno, name))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {(r.doc_id, r.line_no, r.rule) for r in T.rule_scan(df).collect()}
    assert got == expected


# ----------------------------------------------------------------------------- clean_orders vs plain Python

raw_rows = st.lists(
    st.tuples(
        st.sampled_from(["O1", " O1 ", "O2", "\tO2", "   ", "", None]),
        st.sampled_from(["C1", " C2 ", "   ", None]),
        st.sampled_from(["P1", " P2", None]),
        st.sampled_from(["in", " US ", "\tde", None]),
        st.sampled_from([0, 1, 3, -1, None]),
        st.sampled_from([0.0, 1.25, 10.5, -2.0, None]),
        st.sampled_from([None, 0, 1, 2]).map(lambda h: None if h is None else datetime(2026, 1, 1) + timedelta(hours=h)),
    ),
    max_size=20,
)


def _trim(s):  # Spark trim: spaces only
    return None if s is None else s.strip(" ")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw_rows)
def test_clean_orders_matches_python(spark, rows):
    from strata.operators import clean_orders
    from strata.schemas import RAW_ORDERS

    kept = {}
    for order_id, customer_id, product_id, country, qty, price, ts in rows:
        oid, cid, pid = _trim(order_id), _trim(customer_id), _trim(product_id)
        ctry = None if country is None else _trim(country).upper()
        if not oid or not cid or qty is None or price is None or qty <= 0 or price <= 0:
            continue
        amount = float((Decimal(qty) * Decimal(str(price))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
        row = (oid, cid, pid, ctry, qty, price, ts, amount, None if ts is None else ts.date())
        # latest ts first (NULL last); ties: product, quantity, price, customer, country ascending, NULL first
        rank = (ts is None, -(ts.timestamp()) if ts else 0,
                pid is not None, pid or "", qty, price, cid, ctry is not None, ctry or "")
        if oid not in kept or rank < kept[oid][0]:
            kept[oid] = (rank, row)
    expected = sorted((r for _, r in kept.values()), key=repr)
    got = sorted((tuple(r) for r in clean_orders(spark.createDataFrame(rows, RAW_ORDERS)).collect()), key=repr)
    assert got == expected


# ----------------------------------------------------------------------------- redaction hit counts vs Python re

SECRET_BITS = ["token", "=", ": ", " ", "ghp_" + "a" * 20, "sk-" + "b" * 20, "dapi" + "0" * 32, "password", "x", "\n",
               "ſecret", "\xa0", "api-key", "passwd:", "\x1c", "\x1d", "\x1e", "\x1f", "\x85"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(SECRET_BITS), max_size=10).map("".join), min_size=1, max_size=8))
def test_redaction_hits_match_python(spark, texts):
    import re

    from pyspark.sql import functions as F

    from strata.operators import text as T

    expected = []
    for text in texts:
        counts = []
        for _, pattern in T.REDACTION_PATTERNS:
            counts.append(sum(1 for _ in re.finditer(pattern, text)))
            text = re.sub(pattern, T.MASK, text)
        expected.append(tuple(counts))
    hits = T.redaction_hits(F.col("t"))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(*[h.alias(n) for n, h in hits.items()]).collect()]
    assert got == expected


# ----------------------------------------------------------------------------- metrics payloads vs json.loads

JSON_BITS = ['{', '}', '"a"', '"b"', ':', ',', ' ', '1', '2.50', 'true', 'null', '"x"', '[', ']', "'a'", '{"c": 3}', '-1', '01', 'NaN', 'Infinity', '-Infinity', '"NaN"']
json_values = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), st.text("abc é", max_size=3)),
    lambda inner: st.one_of(st.lists(inner, max_size=2), st.dictionaries(st.sampled_from(["k", "l"]), inner, max_size=2)),
    max_leaves=4,
)
payloads = st.one_of(
    st.lists(st.sampled_from(JSON_BITS), max_size=8).map("".join),
    st.dictionaries(st.sampled_from(["a", "b", "stage"]), json_values, max_size=3).map(__import__("json").dumps),
)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["", "x ", "[INFO] "]), payloads, st.sampled_from(["", " ", "\t"])), min_size=1, max_size=10))
def test_extract_metrics_matches_json_loads(spark, parts):
    import json

    from strata.operators import text as T

    lines = [f"{pre}ETL_METRICS {payload}{post}" for pre, payload, post in parts]
    expected = {}
    for i, line in enumerate(lines):
        try:
            value = json.loads(line.split("ETL_METRICS ", 1)[1].strip())
        except json.JSONDecodeError:
            continue
        if isinstance(value, dict):
            expected[i] = value
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string")
    got = {r.line_id: r.metrics for r in T.extract_metrics(df).collect()}
    assert set(got) == set(expected)
    for i, value in expected.items():
        assert set(got[i]) == set(value)
        for k, v in value.items():
            text = got[i][k]
            assert (text is None and v is None) or (isinstance(v, str) and text == v) or (
                not isinstance(v, str) and json.loads(text) == v
            ), (k, v, text)


# ----------------------------------------------------------------------------- log reader vs splitlines

EXTRA_BREAKS = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.sampled_from(list("ab é\t\r\n\x0c\u2028")), max_size=30))
def test_log_lines_match_splitlines(spark, text):
    import tempfile

    from strata.sources import read_log_lines

    folder = tempfile.mkdtemp(prefix="strata-log-")
    with open(f"{folder}/run.log", "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    got = [r.line for r in read_log_lines(spark, folder).orderBy("line_pos").collect()]
    expected = text.splitlines()
    if text and text[-1] in EXTRA_BREAKS:
        expected.append("")  # documented: a file ending in one of these gets one more, empty, line
    assert got == expected
