"""Text and log jobs over tables of documents or log lines.

All of them are per-row column expressions (regex replace/count, JSON
parsing, line splitting) that run inside the scan's stage; only the
aggregating reports shuffle, and those pre-aggregate on the map side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import python_lines, strip_whitespace
from strata.operators.structure import bound, root_block

# Credential patterns, applied in this order; every match
# becomes the mask. (name, Java regex)
REDACTION_PATTERNS: tuple[tuple[str, str], ...] = (
    ("access_token", r"(?i)\b(dapi[0-9a-f]{32,})"),
    ("git_token", r"(?i)\b(gh[pousr]_[A-Za-z0-9]{20,})"),
    ("api_key", r"(?i)\b(sk-[A-Za-z0-9\-_]{20,})"),
    ("key_value", r"(?i)(password|passwd|secret|token|api[_-]?key)\s*[:=]\s*\S+"),
)
MASK = "***REDACTED***"

# The patterns above and the line rules below are Python regexes, whose \b,
# \w, \s and (?i) are Unicode-aware. Java's are ASCII unless
# UNICODE_CHARACTER_CLASS is on, so they are applied with this flag.
PYTHON_SEMANTICS = "(?U)"


# Python's \s also has the four separators U+001C to U+001F.
_SEPARATORS = r"\x1c-\x1f"


def _py(pattern: str) -> str:
    """The Python regex as a Java one that matches the same text."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        token = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        if token == r"\s":
            token = rf"\s{_SEPARATORS}" if in_class else rf"[\s{_SEPARATORS}]"
            i += 1
        elif token == r"\S" and not in_class:
            token = rf"[^\s{_SEPARATORS}]"
            i += 1
        elif len(token) == 2:
            i += 1
        elif token == "[" and not in_class:
            in_class = True
        elif token == "]" and in_class:
            in_class = False
        out.append(token)
        i += 1
    return PYTHON_SEMANTICS + "".join(out)


# The metrics-line marker and the empty-report message.
METRICS_MARKER = "ETL_METRICS "
NO_METRICS_MESSAGE = "_No ETL_METRICS emitted by this run._"

# Workflow line rules (name, Java regex, message).
LINE_RULES: tuple[tuple[str, str, str], ...] = (
    (
        "hard_coded_secret",
        r"(?i)(password|token|api[_-]?key|client[_-]?secret)\s*:\s*(?!\s*\$\{\{)[\"']?[A-Za-z0-9/+_\-]{8,}",
        "possible hard-coded secret — use ${{ secrets.* }}",
    ),
    (
        "moving_ref",
        r"uses:\s*([^\s@]+)@(main|master)\s*$",
        "action pinned to a moving ref — pin to a version tag",
    ),
)


def _key(names: str) -> tuple[str, ...]:
    """The regex for a root key (flow roots are rewritten in block style first)."""
    return (rf"(?m)^(?:{names})[ \t]*:(?:[ \t]|$)",)


_EMPTY = r"(?:\{[ \t]*\}|\[[ \t]*\]|null|Null|NULL|~|\"\"|''|false|False|FALSE|no|No|NO|off|Off|OFF|0)"
_JOBS = r"(?:jobs|\"jobs\"|'jobs')"

# Required top-level workflow keys (name, message).
# A YAML 1.1 reader takes on/yes/true (any of their three spellings) as the
# boolean key True, which also counts as a trigger. "jobs" must also be
# non-empty: block children on the following lines (a nested mapping, or a
# sequence even at column 0), or an inline value other than the falsy ones.
# Each marker: (name, Java regexes of which one shows the key, message, Java
# regexes of which any voids it).
REQUIRED_MARKERS: tuple[tuple[str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    (
        "missing_trigger",
        _key("[\"']on[\"']|on|On|ON|yes|Yes|YES|true|True|TRUE"),
        "missing trigger (`on:`)",
        (),
    ),
    (
        "missing_permissions",
        _key("[\"']permissions[\"']|permissions"),
        "no top-level `permissions:` block (least privilege)",
        (),
    ),
    (
        "missing_jobs",
        (
            rf"(?m)^{_JOBS}[ \t]*:(?:[ \t]*(?:#[^\n]*)?\r?\n(?:[ \t]*(?:#[^\n]*)?\r?\n)*(?:[ \t]+[^\s#]|-[ \t])|[ \t]+[^\s#])",
        ),
        "no jobs defined",
        (
            rf"(?m)^{_JOBS}[ \t]*:[ \t]+{_EMPTY}[ \t]*(?:#[^\n]*)?\r?$",
            # A flow value over several lines without any content.
            rf"(?m)^{_JOBS}[ \t]*:[ \t]+[\[{{][ \t]*(?:#[^\n]*)?\r?\n(?:[ \t]*\r?\n)*+(?![ \t]+x)",
        ),
    ),
)
# The root's indentation: that of the first line with content.
_ROOT_INDENT = r"\A(?:[ \t]*(?:#[^\n]*)?\r?\n|(?:---|%)[^\n]*\n)*( +)[^\s#]"

# Text clipping limits (characters).
PROMPT_CHARS = 24_000
DIFF_CHARS = 20_000
LOG_TAIL_CHARS = 8_000


# --------------------------------------------------------------------------- redaction


def redact(text: Column, patterns: Sequence[tuple[str, str]] = REDACTION_PATTERNS) -> Column:
    """Mask every credential-shaped match, one pattern after the other."""
    for _, pattern in patterns:
        text = F.regexp_replace(text, _py(pattern), MASK)
    return text


def redaction_hits(text: Column, patterns: Sequence[tuple[str, str]] = REDACTION_PATTERNS) -> dict[str, Column]:
    """Matches masked by each pattern, counted on the text as that pattern sees it.

    Pattern ``k`` runs on the output of patterns ``1..k-1``, exactly as in
    ``redact``; the counts therefore add up to the masks in the result.
    """
    hits = {}
    for name, pattern in patterns:
        hits[name] = F.regexp_count(text, F.lit(_py(pattern)))
        text = F.regexp_replace(text, _py(pattern), MASK)
    return hits


def redact_text(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, redacted_text, redacted)`` for every row, whole texts."""
    text = F.col(text_col)
    masked = redact(text)
    return df.select(
        F.col(id_col),
        masked.alias("redacted_text"),
        (masked != text).alias("redacted"),
    )


def redaction_counts(df: DataFrame, by: Sequence[str] = ("lang", "source"), text_col: str = "text") -> DataFrame:
    """Per group: documents, documents changed, and hits per pattern (bigint)."""
    hits = redaction_hits(F.col(text_col))
    per_doc = df.select(*by, *[h.alias(f"{n}_hits") for n, h in hits.items()])
    total = sum((F.col(f"{n}_hits") for n in hits), F.lit(0))
    return per_doc.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(total > F.lit(0)).alias("redacted_documents"),
        *[F.sum(f"{n}_hits").cast("bigint").alias(f"{n}_hits") for n in hits],
    )


# --------------------------------------------------------------------------- metrics lines


def extract_metrics(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Lines carrying ``ETL_METRICS {json object}`` with the parsed ``metrics`` map.

    The payload is the text after the first marker, stripped. Payloads that
    are not exactly one JSON object are dropped (malformed lines are
    skipped, not fatal). Values are kept as JSON text
    (``map<string,string>``); for a repeated key the last value wins.

    A JSON reader stops after the first complete value and ignores what
    follows, so strictness takes two wrappers. Inside ``[...]`` the payload
    must be exactly one value (a stray ``}`` or a second value fails), and
    inside ``{"v": ...}`` it is parsed into the map (a stray ``]`` fails).
    No payload can close both wrappers early, so together they accept
    exactly what a strict parser accepts.

    The checks and the map fold into one array of 0 or 1 maps that is
    exploded: a generator is never inlined into a filter, so each payload is
    parsed once into the map (a plain filter on the parsed value would make
    Catalyst parse it again inside the pushed-down predicate).
    """
    line = F.col(line_col)
    parsed = lines.filter(line.contains(METRICS_MARKER)).withColumn("payload", _payload(line))
    return parsed.select(*lines.columns, "payload", F.explode(_parsed(F.col("payload"))).alias("metrics"))


def _payload(line: Column) -> Column:
    return strip_whitespace(_after_marker(line))


def _metric_maps(line: Column) -> Column:
    """The line's metrics as an array of one map, or an empty or NULL array."""
    none = F.array().cast("array<map<string,string>>")
    return F.when(line.contains(METRICS_MARKER), F.coalesce(_parsed(_payload(line)), none)).otherwise(none)


def _parsed(payload: Column) -> Column:
    """An array with the payload's map if it is exactly one JSON object; else empty or NULL."""
    as_field = F.from_json(
        F.concat(F.lit('{"v": '), payload, F.lit("}")),
        "struct<v:map<string,string>>",
        {"allowSingleQuotes": "false"},  # strict JSON: single-quoted strings are errors
    )
    # NaN and the infinities are JSON to Python and to the parser above, but
    # not to json_array_length, which gets zeros in their place. (A zero put
    # inside a string changes nothing about its being one.)
    finite = F.regexp_replace(payload, r"(?<=[\[,:\s])(?:NaN|-?Infinity)(?=[\s,\]}])", "0")
    one_value = F.json_array_length(F.concat(F.lit("["), finite, F.lit("]"))) == F.lit(1)
    return F.when(
        payload.startswith("{") & one_value,
        F.transform(F.filter(F.array(as_field["v"]), lambda m: m.isNotNull()), _last_values),
    )


def _last_values(parsed: Column) -> Column:
    """The parsed map with the last value of each key, and bare NaN or infinities without the parser's quotes."""
    backwards = F.reverse(F.map_keys(parsed))
    count = F.size(parsed)
    entries = F.filter(
        F.map_entries(parsed), lambda e, i: i == count - F.array_position(backwards, e["key"]).cast("int")
    )
    bare = F.array(*[F.lit(v) for v in ('"NaN"', '"Infinity"', '"-Infinity"')])
    return F.map_from_entries(
        F.transform(
            entries,
            lambda e: F.struct(
                e["key"],
                F.when(F.array_contains(bare, e["value"]), F.btrim(e["value"], F.lit('"'))).otherwise(e["value"]),
            ),
        )
    )


def _after_marker(line: Column) -> Column:
    """Text after the first marker occurrence."""
    start = F.instr(line, METRICS_MARKER) + F.lit(len(METRICS_MARKER))
    return line.substr(start, F.length(line))


def metrics_long(metrics: DataFrame, id_cols: Sequence[str] = ("line_id",)) -> DataFrame:
    """One row per ``(line, key)``: ``(id..., key, value)``."""
    return metrics.select(*id_cols, F.explode("metrics").alias("key", "value"))


def metric_keys(metrics: DataFrame) -> DataFrame:
    """All distinct keys, one row each, in order."""
    return metrics.select(F.explode(F.map_keys("metrics")).alias("key")).distinct().orderBy("key")


def key_union(metrics: DataFrame) -> list[str]:
    """The sorted union of the keys of all lines, rare ones included.

    One aggregate over the lines: each task sends each of its key sets once,
    and one row with the union comes back, as wide as the table it names.
    (A variant schema of the payloads, ``schema_of_variant_agg``, would not
    do: payloads with ``NaN`` or a repeated key are no variants.)
    """
    shapes = metrics.select(F.sort_array(F.map_keys("metrics")).alias("keys")).distinct()
    union = shapes.select(F.explode("keys").alias("key")).agg(F.sort_array(F.collect_set("key")).alias("keys"))
    return list(union.first()["keys"])


def metrics_wide(metrics: DataFrame, keys: Sequence[str] | None = None, id_cols: Sequence[str] = ("line_id",)) -> DataFrame:
    """One column per key, ``''`` where a line lacks it; all keys of all lines, in order, if none are named.

    Columns are part of the plan, so without ``keys`` the lines are read once
    more, for the union of their keys. Keys that differ only in case would be
    one column to Spark: a key whose lower-case form is taken, by an id column
    or a key before it in order, gets underscores in front until its name is
    free, so no key is lost.
    """
    if keys is None:
        keys = key_union(metrics)
    elif clash := set(keys) & set(id_cols):
        raise ValueError(f"Metric keys {sorted(clash)} collide with id columns.")
    taken = {c.lower() for c in id_cols}
    columns = []
    for key in keys:
        name = key
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        columns.append(F.coalesce(F.col("metrics")[key], F.lit("")).alias(name))
    return metrics.select(*id_cols, *columns)


def metrics_report(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """One row: ``log_lines``, ``metric_lines``, ``metric_keys`` (distinct) and ``note``.

    ``note`` is the fixed empty-report message when no line carried metrics.
    The lines are read once: each gives a row that counts it, a row that
    counts its metrics if it has any, and a row for each key.
    """
    kept = lines.select(F.col(line_col).alias("line"))
    maps = _metric_maps(F.col("line"))
    tags = F.flatten(
        F.array(
            F.array(F.struct(F.lit(0).alias("kind"), F.lit(None).cast("string").alias("key"))),
            F.flatten(
                F.transform(
                    maps,
                    lambda m: F.concat(
                        F.array(F.struct(F.lit(1).alias("kind"), F.lit(None).cast("string").alias("key"))),
                        F.transform(F.map_keys(m), lambda k: F.struct(F.lit(2).alias("kind"), k.alias("key"))),
                    ),
                )
            ),
        )
    )
    tagged = kept.select(F.explode(tags).alias("t")).select("t.*")
    counts = tagged.agg(
        F.count_if(F.col("kind") == F.lit(0)).alias("log_lines"),
        F.count_if(F.col("kind") == F.lit(1)).alias("metric_lines"),
        F.count_distinct("key").alias("metric_keys"),
    )
    return counts.withColumn("note", F.when(F.col("metric_lines") == F.lit(0), F.lit(NO_METRICS_MESSAGE)))


# --------------------------------------------------------------------------- rule scans


def rule_scan(
    docs: DataFrame,
    rules: Sequence[tuple[str, str, str]] = LINE_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, line_no, rule, message)`` for every line matching a rule.

    Lines are split like Python's ``str.splitlines()`` and numbered from 1;
    each line is tested against every rule in one pass.
    """
    lines = docs.select(F.col(id_col), F.posexplode(python_lines(F.col(text_col))).alias("pos", "line"))
    line = F.col("line")
    matched = F.filter(
        F.array(*[F.when(line.rlike(_py(rx)), F.lit(i)) for i, (_, rx, _) in enumerate(rules)]),
        lambda x: x.isNotNull(),
    )
    hits = lines.select(F.col(id_col), (F.col("pos") + F.lit(1)).alias("line_no"), F.explode(matched).alias("rule_idx"))
    return hits.select(F.col(id_col), "line_no", *_rule_labels(rules, F.col("rule_idx")))


def _with_root(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` on the text with its root in block style, and the root's indentation taken off every line."""

    def unindented(text: Column) -> Column:
        indent = F.regexp_extract(text, _ROOT_INDENT, 1)
        return F.when(indent == F.lit(""), text).otherwise(F.regexp_replace(text, F.concat(F.lit("(?m)^"), indent), F.lit("")))

    return bound(root_block(text), lambda block: bound(unindented(block), use))


def _marker_missing(text: Column, marker: tuple) -> Column:
    """``text`` is the root text."""
    _, present, _, void = marker

    def any_of(patterns: tuple[str, ...]) -> Column:
        found = F.lit(False)
        for p in patterns:
            found = found | text.rlike(p)
        return found

    return ~(any_of(present) & ~any_of(void))


def required_markers(
    docs: DataFrame,
    markers: Sequence[tuple] = REQUIRED_MARKERS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, rule, message)`` for every required marker a document lacks.

    Tested on the whole text (multi-line regex), so no line explode and no
    shuffle. Keys may be quoted, the root may be indented, and it may be a
    flow mapping. Only keys of the root count: what stands in block scalars,
    in quotations, or in flow collections at any depth is masked first (see
    ``strata.operators.structure``).
    """

    def lacks(root: Column) -> Column:
        return F.filter(F.array(*[F.when(_marker_missing(root, m), F.lit(i)) for i, m in enumerate(markers)]), lambda x: x.isNotNull())

    missing = _with_root(F.col(text_col), lacks)
    found = docs.select(F.col(id_col), F.explode(missing).alias("rule_idx"))
    return found.select(F.col(id_col), *_rule_labels(markers, F.col("rule_idx")))


def _rule_labels(rules: Sequence[tuple], idx: Column) -> list[Column]:
    names = F.array(*[F.lit(r[0]) for r in rules])
    messages = F.array(*[F.lit(r[2]) for r in rules])
    return [
        F.element_at(names, (idx + F.lit(1)).cast("int")).alias("rule"),
        F.element_at(messages, (idx + F.lit(1)).cast("int")).alias("message"),
    ]


_FINDING = "struct<line_no:int,rule_idx:int>"


def _findings(text: Column, rules: Sequence[tuple[str, str, str]], markers: Sequence[tuple]) -> Column:
    """All findings of one text as ``array<struct<line_no, rule_idx>>``.

    Line rules come from a ``transform`` over the text's lines; marker
    indexes follow the rule indexes, with a NULL line number.
    """

    def on_line(line: Column, i: Column) -> Column:
        hits = [
            F.when(line.rlike(_py(rx)), F.struct((i + F.lit(1)).alias("line_no"), F.lit(k).alias("rule_idx")))
            for k, (_, rx, _) in enumerate(rules)
        ]
        return F.filter(F.array(*hits).cast(f"array<{_FINDING}>"), lambda x: x.isNotNull())

    line_hits = F.flatten(F.transform(python_lines(text), on_line))

    def lacks(root: Column) -> Column:
        hits = [
            F.when(_marker_missing(root, m), F.struct(F.lit(None).cast("int").alias("line_no"), F.lit(len(rules) + k).alias("rule_idx")))
            for k, m in enumerate(markers)
        ]
        return F.filter(F.array(*hits).cast(f"array<{_FINDING}>"), lambda x: x.isNotNull())

    return F.concat(line_hits, _with_root(text, lacks))


def scan_findings(
    docs: DataFrame,
    rules: Sequence[tuple[str, str, str]] = LINE_RULES,
    markers: Sequence[tuple] = REQUIRED_MARKERS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Line rules and required markers in one pass over each text.

    Same rows as ``rule_findings(rule_scan(docs), required_markers(docs))``,
    but the documents are read once and one explode emits both kinds.
    """
    found = docs.select(F.col(id_col), F.explode(_findings(F.col(text_col), rules, markers)).alias("f"))
    return found.select(F.col(id_col), F.col("f.line_no").alias("line_no"), *_rule_labels(list(rules) + list(markers), F.col("f.rule_idx")))


def findings_verdict(
    docs: DataFrame,
    rules: Sequence[tuple[str, str, str]] = LINE_RULES,
    markers: Sequence[tuple] = REQUIRED_MARKERS,
    text_col: str = "text",
) -> DataFrame:
    """One row: ``documents``, ``findings``, ``documents_with_findings``, ``passed``.

    Any finding fails the check. One pass: the per-text findings array is
    sized, not exploded, then summed.
    """
    per_doc = docs.select(F.size(_findings(F.col(text_col), rules, markers)).alias("n"))
    counts = per_doc.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("findings"),
        F.count_if(F.col("n") > F.lit(0)).alias("documents_with_findings"),
    )
    return counts.withColumn("passed", F.col("findings") == F.lit(0))


def rule_findings(line_findings: DataFrame, doc_findings: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All findings in one table; ``line_no`` is NULL for document-level ones."""
    return line_findings.select(id_col, "line_no", "rule", "message").unionByName(
        doc_findings.select(id_col, F.lit(None).cast("int").alias("line_no"), "rule", "message")
    )


# --------------------------------------------------------------------------- clipping


def clip_text(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The three clips the text tools send on:

    * ``prompt_head``: first 24,000 characters of the redacted text;
    * ``diff_head`` / ``diff_truncated``: first 20,000 characters of the raw
      text and whether anything was cut;
    * ``log_tail``: last 8,000 characters of the redacted text.
    """
    text = F.col(text_col)
    masked = redact(text)
    return df.select(
        F.col(id_col),
        F.length(text).cast("bigint").alias("n_chars"),
        F.substring(masked, 1, PROMPT_CHARS).alias("prompt_head"),
        F.substring(text, 1, DIFF_CHARS).alias("diff_head"),
        (F.length(text) > F.lit(DIFF_CHARS)).alias("diff_truncated"),
        F.right(masked, F.lit(LOG_TAIL_CHARS)).alias("log_tail"),
    )
