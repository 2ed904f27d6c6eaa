"""Write docs/PLANS.md: the final (post-AQE) physical plans of the main queries.

    python tests/explain_plans.py [sf_dir]

Each query is executed once (noop sink) so the adaptive plan is final, then
its operator tree is printed with the details that matter at scale: exchange
partitioning, join strategy, partial vs final aggregation and window limits,
and the columns and filters that reach each scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = (
    "daily_country_sales",
    "clean_orders",
    "quality_profile",
    "redact_text",
    "table_diff",
    "redaction_counts",
    "rule_findings",
    "findings_verdict",
    "extract_metrics",
    "metrics_report",
)

_LINE = re.compile(r"^(?P<indent>[\s:+\-|]*)(?P<body>\S.*)$")


def _strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?", "", text)


def _condense(tree: str) -> str:
    out = []
    for line in tree.splitlines():
        m = _LINE.match(line)
        if not m:
            continue
        body = _strip_ids(re.sub(r"^\*?\(\d+\) ", "", m.group("body")))
        name = body.split(" ")[0].split("(")[0]
        if not re.fullmatch(r"[A-Z][A-Za-z]+", name):
            continue  # a continuation of a multi-line literal inside an expression
        detail = ""
        if name == "Exchange":
            part = re.search(r"(hashpartitioning\([^)]*\)|rangepartitioning\(.*?\d+\)|RoundRobinPartitioning\(\d+\)|SinglePartition)", body)
            detail = part.group(1) if part else ""
            if "REBALANCE" in body:
                detail += " rebalance"
        elif name in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin"):
            join = re.search(r"\b(Inner|LeftOuter|LeftSemi|LeftAnti)\b", body)
            side = re.search(r"\b(BuildLeft|BuildRight)\b", body)
            keys = re.search(r"\[([^\]]*)\], \[([^\]]*)\]", body)
            detail = " ".join(x for x in ((join and join.group(1)), (side and side.group(1)), (keys and f"on {keys.group(1)} = {keys.group(2)}")) if x)
        elif name == "WindowGroupLimit":
            detail = "Partial" if "Partial" in body else "Final"
        elif name == "HashAggregate":
            keys = re.search(r"keys=\[([^\]]*)\]", body)
            detail = f"keys=[{keys.group(1) if keys else ''}]" + (" partial" if "partial_" in body else "")
        elif name in ("FileScan", "Scan"):
            table = re.search(r"/([A-Za-z_]+)\.parquet", body)
            cols = re.search(r"ReadSchema: struct<([^>]*)>", body)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", body)
            detail = (table.group(1) if table else "") + (f" cols={cols.group(1).count(':')}" if cols else "")
            if pushed and pushed.group(1):
                detail += f" pushed=[{pushed.group(1)}]"
        out.append(f"{m.group('indent')}{name} {detail}".rstrip())
    return "\n".join(out)


def main(argv: list[str]) -> None:
    from __spark_entry__ import queries
    from strata.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    registry = queries()
    parts = [
        "# Physical plans (final adaptive plans)",
        "",
        f"Generated by `python tests/explain_plans.py {sf_dir}` on `local[*]`. Scans of the",
        "test tables are one split each (one parquet row group), so stage widths here are",
        "local; the shape of the plan (what is shuffled on which key, what is partial) is",
        "what holds at scale.",
        "",
    ]
    for name in QUERIES:
        df = registry[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        tree = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "```", _condense(tree), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(parts))
    print(path)


if __name__ == "__main__":
    main(sys.argv[1:])
