"""What a YAML-like text has at its root, as column expressions.

``root_block`` rewrites a text so that its root mapping can be read line by
line: a line that starts at the root's indentation is then a root entry and
nothing else. Two folds do it:

* a root in flow style (``{on: push, jobs: {...}}``) is cut into tokens, and a
  fold over them with the depth of brackets writes each entry of the root as
  a line of its own, what is nested collapsed to ``{x}``, or ``{}`` if empty;
* a root in block style is folded over its lines, with the state that carries
  from line to line: a block scalar and the indentation that it must exceed,
  the depth of an open flow collection, an open quotation. Lines that go on
  from such a state are masked.

Only texts that need a fold take it; a pattern tells the others apart. No
text is split into rows and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOUBLE = r"\"[^\"\\]*+(?:\\.[^\"\\]*+)*+\""
_SINGLE = r"'[^']*+(?:''[^']*+)*+'"
_FLOW_START = r"(?s)\A(?:[ \t]*(?:#[^\n]*|---(?:[ \t][^\n{]*)?)?\r?\n)*(?:---[ \t]+)?[ \t]*(?=\{)"
_END = r"[\s,\[\]{}]|\z"
_STOP = r"\s\[\]{},:#"
_TOKEN = "|".join(
    (
        rf"(?s){_DOUBLE}",
        _SINGLE,
        r"(?<=\s)#[^\n]*",
        r"[\[\]{},]",
        rf":(?={_END})|(?<=[\"']):",
        r"\s+",
        rf"[^{_STOP}\"'][^{_STOP}]*+(?:(?::(?!{_END})|(?<!\s)#)[^{_STOP}]*+)*+",
        ".",
    )
)

# A value that starts with a bracket or quotation mark which its line does not
# close, or a root that is a scalar: what a root's lines can't be read without.
_VALUE = r"(?m)(?:^[ \t]*|:[ \t]+|-[ \t]+)"
_CLOSED = r"[^\[\]{}\n\"'#]*[\]}][ \t]*(?:[ \t]#[^\n]*)?\r?$"
_NEEDS_FOLD = rf"{_VALUE}(?:[\[{{](?!{_CLOSED})|\"[^\"\n]*+$|'[^'\n]*+$)|\A(?:[ \t]*(?:#[^\n]*|---)?\r?\n)*(?:---[ \t]+)?[|>]"
_KEY = rf"(?:{_DOUBLE}|{_SINGLE}|[^\s#\"'\[\]{{}}&*!|>%@`,:-][^:#]*?(?:(?::(?=\S)|(?<=\S)#)[^:#]*?)*?|-[^\s:][^:#]*?)"
_LINE = rf"^((?:-[ \t]+)*+)({_KEY}[ \t]*:(?=[ \t]|$)[ \t]*)?(.*)$"
_SCALAR = r"^(?:[!&]\S+[ \t]+)*[|>][0-9+-]*[ \t]*(?:[ \t]#.*)?$"
_QUOTED = rf"(?<![^\s\[{{,:-])(?:{_DOUBLE}|{_SINGLE})"
_COMMENT = r"(?:^|(?<=\s))#.*$"
_OPEN = r"(?<![^\s\[{,:-])([\"'])"
_MASK = "  x"
_NONE = -9


def _flow_entries(text: Column) -> Column:
    """A text whose root is a flow mapping, as one line for each of its entries."""
    body = F.regexp_replace(text, _FLOW_START, F.lit(""))
    tokens = F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0))
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(False).alias("done"),
        F.lit("").alias("entry"),
        F.array().cast("array<string>").alias("out"),
    )

    def step(s: Column, t: Column) -> Column:
        opens, closes = t.isin("{", "["), t.isin("}", "]")
        depth = s["depth"] + opens.cast("int") - closes.cast("int")
        blank = t.rlike(r"\A(?:\s+|#[^\n]*)\z")
        # Inside an entry: what stands at the root, a nested value as brackets with an x for any content.
        piece = (
            F.when(opens, F.when(s["depth"] == 1, F.lit("{")).when(s["depth"] > 1, F.lit("x")).otherwise(F.lit("")))
            .when(closes, F.when(depth == 1, F.lit("}")).otherwise(F.lit("")))
            .when(blank, F.when(s["depth"] == 1, F.lit(" ")).otherwise(F.lit("")))
            .when(s["depth"] == 1, F.when(t == ":", F.lit(": ")).otherwise(t))
            .otherwise(F.when(s["entry"].endswith("{"), F.lit("x")).otherwise(F.lit("")))
        )
        ends = (t == ",") & (s["depth"] == 1) | closes & (depth == 0)
        grown = F.concat(s["entry"], F.when(ends, F.lit("")).otherwise(piece))
        return F.when(s["done"], s).otherwise(
            F.struct(
                depth.alias("depth"),
                (closes & (depth == 0)).alias("done"),
                F.when(ends, F.lit("")).otherwise(grown).alias("entry"),
                F.when(ends, F.array_append(s["out"], F.btrim(F.regexp_replace(grown, r"\s+", F.lit(" "))))).otherwise(s["out"]).alias("out"),
            )
        )

    return F.aggregate(tokens, start, step, lambda s: F.concat(F.array_join(s["out"], "\n"), F.lit("\n")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _indent(line: Column) -> Column:
    return F.length(F.regexp_extract(line, "^ *", 0))


def _masked_lines(text: Column) -> Column:
    """A text whose root is in block style, without the root's look in lines that belong to a value."""
    lines = F.split(text, r"\r?\n")
    start = F.struct(
        F.lit(_NONE).alias("scalar"),
        F.lit(0).alias("depth"),
        F.lit("").alias("quote"),
        F.lit(True).alias("first"),
        F.array().cast("array<string>").alias("out"),
    )

    def step(s: Column, line: Column) -> Column:
        def read(l: Column) -> Column:
            blank = l["body"] == ""
            in_scalar = (s["scalar"] != _NONE) & (blank | (l["indent"] > s["scalar"]))
            # Up to the end of a quotation that is open; empty if it does not end here.
            closing = F.when(s["quote"] == '"', F.regexp_extract(l["body"], r"^[^\"\\]*+(?:\\.[^\"\\]*+)*+\"", 0)).when(
                s["quote"] == "'", F.regexp_extract(l["body"], r"^[^']*+(?:''[^']*+)*+'", 0)
            )
            return F.struct(
                l["indent"].alias("indent"),
                l["body"].alias("body"),
                blank.alias("blank"),
                in_scalar.alias("in_scalar"),
                (~in_scalar & ((s["quote"] != "") | (s["depth"] > 0))).alias("goes_on"),
                (l["body"].startswith("#") & (s["quote"] == "") | l["body"].startswith("%") & s["first"]).alias("note"),
                (s["first"] & l["body"].rlike(r"^---(?:[ \t]|$)")).alias("marker"),
                F.coalesce(closing, F.lit("")).alias("closing"),
            )

        def cut(l: Column) -> Column:
            rest = F.substring(l["body"], F.length(l["closing"]) + 1, F.length(l["body"]))
            bare = F.when(l["marker"], F.btrim(F.substring(l["body"], F.lit(4), F.length(l["body"])))).otherwise(rest)
            return F.struct(l.alias("line"), rest.alias("rest"), bare.alias("bare"))

        def part(c: Column) -> Column:
            return F.struct(c.alias("cut"), *[F.regexp_extract(c["bare"], _LINE, k).alias(n) for k, n in ((1, "dashes"), (2, "key"), (3, "value"))])

        def value_of(p: Column) -> Column:
            flow = F.when(p["cut"]["line"]["goes_on"], p["cut"]["rest"]).when(p["value"].rlike("^[\\[{\"']"), p["value"]).otherwise(F.lit(""))
            plain = F.regexp_replace(F.regexp_replace(flow, _QUOTED, F.lit("q")), _COMMENT, F.lit(""))
            return F.struct(p.alias("part"), plain.alias("plain"))

        def scan(v: Column) -> Column:
            opened = F.regexp_extract(v["plain"], _OPEN, 1)
            seen = F.when(opened == "", v["plain"]).otherwise(F.regexp_extract(v["plain"], rf"^(.*?){_OPEN}", 1))
            header = ~v["part"]["cut"]["line"]["goes_on"] & v["part"]["value"].rlike(_SCALAR)
            return F.struct(v["part"].alias("part"), v["plain"].alias("plain"), opened.alias("opened"), seen.alias("seen"), header.alias("header"))

        def after(v: Column) -> Column:
            l, key, dashes = v["part"]["cut"]["line"], v["part"]["key"], v["part"]["dashes"]
            scalar = F.when(s["first"] & (key == "") & (dashes == ""), F.lit(-1)).when(key == "", l["indent"]).otherwise(l["indent"] + F.length(dashes))
            change = F.length(F.regexp_replace(v["seen"], r"[^\[{]", F.lit(""))) - F.length(F.regexp_replace(v["seen"], r"[^\]}]", F.lit("")))
            # A quotation outside brackets is a whole value: what follows it on its line opens nothing.
            depth = F.greatest(F.lit(0), s["depth"] + F.when((s["depth"] > 0) | v["seen"].rlike(r"^[\[{]"), change).otherwise(0))
            still_open = (s["quote"] != "") & (l["closing"] == "")
            # Of a flow value, what only closes it is no content.
            hollow = (s["depth"] > 0) & (s["quote"] == "") & v["plain"].rlike(r"^[\]},\s]*$")
            kept = (
                F.when(l["blank"] | l["goes_on"] & hollow, F.lit(""))
                .when(l["in_scalar"] | l["goes_on"], F.lit(_MASK))
                .when(l["marker"] & (v["part"]["cut"]["bare"] != ""), F.concat(F.lit("--- "), v["part"]["cut"]["bare"]))
                .otherwise(line)
            )
            held = l["in_scalar"] | still_open | l["blank"] | l["note"] & ~l["goes_on"] | v["header"]
            return F.struct(
                F.when(l["in_scalar"] | l["blank"], s["scalar"]).when(v["header"] & ~l["note"], scalar).otherwise(F.lit(_NONE)).alias("scalar"),
                F.when(held, s["depth"]).otherwise(depth).alias("depth"),
                F.when(held, s["quote"]).otherwise(v["opened"]).alias("quote"),
                (s["first"] & (l["blank"] | l["note"] | l["marker"] & (v["part"]["cut"]["bare"] == ""))).alias("first"),
                F.array_append(s["out"], kept).alias("out"),
            )

        state = F.struct(_indent(line).alias("indent"), F.btrim(line).alias("body"))
        for stage in (read, cut, part, value_of, scan, after):
            state = bound(state, stage)
        return state

    return F.aggregate(lines, start, step, lambda s: F.array_join(s["out"], "\n"))


def root_block(text: Column) -> Column:
    """``text`` with its root as a block mapping that can be read line by line; see the module."""
    return F.when(text.rlike(_FLOW_START), _flow_entries(text)).when(text.rlike(_NEEDS_FOLD), _masked_lines(text)).otherwise(text)
