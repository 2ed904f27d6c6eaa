"""Chat formatting with minimum-cost role repair.

A conversation is legal if it begins with an optional system turn and user
and assistant turns then alternate, user first. Dynamic programming over that
automaton finds the cheapest repair: a turn may be kept, given another role,
merged into the turn before, or preceded by an empty turn of the role that is
missing. The repaired sequence is rendered turn by turn; a conversation's
pieces, put together in order, are its chat text.

Scale: turns are range-partitioned by conversation and turn, so a
conversation that holds a third of all rows is spread over many tasks. Each
chunk of at most ``CHUNK`` turns is summed up as a small matrix (cheapest cost
from each state of the automaton to each other); the matrices of a
conversation that spans chunks are put together in order, which fixes the
state at each chunk's ends, and then every chunk is repaired on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch

CHUNK = 4_096
ROLES = ("system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
# States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
_FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_INFINITE = float("inf")


@dataclass(frozen=True)
class Costs:
    """What each change costs; ``guess`` is giving a role to a turn whose own is unknown."""

    merge: float = 1.0
    insert: float = 2.0
    relabel: float = 3.0
    guess: float = 1.0


@dataclass(frozen=True)
class Template:
    """How a turn is rendered; ``joint`` stands between merged texts."""

    header: str = "<|im_start|>{role}\n"
    footer: str = "<|im_end|>\n"
    joint: str = "\n\n"


def state_of(role: str | None) -> int | None:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else None


@lru_cache(maxsize=64)
def moves(role: int | None, costs: Costs) -> dict[tuple[int, int], tuple[float, str, int | None]]:
    """For a turn of ``role``: (state before, state after) -> cost, action and role inserted before it.

    Of equal costs, plain turns go before merges and merges before insertions.
    """
    out = {}
    for before in range(4):
        for after in (SYSTEM, USER, ASSISTANT):
            base = 0.0 if after == role else costs.guess if role is None else costs.relabel
            options = []
            if after in _FOLLOWS[before]:
                options.append((base, "keep" if after == role else "relabel", None))
            if after == before:
                options.append((base + costs.merge, "merge" if after == role else "relabel+merge", None))
            for extra in (SYSTEM, USER, ASSISTANT):
                if extra in _FOLLOWS[before] and after in _FOLLOWS[extra]:
                    options.append((base + costs.insert, "insert" if after == role else "relabel+insert", extra))
            if options:
                out[before, after] = min(options, key=lambda o: o[0])
    return out


def matrix(roles: list[int | None], costs: Costs) -> list[float]:
    """The cheapest costs of the turns from each state to each state, row by row."""
    rows = [[0.0 if a == b else _INFINITE for b in range(4)] for a in range(4)]
    for role in roles:
        step = moves(role, costs)
        new = [[_INFINITE] * 4 for _ in range(4)]
        for (before, after), (cost, _, _) in step.items():
            for entry in range(4):
                total = rows[entry][before] + cost
                if total < new[entry][after]:
                    new[entry][after] = total
        rows = new
    return [x for row in rows for x in row]


def repair(roles: list[int | None], costs: Costs, entry: int = START, final: int | None = None) -> list[tuple[str, int, int | None, float]]:
    """For each turn: action, role, role inserted before it, cost; of equally cheap ways the lowest states."""
    table = [[_INFINITE] * 4]
    table[0][entry] = 0.0
    back: list[list[int]] = []
    for role in roles:
        here, source = [_INFINITE] * 4, [START] * 4
        for (before, after), (cost, _, _) in sorted(moves(role, costs).items()):
            total = table[-1][before] + cost
            if total < here[after]:
                here[after], source[after] = total, before
        table.append(here)
        back.append(source)
    state = final if final is not None else min(range(4), key=lambda s: table[-1][s])
    out = []
    for role, source in zip(reversed(roles), reversed(back)):
        before = source[state]
        cost, action, extra = moves(role, costs)[before, state]
        out.append((action, state, extra, cost))
        state = before
    return out[::-1]


def render(action: str, role: int, extra: int | None, text: str, first: bool, last: bool, template: Template) -> str:
    """A turn's piece of the chat text: it closes the turn before it and, if it is the last, itself."""
    piece = ""
    if action.endswith("merge"):
        piece = template.joint
    else:
        if not first:
            piece += template.footer
        if extra is not None:
            piece += template.header.format(role=ROLES[extra - 1]) + template.footer
        piece += template.header.format(role=ROLES[role - 1])
    return piece + text + (template.footer if last else "")


def _ordered(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column, chunk: int) -> DataFrame:
    """``(conv, turn, role, text, chunk, place)`` in order, ``chunk`` numbering runs of at most that many rows."""
    src = turns.select(conv.alias("conv"), turn.alias("turn"), role.alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    src = src.withColumn("tie", F.monotonically_increasing_id())
    keys = ["conv", F.col("turn").asc_nulls_last(), "role", F.xxhash64("text"), "tie"]
    spread = src.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    placed = spread.withColumn("place", F.monotonically_increasing_id())
    # The id's upper bits number the partition, its lower 33 bits the row.
    row = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    number = F.shiftright("place", 33) * F.lit(1 << 33) + F.floor(row / chunk)
    return scratch(placed.withColumn("chunk", number.cast("bigint")), "turns")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows with the same chunk and conversation, in order."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["chunk"] != row["chunk"] or held[0]["conv"] != row["conv"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    costs: Costs = Costs(),
    template: Template = Template(),
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per turn: conversation, turn, ``position``, ``action``, ``role``, ``inserted``, ``cost``, ``rendered``.

    ``role`` is the repaired one, ``inserted`` the role of an empty turn put
    before it; the pieces ``rendered``, in order of ``position``, are the
    conversation's chat text.

    Turns are ordered by number, null numbers last; turns that share a number
    (repeated rows too) by role and text. Unknown and null roles are given
    the cheapest one; null texts count as empty; turns without a conversation
    id are one conversation. An empty table gives an empty result.
    """
    rows = _ordered(turns, F.col(conv_col), F.col(turn_col), F.col(role_col), F.col(text_col), chunk)
    conv, number = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.null()

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv").type
                yield b

        out: list[tuple] = []
        for run in _runs(seen()):
            out.append((run[0]["conv"], run[0]["chunk"], matrix([state_of(r["role"]) for r in run], costs)))
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.list_(pa.float64())))], ["conv", "chunk", "costs"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.list_(pa.float64())))], ["conv", "chunk", "costs"])

    by_chunk = rows.select("conv", "role", "chunk", "place").repartition("chunk").sortWithinPartitions("chunk", "place")
    runs = scratch(by_chunk.mapInArrow(sum_up, f"conv {conv}, chunk bigint, costs array<double>"), "runs")
    sizes = runs.groupBy(F.col("conv").alias("many")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("many")
    spanning = runs.join(sizes, F.col("conv").eqNullSafe(F.col("many")), "left_semi")

    def ends(group: pd.DataFrame) -> pd.DataFrame:
        """The states at both ends of each chunk of one conversation."""
        group = group.sort_values("chunk")
        ahead = [[0.0, _INFINITE, _INFINITE, _INFINITE]]
        for costs_ in group["costs"]:
            ahead.append([min(ahead[-1][b] + costs_[4 * b + a] for b in range(4)) for a in range(4)])
        state = min(range(4), key=lambda s: ahead[-1][s])
        found = []
        for before, costs_ in zip(reversed(ahead[:-1]), reversed(list(group["costs"]))):
            entry = min(range(4), key=lambda b: before[b] + costs_[4 * b + state])
            found.append((entry, state))
            state = entry
        found.reverse()
        return pd.DataFrame({"conv": group["conv"], "chunk": group["chunk"], "entry": [e for e, _ in found], "final": [f for _, f in found], "last": [False] * (len(found) - 1) + [True]})

    fixed = spanning.groupBy("conv").applyInPandas(ends, f"conv {conv}, chunk bigint, entry int, final int, last boolean")
    fixed = fixed.withColumnsRenamed({"conv": "fconv", "chunk": "fchunk"})
    joined = rows.join(fixed, (F.col("chunk") == F.col("fchunk")) & F.col("conv").eqNullSafe(F.col("fconv")), "left").drop("fconv", "fchunk")

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "turn", "position", "action", "role", "inserted", "cost", "rendered"]
        types: list[pa.DataType] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for b in batches:
                types[:] = [b.schema.field("conv").type, b.schema.field("turn").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.string()]
                yield b

        out: list[tuple] = []
        for run in _runs(seen()):
            entry = run[0]["entry"]
            whole = entry is None
            plan = repair([state_of(r["role"]) for r in run], costs, START if whole else entry, None if whole else run[0]["final"])
            for k, (row, (action, role, extra, cost)) in enumerate(zip(run, plan)):
                first = k == 0 and (whole or entry == START)
                last = k == len(run) - 1 and (whole or run[0]["last"])
                piece = render(action, role, extra, row["text"], first, last, template)
                out.append((row["conv"], row["turn"], row["place"], action, ROLES[role - 1], ROLES[extra - 1] if extra else None, cost, piece))
            if len(out) >= 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    shape = f"conv {conv}, turn {number}, position bigint, action string, role string, inserted string, cost double, rendered string"
    result = joined.repartition("chunk").sortWithinPartitions("chunk", "place").mapInArrow(repaired, shape)
    return result.withColumnsRenamed({"conv": conv_col, "turn": turn_col})
