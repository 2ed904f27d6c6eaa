"""PII surrogates: detected entities get keyed replacements of the same type and format.

Every replacement is a keyed one-to-one map on the strings of the entity's
format: digits stay digits, letters stay letters of their script and case, a
card keeps its check-digit remainder, an address stays in its network class,
a given name stays in its gender's and script's list. So

* coreference holds: an entity has one surrogate in the whole corpus,
* distinctness holds: two entities never share a surrogate,

without any table of entities, join or shuffle: texts are mapped where they
lie. The map never returns its input (it steps once along a keyed cycle
through all strings of the format). ``collisions`` checks distinctness over a
whole corpus with grouped counts.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_batches

DEFAULT_KEY = "strata-surrogates"
_ROUNDS = 8
# Characters that are permuted together: below 2**256 strings, what the rounds mix.
_CHUNK = 48
# Longer entities are not kept in the task's cache.
_CACHED = 256

_LATIN = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC = "".join(chr(c) for c in range(0x430, 0x450))
_GREEK = "".join(chr(c) for c in range(0x3B1, 0x3CA) if c != 0x3C2)
_ALPHABETS = {"latin": _LATIN, "cyrillic": _CYRILLIC, "greek": _GREEK}

# Given names by script and gender; a surrogate comes from the same list.
GIVEN_NAMES = {
    ("latin", "f"): "anna maria laura julia emma sofia clara elena marta lucia sarah claire alice ines petra nora".split(),
    ("latin", "m"): "john peter thomas martin lucas pablo david daniel paul marco hans karl louis hugo carlos jorge".split(),
    ("cyrillic", "f"): "анна мария елена ольга ирина наталья светлана татьяна".split(),
    ("cyrillic", "m"): "иван пётр сергей алексей дмитрий андрей николай михаил".split(),
    ("greek", "f"): "μαρία ελένη κατερίνα σοφία".split(),
    ("greek", "m"): "γιώργος νίκος γιάννης κώστας".split(),
}
_TITLES = (
    "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Señor|Señora|Señorita|Sr|Sra|Don|Doña|"
    "Monsieur|Madame|Mademoiselle|Mme|Mlle|Господин|Госпожа|Κύριος|Κυρία"
)

_WORD = r"[^\W\d_]"
PATTERN = re.compile(
    r"(?P<email>(?<![\w.+%-])[A-Za-z0-9](?:[\w.+%-]*[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<ipv4>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<secret>(?i:\b(?:api[_-]?key|access[_-]?key|token|secret|password|passwd)\b[\"']?\s{0,4}[:=]\s{0,4}[\"']?)(?P<value>[A-Za-z0-9_\-+/]{8,}))"
    r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,18}(?![\w]|\.\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w]|\.\d))"
    rf"|(?P<person>\b(?:{_TITLES})\b\.?[ \u00a0](?P<name>(?:{_WORD}[\w'’-]*[ \u00a0]){{0,2}}{_WORD}[\w'’-]*))"
)
# No entity without one of these.
_HINT = re.compile(rf"[@\d]|(?i:key|token|secret|passw)|\b(?:{_TITLES})\b")


def _digest(key: str, *parts: object) -> int:
    # Numbers of any size: Python writes long ones in hexadecimal only.
    named = (str(p) if not isinstance(p, int) or p.bit_length() < 10_000 else hex(p) for p in parts)
    return int.from_bytes(hashlib.blake2b("\x1f".join(named).encode(), key=hashlib.sha256(key.encode()).digest(), digest_size=16).digest(), "big")


def _permute(key: str, domain: str, x: int, size: int, back: bool = False) -> int:
    """A keyed permutation of ``range(size)`` (Feistel rounds, walking on until the result is in range)."""
    half = max(1, (max(2, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = x >> half, x & mask
        for r in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            if back:
                left, right = right ^ (_digest(key, domain, size, r, left) & mask), left
            else:
                left, right = right, left ^ (_digest(key, domain, size, r, right) & mask)
        x = left << half | right
        if x < size:
            return x


def derange(key: str, domain: str, x: int, size: int) -> int:
    """A keyed one-to-one map of ``range(size)`` that moves every number (but the only one of size 1)."""
    return _permute(key, domain, (_permute(key, domain, x, size) + 1) % size, size, back=True)


def _derange_all(key: str, domain: str, digits: list[int], bases: list[int]) -> list[int]:
    """A keyed one-to-one map of mixed-radix numbers, ``_CHUNK`` digits at a time.

    Each chunk's map depends on the chunks before it, so long strings that
    differ early differ throughout, and the cost grows with the length only.
    """
    out: list[int] = []
    for at in range(0, len(digits), _CHUNK):
        part, sizes = digits[at : at + _CHUNK], bases[at : at + _CHUNK]
        x = 0
        for d, base in zip(part, sizes):
            x = x * base + d
        x = derange(key, domain, x, math.prod(sizes))
        new = []
        for base in reversed(sizes):
            x, d = divmod(x, base)
            new.append(d)
        out += reversed(new)
        domain = f"{domain[:64]}|{_digest(key, domain, at, *part):x}"
    return out


def _script(word: str) -> str:
    name = unicodedata.name(next((c for c in word if c.isalpha()), " "), "")
    return next((s for s in _ALPHABETS if name.startswith(s.upper())), "latin")


def _by_format(key: str, domain: str, text: str, keep: int = 0) -> str:
    """Letters and digits of ``text`` replaced by others of their kind; the rest, and the first ``keep``, stay."""
    alphabets = []
    for i, c in enumerate(text):
        low = c.lower()
        kind = "0123456789" if "0" <= c <= "9" else next((a for a in _ALPHABETS.values() if low in a), None)
        alphabets.append(kind if i >= keep else None)
    changing = [(c.lower(), a) for c, a in zip(text, alphabets) if a]
    if not changing:
        return text
    # Case is carried over, so spellings in other case stay one entity.
    shape = "".join(a[0] if a else f"={c}" for c, a in zip(text, alphabets))
    new = iter(_derange_all(key, f"{domain}|{shape}", [a.index(c) for c, a in changing], [len(a) for _, a in changing]))
    return "".join((a[k].upper() if c != c.lower() else a[k]) if a and (k := next(new)) >= 0 else c for c, a in zip(text, alphabets))


def _email(key: str, text: str) -> str:
    local, _, domain = text.rpartition("@")
    labels = domain.split(".")
    # The last label names no person; the others are mapped one by one.
    return ".".join([_by_format(key, "local", local) + "@" + _by_format(key, "host", labels[0]), *(_by_format(key, "host", x) for x in labels[1:-1]), labels[-1]])


def _luhn(digits: list[int]) -> int:
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(reversed(digits))) % 10


def _card(key: str, text: str) -> str:
    """The last digit is set so that the check sum's remainder stays: valid cards stay valid, others invalid."""
    digits = [int(c) for c in text if c.isdigit()]
    x = derange(key, f"card{len(digits)}", int("".join(map(str, digits[:-1]))), 10 ** (len(digits) - 1))
    new = [int(c) for c in f"{x:0{len(digits) - 1}d}"]
    new.append((_luhn(digits) - _luhn([*new, 0])) % 10)
    fill = iter(new)
    return "".join(str(next(fill)) if c.isdigit() else c for c in text)


_NETWORKS = [ipaddress.ip_network(n) for n in ("10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.168.0.0/16")]


def _ipv4(key: str, text: str) -> str:
    x = int(ipaddress.ip_address(".".join(str(int(p)) for p in text.split("."))))
    for net in _NETWORKS:
        base = int(net.network_address)
        if 0 <= x - base < net.num_addresses:
            return str(ipaddress.ip_address(base + derange(key, str(net), x - base, net.num_addresses)))
    while True:
        x = derange(key, "ipv4", x, 1 << 32)
        if not any(0 <= x - int(n.network_address) < n.num_addresses for n in _NETWORKS):
            return str(ipaddress.ip_address(x))


_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def _secret(key: str, text: str) -> str:
    """Hexadecimal values stay so; others never become one."""
    if _HEX.fullmatch(text):
        digits = _derange_all(key, f"hex{len(text)}", [int(c, 16) for c in text], [16] * len(text))
        new = "".join(f"{d:x}" for d in digits)
        return new.upper() if text != text.lower() else new
    while True:
        text = _by_format(key, "secret", text)
        if not _HEX.fullmatch(text):
            return text


def _word(key: str, word: str) -> str:
    """A name's part: a listed given name within its list, any other by its letters."""
    low = word.lower()
    for group, names in GIVEN_NAMES.items():
        if low in names:
            new = names[derange(key, "|".join(group), names.index(low), len(names))]
            return new.upper() if word.isupper() and len(word) > 1 else new.capitalize()
    new = word
    while True:  # never onto a listed name: those are the images of listed names
        new = _by_format(key, "name", new)
        if new.lower() not in _LISTED:
            return new


_LISTED = {n for names in GIVEN_NAMES.values() for n in names}


def surrogate(key: str, kind: str, text: str) -> str:
    """The replacement of an entity of the given kind."""
    if kind == "email":
        return _email(key, text)
    if kind == "ipv4":
        return _ipv4(key, text)
    if kind == "card":
        return _card(key, text)
    if kind == "secret":
        return _secret(key, text)
    if kind == "person":
        return re.sub(rf"{_WORD}+", lambda m: _word(key, m.group()), text)
    if kind == "phone" and text.startswith("+"):
        return _by_format(key, kind, text, keep=re.match(r"\+\d+", text).end())
    return _by_format(key, kind, text)


def entities(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of each entity, from left to right."""
    if not _HINT.search(text):
        return
    for m in PATTERN.finditer(text):
        kind = m.lastgroup if m.lastgroup not in ("value", "name") else "secret" if m["secret"] else "person"
        if kind == "person":
            # The title may be followed by ordinary words: a name's parts are capitalised.
            parts = re.match(rf"(?:{_WORD}[\w'’-]*[ \u00a0]?)+", m["name"]).group().split(" ")
            count = next((i for i, p in enumerate(parts) if not p[:1].isupper()), len(parts))
            if count:
                yield kind, m.start("name"), m.start("name") + len(" ".join(parts[:count]))
        elif kind == "secret":
            yield kind, *m.span("value")
        else:
            yield kind, *m.span()


@lru_cache(maxsize=5_000)
def _cached(key: str, kind: str, text: str) -> str:
    return surrogate(key, kind, text)


def replace_text(key: str, text: str) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with its surrogates, and ``(kind, entity, surrogate)`` for each."""
    out, found, at = [], [], 0
    for kind, a, b in entities(text):
        new = (_cached if b - a <= _CACHED else surrogate)(key, kind, text[a:b])
        found.append((kind, text[a:b], new))
        out += [text[at:a], new]
        at = b
    return ("".join([*out, text[at:]]), found) if found else (text, found)


def replace_pii(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY, entities_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; with ``entities_col``, also the list of replacements.

    All other columns are kept as they are. Null texts stay null, with no
    entities; texts without entities are returned unchanged. Repeated rows
    each get the same replacements, an empty table gives an empty result, and
    texts and entities of any length are replaced whole. ``entities_col`` must
    be a new name.
    """
    columns = docs.columns
    if entities_col and entities_col.lower() in (c.lower() for c in columns):
        raise ValueError(f"docs already has a column {entities_col}")
    at = columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, lists = [], []
        for text in batch.column(at).to_pylist():
            new, found = (None, []) if text is None else replace_text(key, text)
            texts.append(new)
            lists.append([{"kind": k, "entity": e, "surrogate": s} for k, e, s in found])
        arrays = list(batch.columns)
        arrays[at] = pa.array(texts, pa.string())
        names = list(columns)
        if entities_col:
            arrays.append(pa.array(lists, pa.list_(pa.struct([("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())]))))
            names.append(entities_col)
        yield pa.RecordBatch.from_arrays(arrays, names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    if entities_col:
        schema += f", `{entities_col}` array<struct<kind: string, entity: string, surrogate: string>>"
    return map_batches(docs, run, schema, _cached.cache_clear)


def collisions(replaced: DataFrame, entities_col: str) -> DataFrame:
    """Breaches of distinctness or coreference: ``(problem, value, n)``, empty if all is well.

    ``shared``: a surrogate of two entities of a kind; ``split``: an entity
    with two surrogates; ``unchanged``: an entity that is its own surrogate
    though it has a letter or digit to change.
    """
    pairs = replaced.select(F.explode(entities_col).alias("e")).select("e.*").distinct()

    def repeats(problem: str, column: str, other: str) -> DataFrame:
        grouped = pairs.groupBy("kind", F.col(column).alias("value")).agg(F.count(other).alias("n")).where("n > 1")
        return grouped.select(F.lit(problem).alias("problem"), "value", "n")

    same = pairs.where("entity = surrogate").select(F.lit("unchanged").alias("problem"), F.col("entity").alias("value"), F.lit(1).cast("bigint").alias("n"))
    return repeats("shared", "surrogate", "entity").unionByName(repeats("split", "entity", "surrogate")).unionByName(same)
