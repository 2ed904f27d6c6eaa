"""SentencePiece encoding and decoding: Gumbel top-k segmentations without replacement.

Every text has a lattice of segmentations into the model's pieces. A piece's
log probability comes from its merge rank by Zipf's law, times ``alpha`` (an
inverse temperature); a segmentation's is the sum, normalised over the
lattice. Giving each segmentation Gumbel noise and taking the ``k`` largest
is sampling without replacement. The search finds them best first, without
listing the lattice: a set of segmentations with a common prefix has its
perturbed maximum drawn from its total mass, and is split into the sampled
segmentation and the sets that leave it at one step each, whose maxima are
drawn below the one that is known.

No piece spans the start or end of a run of letters, so a lattice is a chain
of the runs' lattices. Those are solved once each, and the best path and its
probability are kept in a bounded cache per Python worker; a text is then a
row of numbers, and only runs that leave their best path are walked.

Texts are mapped where they lie; noise is seeded by the row's key, so a task
that runs again gives the same rows.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import decode, map_batches, released, utf8

K = 2
ALPHA = 1.0
SEED = 20
CACHE = 200_000
_SPACE = "▁"
# Spaces with the letters, or the other characters, that follow.
_FIGURES = r"\d_\u00b2\u00b3\u00b9\u00bc-\u00be\u2070-\u209c\u2150-\u218b\u2460-\u249b"
_ATOM = re.compile(rf"{_SPACE}*[^\W{_FIGURES}]+|{_SPACE}*(?:[^\w{_SPACE}]|[{_FIGURES}])+|{_SPACE}+")
_SHORT = 64
_ZIPF = 2.7
_SCALE = 2.0
_BUCKET_BITS = 20
_FACTOR = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9
_CELLS = 2_000_000
_SLICE = 1_500_000


def _hash(name: str) -> int:
    h = 0
    for c in name:
        h = (h * _FACTOR + ord(c) + 1) % (1 << 64)
    return (h ^ (h >> 29)) * _MIX % (1 << 64)


class Pieces:
    """A model's pieces with their log probabilities, and bytes for characters that are no piece."""

    def __init__(self, model_file: str, alpha: float):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        sp = self.processor
        size = sp.get_piece_size()
        total = sum(1 / (r + _ZIPF) for r in range(size))

        def logp(rank: float) -> float:
            return -alpha * math.log((min(max(rank, 0.0), size) + _ZIPF) * total)

        self.table: dict[str, tuple[tuple[int, ...], float]] = {}
        self.byte_ids: dict[int, int] = {}
        for i in range(size):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.table[sp.id_to_piece(i)] = ((i,), logp(-sp.get_score(i)))
        self.byte_logp = logp(size)
        self.longest = max(map(len, self.table))
        if any(_ATOM.fullmatch(p) is None for p in self.table):
            raise ValueError("a piece spans the start or end of a run of letters: runs are no unit of this model")
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte pieces")

        # Weights e^logp, scaled by length so that products stay in range,
        # found by a hash of the characters: sorted hashes, and where each
        # value of their upper bits begins.
        names = sorted(self.table, key=_hash)
        self.hashes = np.array([_hash(n) for n in names], np.uint64)
        self.weights = np.array([math.exp(self.table[n][1] + _SCALE * len(n)) for n in names])
        upper = (self.hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        self.starts = np.searchsorted(upper, np.arange((1 << _BUCKET_BITS) + 1)).astype(np.int32)
        self.deepest = int(np.diff(self.starts).max())
        self.filled = np.diff(self.starts) > 0
        self.hashes = np.concatenate([self.hashes, np.zeros(self.deepest, np.uint64)])
        self.weights = np.concatenate([self.weights, np.zeros(self.deepest)])
        self.ids = np.array([self.table[n][0][0] for n in names] + [-1] * self.deepest, np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the hashes belong to a piece, with the pieces' weights and ids."""
        bucket = (hashes >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        places = np.flatnonzero(self.filled[bucket])  # most hashes meet an empty bucket
        wanted, at = hashes[places], self.starts[bucket[places]]
        found = np.full(len(places), -1, np.int64)
        for _ in range(self.deepest):
            hit = self.hashes[at] == wanted
            found[hit] = at[hit]
            at += 1
        hit = found >= 0
        found = found[hit]
        return places[hit], self.weights[found], self.ids[found]

    def spell(self, atom: str, cuts: Sequence[int]) -> tuple[int, ...]:
        """The ids of the path that steps to ``cuts``."""
        ids: list[int] = []
        i = 0
        for j in cuts:
            hit = self.table.get(atom[i:j])
            ids += hit[0] if hit else [self.byte_ids[c] for c in atom[i].encode("utf-8", "replace")]
            i = j
        return tuple(ids)

    def edges(self, atom: str, i: int) -> list[tuple[int, tuple[int, ...], float]]:
        """``(end, ids, log probability)`` of each piece that starts at ``i``."""
        out = []
        get = self.table.get
        for j in range(i + 1, min(len(atom), i + self.longest) + 1):
            hit = get(atom[i:j])
            if hit:
                out.append((j, *hit))
        if not out or out[0][0] != i + 1:
            raw = atom[i].encode("utf-8", "replace")
            out.append((i + 1, tuple(self.byte_ids[b] for b in raw), self.byte_logp * len(raw)))
        return out


class Solved:
    """The lattices of atoms of one length, as arrays.

    ``weight[a, i, j]`` and ``piece[a, i, j]`` (its id; -1 for bytes) belong
    to the piece from ``i`` to ``j + 1``; ``mass``
    and ``best`` are the weights of all paths to the end and of the best
    one; ``to`` is where the best one steps.
    """

    def __init__(self, pieces: Pieces, atoms: list[str]):
        n = self.length = len(atoms[0])
        codes = np.frombuffer("".join(atoms).encode("utf-32-le", "replace"), np.uint32).reshape(-1, n).astype(np.uint64)
        rows = len(codes)
        self.weight = np.zeros((rows, n, n))
        self.piece = np.full((rows, n, n), -1, np.int32)
        # All substrings of one length at once.
        h = np.zeros((rows, n), np.uint64)
        for size in range(1, min(n, pieces.longest) + 1):
            h = h[:, : n - size + 1] * np.uint64(_FACTOR) + codes[:, size - 1 :] + np.uint64(1)
            at, weights, ids = pieces.find(((h ^ (h >> np.uint64(29))) * np.uint64(_MIX)).ravel())
            a, i = np.divmod(at, n - size + 1)
            self.weight[a, i, i + size - 1] = weights
            self.piece[a, i, i + size - 1] = ids
        a, i = np.nonzero(np.diagonal(self.weight, axis1=1, axis2=2) == 0.0)
        if len(a):
            c = codes[a, i]
            size = 1 + (c >= 0x80).astype(int) + (c >= 0x800) + (c >= 0x10000)
            self.weight[a, i, i] = np.exp(pieces.byte_logp * size + _SCALE)
        self.mass, self.best = np.ones((rows, n + 1)), np.ones((rows, n + 1))
        self.to = np.zeros((rows, n), np.int64)
        for i in range(n - 1, -1, -1):
            self.mass[:, i] = (self.weight[:, i, i:] * self.mass[:, i + 1 :]).sum(axis=1)
            ways = self.weight[:, i, i:] * self.best[:, i + 1 :]
            k = ways.argmax(axis=1)
            self.best[:, i] = ways[np.arange(rows), k]
            self.to[:, i] = i + 1 + k

    def best_paths(self) -> tuple[np.ndarray, np.ndarray]:
        """The best path of each atom: its cuts, and by their first characters its pieces' ids (-2: no piece starts there)."""
        rows, n = self.to.shape
        cuts, ids = np.zeros((rows, n + 1), bool), np.full((rows, n), -2, np.int32)
        live, at = np.arange(rows), np.zeros(rows, np.int64)
        while len(live):
            end = self.to[live, at]
            ids[live, at] = self.piece[live, at, end - 1]
            cuts[live, end] = True
            on = end < n
            live, at = live[on], end[on]
        return cuts, ids

    def pick(self, rows: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The path of each row whose interval holds ``u``: cuts and ids as ``best_paths`` gives them, and its log probability.

        At every position the best path's piece comes first, so that path
        has the interval from 0 to its probability, and any path an interval
        of its probability's length.
        """
        n, count = self.length, len(rows)
        cuts, ids = np.zeros((count, n + 1), bool), np.full((count, n), -2, np.int32)
        logp = np.zeros(count)
        live, at, u = np.arange(count), np.zeros(count, np.int64), u.copy()
        while len(live):
            a, i = rows[live], at[live]
            q = self.weight[a, i] * self.mass[a, 1:] / self.mass[a, i][:, None]
            k = np.arange(len(live))
            ahead = self.to[a, i] - 1
            first = q[k, ahead]
            here = u[live]
            leaves = here >= first
            q[k, ahead] = 0.0
            below = np.cumsum(q, axis=1)
            step = np.where(leaves, (below > (here - first)[:, None]).argmax(axis=1), ahead)
            # Beyond the last interval only by rounding: the last piece there is.
            over = leaves & (below[:, -1] <= here - first)
            if over.any():
                last = n - 1 - (q[over][:, ::-1] > 0).argmax(axis=1)
                step[over] = np.where(below[over, -1] > 0, last, ahead[over])
            took_best = step == ahead
            width = np.where(took_best, first, q[k, step])
            start = np.where(took_best, 0.0, first + below[k, step] - q[k, step])
            u[live] = np.clip((here - start) / width, 0.0, 1.0)
            logp[live] += np.log(width)
            cuts[live, step + 1] = True
            ids[live, i] = self.piece[a, i, step]
            at[live] = step + 1
            live = live[step + 1 < n]
        return cuts, ids, logp


def ends_of(cuts: np.ndarray) -> tuple[int, ...]:
    return tuple(np.flatnonzero(cuts).tolist())


def joined(pieces: Pieces, atoms: Sequence[str], cuts: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows one after another, and how many each row has; ``cuts`` and ``ids`` as ``best_paths`` gives them."""
    rows = np.flatnonzero((ids == -1).any(axis=1))
    if not len(rows):
        starts = ids >= 0
        return ids[starts], starts.sum(axis=1)
    # A row with characters that are no piece is spelled by itself.
    spelled = dict(zip(rows.tolist(), (pieces.spell(atoms[r], ends_of(cuts[r])) for r in rows.tolist())))
    every = [np.array(spelled[r], np.int32) if r in spelled else row[row >= 0] for r, row in enumerate(ids)]
    return np.concatenate(every), np.fromiter(map(len, every), np.int64, len(every))


def by_length(atoms: list[str]) -> Iterator[list[int]]:
    """The atoms' places, in groups of one length and bounded size."""
    lengths = np.fromiter(map(len, atoms), np.int64, len(atoms))
    order = np.argsort(lengths, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(places):
            size = max(1, _CELLS // int(lengths[places[0]]) ** 2)
            for at in range(0, len(places), size):
                yield places[at : at + size].tolist()


class Lattice:
    """An atom's segmentations: at each position, the pieces with their conditional probabilities."""

    def __init__(self, pieces: Pieces, atom: str):
        n = len(atom)
        mass, best = [0.0] * (n + 1), [0.0] * (n + 1)
        self.steps: list[list[tuple[int, tuple[int, ...], float]]] = [[]] * n
        ways = [0.0] * n + [1.0]
        step = [0] * n
        for i in range(n - 1, -1, -1):
            found = pieces.edges(atom, i)
            logs = [lp + mass[j] for j, _, lp in found]
            top = max(logs)
            mass[i] = top + math.log(sum(math.exp(x - top) for x in logs)) if len(logs) > 1 else top
            self.steps[i] = [(j, ids, math.exp(x - mass[i])) for (j, ids, _), x in zip(found, logs)]
            reach = [lp + best[j] for j, _, lp in found]
            best[i] = max(reach)
            step[i] = reach.index(best[i])
            ways[i] = min(sum(ways[j] for j, _, _ in found), 1e300)
        self.logp_best = best[0] - mass[0]
        self.ways = ways[0]
        cuts, i = [], 0
        while i < n:
            i = self.steps[i][step[i]][0]
            cuts.append(i)
        self.best = tuple(cuts)

    def _probability(self, i: int, j: int) -> float:
        return next(q for end, _, q in self.steps[i] if end == j)

    def path_logp(self, cuts: Sequence[int]) -> float:
        return sum(math.log(self._probability(i, j)) for i, j in zip((0, *cuts), cuts))

    def sample(self, excluded: list[tuple[int, ...]], uniform) -> tuple[tuple[int, ...], float] | None:
        """A path outside ``excluded`` drawn by its probability, and that probability's logarithm."""
        # Probability, at each step, of what is left of the excluded paths.
        alive = []
        for path in excluded:
            left = [1.0]
            for i, j in reversed(list(zip((0, *path), path))):
                left.append(left[-1] * self._probability(i, j))
            alive.append((path, left[::-1]))
        i, depth, path, logp = 0, 0, [], 0.0
        while i < len(self.steps):
            here = self.steps[i]
            weights = [q for _, _, q in here]
            for p, left in alive:
                e = next(k for k, step in enumerate(here) if step[0] == p[depth])
                weights[e] -= here[e][2] * left[depth + 1]
            weights = [w if w > 1e-15 else 0.0 for w in weights]
            total = sum(weights)
            if total <= 0.0:
                return None
            u, e = uniform() * total, 0
            while e < len(weights) - 1 and (u >= weights[e] or not weights[e]):
                u -= weights[e]
                e += 1
            while not weights[e]:
                e -= 1
            alive = [(p, left) for p, left in alive if p[depth] == here[e][0]]
            path.append(here[e][0])
            logp += math.log(here[e][2])
            i = here[e][0]
            depth += 1
        return tuple(path), logp

    def pick(self, u: float) -> tuple[tuple[int, ...], float]:
        """As ``Solved.pick``, for one long atom."""
        i, cuts, logp, on_best = 0, [], 0.0, list(zip((0, *self.best), self.best))
        ahead = dict(on_best)
        while i < len(self.steps):
            here = self.steps[i]
            best = ahead.get(i, here[0][0])
            order = sorted(here, key=lambda step: step[0] != best)
            for j, _, q in order:
                if u < q:
                    break
                u -= q
            u = min(max(u / q, 0.0), 1.0)
            logp += math.log(q)
            cuts.append(j)
            i = j
        return tuple(cuts), logp


class _Numbers(dict):
    """Atom -> its number; ``names`` lists the atoms in the order in which they were first asked for."""

    def __init__(self):
        self.names: list[str] = []

    def __missing__(self, atom: str) -> int:
        number = self[atom] = len(self)
        self.names.append(atom)
        return number


class _Picks:
    """Paths drawn for a batch of texts, by number: log probabilities, ids in one array, and the cuts."""

    def __init__(self):
        self.logp, self.begin, self.count = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.cuts: list[Sequence[np.ndarray]] = []
        self.first = [0]

    def add(self, logp: np.ndarray, count: np.ndarray, ids: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
        """The numbers of the paths, whose ids stand one after another."""
        numbers = len(self.logp) + np.arange(len(logp))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(count) - count])
        self.logp, self.count = np.concatenate([self.logp, logp]), np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids])
        self.cuts.append(cuts)
        self.first.append(len(self.logp))
        return numbers

    def path(self, number: int) -> tuple[int, ...]:
        """The ends of the path's pieces."""
        group = bisect_right(self.first, number) - 1
        return ends_of(self.cuts[group][number - self.first[group]])


@dataclass
class _Text:
    """One text's search: its atoms' numbers, what is known of them, samples found and sets still queued.

    The steps of a sample that leave their best paths are two arrays, steps
    in order and the numbers of their picks.
    """

    numbers: np.ndarray
    best: np.ndarray
    single: np.ndarray
    rng: np.random.Generator
    queue: list = field(default_factory=list)
    found: list = field(default_factory=list)
    serial: int = 0


_NONE = np.zeros(0, np.int64)


def _grown(values: np.ndarray, need: int) -> np.ndarray:
    """``values``, or a copy with room for ``need``."""
    if need <= len(values):
        return values
    out = np.zeros(max(need, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


class Sampler:
    """The worker's solved atoms, and the search over texts as chains of them."""

    def __init__(self, pieces: Pieces, cache: int = CACHE):
        self.pieces, self.cache = pieces, cache
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        # Of each atom: log probability and ids of its best path, and whether it has no other.
        self.known = 0
        self.logp = np.zeros(1 << 14)
        self.single = np.zeros(1 << 14, bool)
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.ids, self.used = np.zeros(1 << 15, np.int32), 0
        self._drop()

    def _drop(self) -> None:
        """Lattices are kept for one batch only; ``place`` is an atom's group in ``solved`` plus one, and its row there."""
        self.solved: list[Solved] = []
        self.place = np.zeros((len(self.logp), 2), np.int32)

    def _learn(self) -> int:
        """Best paths of the new atoms, those of one length at a time; the longest one's length."""
        first, need = self.known, len(self.number)
        atoms = self.number.names[first:need]
        for name in ("logp", "single", "begin", "count"):
            setattr(self, name, _grown(getattr(self, name), need))
        if len(self.place) < need:
            self.place = np.zeros((len(self.logp), 2), np.int32)
        self.known = need
        for places in by_length(atoms):
            group = [atoms[p] for p in places]
            at = first + np.array(places)
            if len(group[0]) > _SHORT:
                for p, atom in zip(at.tolist(), group):
                    lattice = Lattice(self.pieces, atom)
                    self.logp[p], self.single[p] = lattice.logp_best, lattice.ways == 1
                    ids = np.array(self.pieces.spell(atom, lattice.best), np.int32)
                    self._store(np.array([p]), ids, np.array([len(ids)]))
                continue
            solved = self._keep(at, group)
            self.logp[at] = np.log(solved.best[:, 0] / solved.mass[:, 0])
            self.single[at] = solved.best[:, 0] == solved.mass[:, 0]
            self._store(at, *joined(self.pieces, group, *solved.best_paths()))
        return max(map(len, atoms), default=0)

    def _store(self, at: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """Keeps the ids of the best paths of the atoms ``at``."""
        self.ids = _grown(self.ids, self.used + len(ids))
        self.ids[self.used : self.used + len(ids)] = ids
        self.begin[at], self.count[at] = self.used + np.cumsum(count) - count, count
        self.used += len(ids)

    def _pick(self, picks: _Picks, numbers: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The path that each atom's ``u`` points to, as a number in ``picks``."""
        if not len(numbers):
            return _NONE
        out = np.zeros(len(numbers), np.int64)
        names = self.number.names
        unknown = np.unique(numbers[self.place[numbers, 0] == 0])
        for places in by_length(atoms := [names[n] for n in unknown.tolist()]):
            if len(atoms[places[0]]) <= _SHORT:
                self._keep(unknown[places], [atoms[p] for p in places])
        place, row = self.place[numbers].T
        order = np.argsort(place, kind="stable")
        for places in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            group = [names[n] for n in numbers[places].tolist()]
            if place[places[0]]:
                cuts, ids, logp = self.solved[place[places[0]] - 1].pick(row[places], u[places])
                ids, count = joined(self.pieces, group, cuts, ids)
                out[places] = picks.add(logp, count, ids, cuts)
            else:
                out[places] = self._add(picks, group, [Lattice(self.pieces, atom).pick(float(u[p])) for p, atom in zip(places.tolist(), group)])
        return out

    def _add(self, picks: _Picks, atoms: list[str], paths: list[tuple[tuple[int, ...], float]]) -> np.ndarray:
        """The numbers in ``picks`` of paths that come with their log probabilities."""
        if not atoms:
            return _NONE
        cuts, spelled = [], []
        for atom, (path, _) in zip(atoms, paths):
            cuts.append(np.zeros(len(atom) + 1, bool))
            cuts[-1][list(path)] = True
            spelled.append(self.pieces.spell(atom, path))
        count = np.fromiter(map(len, spelled), np.int64, len(spelled))
        return picks.add(np.array([logp for _, logp in paths]), count, np.fromiter(chain.from_iterable(spelled), np.int32, int(count.sum())), cuts)

    def _keep(self, numbers: np.ndarray, group: list[str]) -> Solved:
        """Solves atoms of one length and keeps their lattices until the batch is done."""
        solved = Solved(self.pieces, group)
        self.solved.append(solved)
        self.place[numbers, 0], self.place[numbers, 1] = len(self.solved), np.arange(len(group))
        return solved

    def topk(self, texts: list[str], k: int, rngs: list[np.random.Generator]) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text at most ``k`` distinct segmentations: ids, log probability, perturbed value, inclusion probability."""
        if len(self.number) > self.cache:
            self.forget()
        chains = (_ATOM.findall(_SPACE + t.replace(" ", _SPACE)) if t else [] for t in texts)
        chained = [np.array(list(map(self.number.__getitem__, atoms)), np.int64) for atoms in chains]
        longest = self._learn()
        states = []
        for numbers, rng in zip(chained, rngs):
            state = _Text(numbers, self.logp[numbers], self.single[numbers], rng)
            # A set: steps before `at` are fixed as in `base`, the paths in `without` are excluded at `at`.
            state.queue.append((-float(rng.gumbel()), 0, 0, (_NONE, _NONE), ()))
            states.append(state)
        picks = _Picks()
        for _ in range(k):
            self._round(states, k, picks)
        out: list = [[] for _ in states]
        for nth in range(k):
            some = [i for i, s in enumerate(states) if len(s.found) > nth]
            for i, ids in zip(some, self._spelled(picks, [(states[i].numbers, *states[i].found[nth][0]) for i in some])):
                s = states[i]
                _, total, value = s.found[nth]
                threshold = -s.queue[0][0] if s.queue else -math.inf
                inclusion = 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(total - threshold, 700.0)))
                out[i].append((ids, total, value, inclusion))
        self._drop()
        if longest > _SHORT:  # not worth the memory
            self.forget()
        return out

    def _spelled(self, picks: _Picks, samples: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The ids of each sample: its atoms' numbers, and the steps that leave their best paths with their picks."""
        if not samples:
            return []
        sizes = np.array([len(numbers) for numbers, _, _ in samples])
        numbers = np.concatenate([numbers for numbers, _, _ in samples])
        begin, count = self.begin[numbers], self.count[numbers]
        steps = np.concatenate([steps + base for base, (_, steps, _) in zip((np.cumsum(sizes) - sizes).tolist(), samples)])
        picked = np.concatenate([picked for _, _, picked in samples])
        begin[steps], count[steps] = self.used + picks.begin[picked], picks.count[picked]
        ends = np.cumsum(count)
        where = np.repeat(begin - (ends - count), count) + np.arange(int(count.sum()))
        ids = np.concatenate([self.ids[: self.used], picks.ids])[where]
        return np.split(ids, np.concatenate(([0], ends))[np.cumsum(sizes)[:-1]])

    def _round(self, states: list[_Text], k: int, picks: _Picks) -> None:
        """The next sample of every text that has one left."""
        work, atoms, uniforms = [], [], []
        drawn_atoms, drawn = [], []
        for s in states:
            while s.queue:
                bound, _, at, (steps, picked), without = heapq.heappop(s.queue)
                kept = int(np.searchsorted(steps, at))
                base = (steps[:kept], picked[:kept])
                excluded, free, lattice = [], at, None
                if without:
                    atom = self.number.names[s.numbers[at]]
                    lattice = Lattice(self.pieces, atom)
                    excluded = [lattice.best if p is None else p for p in without]
                    taken = lattice.sample(excluded, s.rng.random)
                    if taken is None:  # nothing but rounding errors was left
                        continue
                    drawn_atoms.append(atom)
                    drawn.append(taken)
                    free = at + 1
                u = s.rng.random(len(s.numbers) - free)
                odd = np.flatnonzero((u >= np.exp(s.best[free:])) & ~s.single[free:])
                work.append((s, -bound, at, base, excluded, lattice, odd + free))
                atoms.append(s.numbers[odd + free])
                uniforms.append(u[odd])
                break
        taken = iter(self._add(picks, drawn_atoms, drawn).tolist())
        every = self._pick(picks, np.concatenate(atoms), np.concatenate(uniforms)) if atoms else _NONE
        end = 0
        for s, value, at, (steps, picked), excluded, lattice, odd in work:
            start, end = end, end + len(odd)
            here = (np.array([at]), np.array([next(taken)])) if lattice else (_NONE, _NONE)
            chosen = (np.concatenate([steps, here[0], odd]), np.concatenate([picked, here[1], every[start:end]]))
            self._split(s, k, value, at, chosen, excluded, lattice, picks)

    def _split(self, s: _Text, k: int, value: float, at: int, chosen: tuple, excluded: list, lattice: Lattice | None, picks: _Picks) -> None:
        """Records a sample and queues the sets that leave it at one step each."""
        logps = s.best.copy()
        logps[chosen[0]] = picks.logp[chosen[1]]
        total = float(logps.sum())
        s.found.append((chosen, total, value))
        rest = -np.expm1(logps[at:])
        rest[s.single[at:]] = 0.0
        if excluded:
            gone = sum(math.exp(lattice.path_logp(p)) for p in excluded)
            rest[0] = rest[0] - gone if len(excluded) + 1 < lattice.ways else 0.0
        steps = np.flatnonzero(rest > 1e-12)
        if not len(steps):
            return
        before = np.concatenate(([0.0], np.cumsum(logps)))[at + steps]
        location = before + np.log(rest[steps])
        noise = -np.log(np.maximum(s.rng.random(len(steps)), 1e-300))
        with np.errstate(over="ignore"):
            maxima = location - np.log(np.exp(location - value) + noise)
        want = k + 1 - len(s.found)
        take = np.argpartition(-maxima, want - 1)[:want] if len(maxima) > want else np.arange(len(maxima))
        for t in take.tolist():
            step = at + int(steps[t])
            i = int(np.searchsorted(chosen[0], step))
            path = picks.path(int(chosen[1][i])) if i < len(chosen[0]) and chosen[0][i] == step else None  # None: the best one
            s.serial += 1
            heapq.heappush(s.queue, (-float(maxima[t]), s.serial, step, chosen, (*excluded, path) if step == at else (path,)))


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of texts that are solved together: ``_SLICE`` bytes and 500 texts at most, or one text."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and (i - start == 500 or held + size > _SLICE):
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


@lru_cache(maxsize=1)
def _sampler(model_file: str, alpha: float) -> Sampler:
    return Sampler(Pieces(model_file, alpha))


@lru_cache(maxsize=1)
def _processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


SAMPLE = "struct<ids: array<int>, logp: double, perturbed: double, inclusion: double>"


def sample_segmentations(
    docs: DataFrame,
    model_file: str,
    k: int = K,
    alpha: float = ALPHA,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id and ``samples``, at most ``k`` distinct segmentations, largest perturbed value first.

    Each has its ``ids``, log probability, ``perturbed`` value and
    ``inclusion``: the probability that it is among ``k`` samples, given the
    threshold that the next one would have set (1 where no other is left).

    Null and empty texts have the empty segmentation only; a text with fewer
    than ``k`` segmentations has them all. Rows that repeat id and text get
    the same samples; a null id is a key of its own. An empty table gives an
    empty result.
    """
    key = "strata_id"
    src = docs.select(F.col(id_col).alias(key), F.coalesce(F.col(id_col).cast("string"), F.lit("\0")).alias("seed"), utf8(text_col).alias("text"))
    kind = src.schema[key].dataType.simpleString()
    fields = [("ids", pa.list_(pa.int32())), ("logp", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(model_file, alpha)
        try:
            for batch in batches:
                yield from sample(sampler, batch)
        finally:
            sampler.forget()

    def sample(sampler: Sampler, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seeds, texts = batch["seed"].to_pylist(), batch["text"].to_pylist()
        for at, end in slices([len(t) for t in texts]):
            sizes, columns = [], ([np.zeros(0, np.int32)], [], [], [])
            part = [decode(t) for t in texts[at:end]]
            rngs = [np.random.Generator(np.random.Philox(key=[xxhash.xxh3_64_intdigest(name.encode(), seed), 0])) for name in seeds[at:end]]
            for samples in sampler.topk(part, k, rngs):
                sizes.append(len(samples))
                for row in samples:
                    for column, value in zip(columns, row):
                        column.append(value)
            lengths = np.cumsum([len(x) for x in columns[0]]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(columns[0])))
            structs = pa.StructArray.from_arrays([ids, *(pa.array(c, pa.float64()) for c in columns[1:])], [n for n, _ in fields])
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch[key].slice(at, end - at), pa.ListArray.from_arrays(offsets, structs)], [key, "samples"])

    out = src.mapInArrow(released(run, _sampler.cache_clear), f"{key} {kind}, samples array<{SAMPLE}>")
    return out.withColumnRenamed(key, id_col)


def decode_ids(rows: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with ``text_col`` added (or replaced): the text that the ids spell. Null ids give a null text."""
    names = [c for c in rows.columns if c != text_col]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        decoder = _processor(model_file)
        texts = [None if ids is None else decoder.decode(ids) if ids else "" for ids in batch[ids_col].to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(texts, pa.string())], [*names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text_col)
    return map_batches(rows.select(*names), run, f"{fields}, `{text_col}` string")
