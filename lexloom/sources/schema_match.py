"""Similarity flooding over schema graphs, and the choice of consistent correspondences from its scores.

A schema graph has a node per column, name part, type and kind of value, and an edge from each column to what it has. Two
graphs make one graph of pairs; similarity flows along its edges until it settles.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Hashable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

#: Columns of different feeds are only joined if names, types and values alone make them at least this alike.
MIN_DIRECT = 0.4
#: Columns of one feed that were not renamed into each other are joined only if their names, or the words of their texts, are this alike.
MIN_NAMES, MIN_WORDS = 0.3, 0.5
#: Combinations of parts that are looked at together when the names of many pairs are compared.
BLOCK = 1 << 20
#: How much the overlap of a kind of value says: dates look alike everywhere, words don't.
SAYS = {"d": 0.3, "m": 0.5, "n": 0.5, "b": 0.8, "w": 1.0}


@dataclass(frozen=True)
class ColumnNode:
    """What a schema graph knows of a column: its names, and the shares of its types and of its kinds of value."""

    names: tuple[str, ...]
    kinds: Mapping[str, float] = field(default_factory=dict)
    values: Mapping[str, float] = field(default_factory=dict)

    @property
    def parts(self) -> frozenset[str]:
        return frozenset(p for n in self.names for p in n.split("_") if p)


@lru_cache(maxsize=1 << 16)
def part_likeness(a: str, b: str) -> float:
    """How alike two parts of names are: equal, one short for the other (dt for date, reg for registration), or by shared letter pairs."""
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 2 and short[0] == long[0]:
        letters = iter(long)
        if all(c in letters for c in short):
            return 0.9 if long.startswith(short) and len(short) >= 3 else 0.7
    common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(short))
    pairs = lambda s: {s[i : i + 2] for i in range(len(s) - 1)} or {s}
    x, y = pairs(a), pairs(b)
    dice = 2 * len(x & y) / (len(x) + len(y))
    return max(dice, 0.8 if common >= 4 else 0.0) * (0.95 if dice < 1 else 1)


def name_likeness(a: ColumnNode, b: ColumnNode, rarity: Callable[[str], float] = lambda part: 1.0) -> float:
    """The best likeness of two names of the columns: their parts matched, each weighted by how rare it is among all columns."""

    def one(x: str, y: str) -> float:
        px, py = [p for p in x.split("_") if p] or [x], [p for p in y.split("_") if p] or [y]
        covered = lambda own, other: sum(rarity(p) * max(part_likeness(p, q) for q in other) for p in own) / (sum(map(rarity, own)) or 1)
        return (covered(px, py) + covered(py, px)) / 2

    return max(one(x, y) for x in a.names for y in b.names)


def shared(a: Mapping[str, float], b: Mapping[str, float], says: Mapping[str, float] | None = None) -> float:
    """The overlap of two distributions, each entry weighted by what its first letter ``says``."""
    return sum(min(share, b.get(k, 0.0)) * (says.get(k[:1], 1.0) if says else 1.0) for k, share in a.items())


def flood(seeds: Mapping[Hashable, float], edges: Iterable[tuple[Hashable, Hashable, str]], *, rounds: int = 200, eps: float = 1e-4) -> dict[Hashable, float]:
    """The fixpoint of similarity flooding over a graph of pairs.

    ``seeds`` has every pair with its first similarity, ``edges`` are (pair, pair, label). In each round a pair hands its
    similarity to its neighbours, split among its edges of one label and direction, and everything is scaled to the greatest;
    it ends when nothing moves by more than ``eps``. The edges may also be a ``PairGraph``, whose seeds and scores are arrays.
    """
    if not seeds:
        return {}
    if isinstance(edges, PairGraph):
        return edges.settled(seeds, rounds, eps)
    index = {pair: i for i, pair in enumerate(seeds)}
    links = [(index[s], index[t], label) for s, t, label in edges]
    out: dict[tuple[int, str], int] = defaultdict(int)
    into: dict[tuple[int, str], int] = defaultdict(int)
    for s, t, label in links:
        out[s, label] += 1
        into[t, label] += 1
    src = np.array([s for s, _, _ in links] + [t for _, t, _ in links], int)
    dst = np.array([t for _, t, _ in links] + [s for s, _, _ in links], int)
    weight = np.array([1 / out[s, label] for s, _, label in links] + [1 / into[t, label] for _, t, label in links])
    first = np.array(list(seeds.values()), float)
    score = first.copy()
    for _ in range(rounds):
        after = first + score
        if len(links):
            after = after + np.bincount(dst, weights=weight * (first + score)[src], minlength=len(first))
        after /= after.max() or 1.0
        moved, score = np.abs(after - score).max(), after
        if moved < eps:
            break
    return dict(zip(seeds, score.tolist(), strict=True))


def column_scores(left: Sequence[ColumnNode], right: Sequence[ColumnNode], direct: Mapping[tuple[int, int], float]) -> dict[tuple[int, int], float]:
    """Flooded scores of the pairs (i, j) in ``direct``, which gives their first similarity.

    Only these pairs of columns are nodes; each is tied to the pairs of name parts, of types and of kinds of value that its
    two columns have, so the graph grows with the pairs asked for and not with the product of the schemas.
    """
    seeds: dict[Hashable, float] = {}
    edges: list[tuple[Hashable, Hashable, str]] = []
    for (i, j), likeness in direct.items():
        a, b, pair = left[i], right[j], ("column", i, j)
        seeds[pair] = likeness
        for x in sorted(a.parts):
            y, like = max(((q, part_likeness(x, q)) for q in b.parts), key=lambda m: (m[1], m[0]), default=("", 0.0))
            if like >= 0.5:
                seeds.setdefault(("part", x, y), like)
                edges.append((pair, ("part", x, y), "part"))
        for t in sorted(a.kinds.keys() & b.kinds.keys()):
            seeds.setdefault(("kind", t), 1.0)
            edges.append((pair, ("kind", t), "kind"))
        for v in sorted(a.values.keys() & b.values.keys()):
            seeds.setdefault(("value", v), 1.0)
            edges.append((pair, ("value", v), "value"))
    scores = flood(seeds, edges)
    return {(i, j): scores.get(("column", i, j), 0.0) for i, j in direct}


def rename_scores(old: Sequence[tuple[str, str]], new: Sequence[tuple[str, str]], agreement: Mapping[tuple[str, str], float]) -> dict[tuple[str, str], float]:
    """Flooded scores between two files of one feed; columns are (name, type).

    Columns of the same name stand for themselves; a gone and a fresh column are a pair where ``agreement`` (the share of
    serials for which they agree) is known and not nothing. First similarities: agreement, mixed with the likeness of the names.
    """
    left, right = [ColumnNode((n,), {k: 1.0} if k else {}) for n, k in old], [ColumnNode((n,), {k: 1.0} if k else {}) for n, k in new]
    at, to = {n: i for i, (n, _) in enumerate(old)}, {n: j for j, (n, _) in enumerate(new)}
    direct = {(at[n], to[n]): 1.0 for n in sorted(at.keys() & to.keys())}
    for (a, b), share in agreement.items():
        if share > 0 and a in at and b in to:
            direct[at[a], to[b]] = 0.7 * share + 0.3 * name_likeness(left[at[a]], right[to[b]])
    return {(old[i][0], new[j][0]): s for (i, j), s in column_scores(left, right, direct).items()}


def one_to_one(scores: Mapping[tuple[str, str], float], stands: Callable[[tuple[str, str]], bool]) -> list[tuple[str, str]]:
    """Correspondences from the best score downward, each column once; ``stands`` is the exact check of a pair."""
    used: set[tuple[int, str]] = set()
    chosen = []
    for a, b in sorted(scores, key=lambda p: (-scores[p], p)):
        if scores[a, b] > 0 and (0, a) not in used and (1, b) not in used and stands((a, b)):
            used |= {(0, a), (1, b)}
            chosen.append((a, b))
    return chosen


def _pooled(nodes: Sequence[ColumnNode], weights: Sequence[int]) -> ColumnNode:
    total = sum(weights) or 1

    def mean(of: str) -> dict[str, float]:
        out: dict[str, float] = defaultdict(float)
        for n, w in zip(nodes, weights, strict=True):
            for k, share in getattr(n, of).items():
                out[k] += share * w / total
        return dict(out)

    return ColumnNode(tuple(dict.fromkeys(x for n in nodes for x in n.names)), mean("kinds"), mean("values"))


def families(columns: Sequence[ColumnNode], n_files: Sequence[int], conflicts: Iterable[Sequence[int]], neighbours: Iterable[Sequence[int]] = ()) -> list[int]:
    """For each column of a set of schemas the number of its family: the columns that stand for the same thing.

    Two columns that one file holds both are never in one family; two that one feed holds at different times without having been
    renamed only if their names or words are alike. ``conflicts`` and ``neighbours`` have the sets of columns that a file, or
    feed, holds together, as these stand: their pairs would be many more. Columns that share a name are joined first,
    the most frequent first; then rounds of flooding over what is left: pairs of families that share a part, a type or a kind of
    value flood each other, and a pair joins if each is the other's best by score and names, types and values alone make the two
    alike (``MIN_DIRECT``). Ends when a round joins nothing.
    """
    parent = list(range(len(columns)))
    members = {i: [i] for i in parent}
    against: list[set[int]] = [set() for _ in parent]
    beside: list[set[int]] = [set() for _ in parent]
    for held, sets in ((against, conflicts), (beside, neighbours)):
        for k, columns_together in enumerate(sets):
            for i in columns_together:
                held[i].add(k)

    def join(a: int, b: int) -> None:
        for m in members[b]:
            parent[m] = a
        members[a] += members.pop(b)
        for held in (against, beside):
            held[a] |= held[b]
            held[b] = set()

    by_name: dict[str, list[int]] = defaultdict(list)
    for i, c in enumerate(columns):
        for n in c.names:
            by_name[n].append(i)
    likely = [(n_files[i] * n_files[j], i, j) for holders in by_name.values() for k, i in enumerate(sorted(holders, key=lambda h: -n_files[h])[:1]) for j in holders if j != i]
    for _, i, j in sorted(likely, key=lambda x: (-x[0], x[1], x[2])):
        a, b = parent[i], parent[j]
        if a != b and against[a].isdisjoint(against[b]):
            join(a, b)
    likeness = _Likeness(columns)
    while True:
        ids = sorted(members)
        nodes = [_pooled([columns[m] for m in members[i]], [n_files[m] for m in members[i]]) for i in ids]
        x, y, near = _pairs(nodes, [against[i] for i in ids], [beside[i] for i in ids])
        names, values, words, kinds = likeness.of(nodes, x, y)
        asked = (names >= MIN_NAMES) | (words >= MIN_WORDS) | ~near
        x, y, direct = x[asked], y[asked], (0.45 * names + 0.45 * values + 0.1 * kinds)[asked]
        graph = PairGraph(nodes, x, y, likeness)
        score = flood(graph.seeds(direct), graph).get("column", np.zeros(len(x)))
        best = np.zeros(len(ids))
        np.maximum.at(best, x, score)
        np.maximum.at(best, y, score)
        able = np.flatnonzero((score > 0) & (score >= np.maximum(best[x], best[y])) & (direct >= MIN_DIRECT))
        joined = False
        taken: set[int] = set()
        for k in able[np.lexsort((y[able], x[able], -score[able]))].tolist():
            i, j = int(x[k]), int(y[k])
            if i not in taken and j not in taken and against[ids[i]].isdisjoint(against[ids[j]]):
                join(ids[i], ids[j])
                taken |= {i, j}
                joined = True
        if not joined:
            return parent


def _pairs(nodes: Sequence[ColumnNode], against: Sequence[set[int]], beside: Sequence[set[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of columns that no file holds both, in order, and whether a feed holds both; found by lists, not by all pairs.

    Dates and numbers need a part that begins alike, with its vowels or without, flags and words may do without.
    """
    lists: dict[Hashable, list[int]] = defaultdict(list)
    bare = lambda p: p[0] + "".join(c for c in p[1:] if c not in "aeiou")[:1]
    keys = [{("part", form) for p in n.parts for form in (p[:2], bare(p))} | {("value", v) for v, share in n.values.items() if share >= 0.05 and v[:1] in "bw"} for n in nodes]
    for k, held in (("key", keys), ("against", against), ("beside", beside)):
        for i, of in enumerate(held):
            for key in of:
                lists[k, key].append(i)
    at = {key: np.array(found) for key, found in lists.items()}
    left, right, near = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, bool)]
    for i in range(len(nodes)):
        found, together = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
        for key in keys[i]:
            found[at["key", key]] = True
        for key in against[i]:
            found[at["against", key]] = False
        for key in beside[i]:
            together[at["beside", key]] = True
        later = np.flatnonzero(found[i + 1 :]) + i + 1
        left.append(np.full(len(later), i, np.int32))
        right.append(later.astype(np.int32))
        near.append(together[later])
    return np.concatenate(left), np.concatenate(right), np.concatenate(near)


class _Ragged:
    """Lists of numbers in one array."""

    def __init__(self, lists: Sequence[Sequence[int]]) -> None:
        self.n = np.array([len(of) for of in lists], np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.flat = np.array([v for of in lists for v in of], np.int64)

    def each(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All elements of the lists ``at``, and of which place in ``at`` each is."""
        n = self.n[at]
        of = np.repeat(np.arange(len(at)), n)
        return of, self.flat[np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + self.start[at][of]]


def _starts(of: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)


def _blocks(costs: np.ndarray) -> Iterable[slice]:
    """Stretches whose costs add up to about ``BLOCK``."""
    total, at = np.cumsum(costs), 0
    while at < len(costs):
        to = max(int(np.searchsorted(total, (total[at - 1] if at else 0) + BLOCK, "right")), at + 1)
        yield slice(at, to)
        at = to


class _Likeness:
    """How alike the parts of all columns' names are, worked out once, and from it how alike pairs of columns are, many at a time."""

    def __init__(self, columns: Sequence[ColumnNode]) -> None:
        split = lambda n: [p for p in n.split("_") if p] or [n]
        self.names = {n: i for i, n in enumerate(sorted({n for c in columns for n in c.names}))}
        self.parts = {p: i for i, p in enumerate(sorted({p for n in self.names for p in split(n)}))}
        self.name_parts = _Ragged([[self.parts[p] for p in split(n)] for n in self.names])
        self.tokens = {t: i for i, t in enumerate(sorted({t for c in columns for t in c.values}))}
        self.kinds = {t: i for i, t in enumerate(sorted({t for c in columns for t in c.kinds}))}
        self.says = np.array([SAYS.get(t[:1], 1.0) for t in self.tokens])
        self.is_word = np.array([t.startswith("w") for t in self.tokens], float)
        # A number for each likeness that occurs, in two bytes while these do, not the likeness itself.
        known, levels, code = list(self.parts), {}, np.zeros((len(self.parts),) * 2, np.uint16)
        compared = part_likeness.__wrapped__
        for i, p in enumerate(known):
            row = [levels.setdefault(compared(p, q), len(levels)) for q in known[i:]]
            if len(levels) > 1 << 16 and code.dtype == np.uint16:
                code = code.astype(np.uint32)
            code[i, i:] = row
            code[i:, i] = code[i, i:]
        order = sorted(levels)
        rank = np.zeros(max(len(levels), 1), code.dtype)
        for r, level in enumerate(order):
            rank[levels[level]] = r
        for i in range(len(known)):
            code[i] = rank[code[i]]
        self.code, self.levels = code, np.array(order or [0.0])

    def of(self, nodes: Sequence[ColumnNode], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair: the likeness of its names, and what its values, their words and its types share."""
        holders = np.zeros(len(self.parts))
        for n in nodes:
            for p in n.parts:
                holders[self.parts[p]] += 1
        rarity = np.where(holders > 0, np.maximum(holders, 1) ** -0.5, 1.0)
        own = _Ragged([[self.names[n] for n in node.names] for node in nodes])
        longest = int(self.name_parts.n.max(initial=1))
        names = np.zeros(len(x))
        for block in _blocks(own.n[x] * own.n[y] * longest**2):
            pair, a = own.each(x[block])
            of, b = own.each(y[block][pair])
            pair, a = pair[of], a[of]
            like = (self._covered(a, b, rarity) + self._covered(b, a, rarity)) / 2
            names[block] = np.maximum.reduceat(like, _starts(pair))
        values, words, kinds = np.zeros(len(x)), np.zeros(len(x)), np.zeros(len(x))
        for of, index, outs in (("values", self.tokens, ((values, self.says), (words, self.is_word))), ("kinds", self.kinds, ((kinds, np.ones(len(self.kinds))),))):
            shares = np.zeros((len(nodes), len(index)))
            for i, n in enumerate(nodes):
                for t, share in getattr(n, of).items():
                    shares[i, index[t]] = share
            for t in range(len(index)):
                if np.count_nonzero(shares[:, t]) < 2:
                    continue
                held = shares[:, t]
                both = np.minimum(held[x], held[y])
                for out, weight in outs:
                    if weight[t]:
                        out += both * weight[t]
        return names, values, words, kinds

    def _covered(self, a: np.ndarray, b: np.ndarray, rarity: np.ndarray) -> np.ndarray:
        """How far the names ``b`` cover the parts of the names ``a``."""
        at, p = self.name_parts.each(a)
        of, q = self.name_parts.each(b[at])
        best = self.levels[np.maximum.reduceat(self.code[p[of], q], _starts(of))] if len(of) else np.zeros(0)
        return np.bincount(at, rarity[p] * best, len(a)) / np.bincount(at, rarity[p], len(a))


class PairGraph:
    """The graph of ``column_scores`` for many pairs of one set of columns, in arrays.

    Pairs of columns with the same types, or the same kinds of value, in common are tied to the same nodes, so these edges are kept
    once for all such pairs.
    """

    def __init__(self, nodes: Sequence[ColumnNode], x: np.ndarray, y: np.ndarray, likeness: _Likeness) -> None:
        self.n_pairs = len(x)
        own = _Ragged([[likeness.parts[p] for p in sorted(n.parts)] for n in nodes])
        width, pairs, targets = len(likeness.parts), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        able = np.flatnonzero((own.n[x] > 0) & (own.n[y] > 0))
        for block in _blocks(own.n[x[able]] * own.n[y[able]]):
            at = able[block]
            pair, p = own.each(x[at])
            of, q = own.each(y[at][pair])
            best = np.maximum.reduceat(likeness.code[p[of], q].astype(np.int64) * width + q, _starts(of))
            like = likeness.levels[best // width] >= 0.5
            pairs.append(at[pair[like]])
            targets.append(p[like] * width + best[like] % width)
        self.pair = np.concatenate(pairs)
        found, self.target = np.unique(np.concatenate(targets), return_inverse=True)
        self.part_seed = likeness.levels[likeness.code[found // width, found % width]]
        self.shared = [self._in_common(nodes, x, y, of, index) for of, index in (("kinds", likeness.kinds), ("values", likeness.tokens))]

    @staticmethod
    def _in_common(nodes: Sequence[ColumnNode], x: np.ndarray, y: np.ndarray, of: str, index: Mapping[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """A number for each pair, and for each number which of the types or kinds of value such pairs have in common."""
        has = np.zeros((len(nodes), len(index)), np.uint8)
        for i, n in enumerate(nodes):
            has[i, [index[t] for t in getattr(n, of)]] = 1
        rows, row_of = np.unique(has, axis=0, return_inverse=True)
        row_of = row_of.reshape(-1).astype(np.int64)
        found, group = np.unique(row_of[x] * len(rows) + row_of[y], return_inverse=True)
        return group, rows[found // max(len(rows), 1)] & rows[found % max(len(rows), 1)]

    def seeds(self, direct: np.ndarray) -> dict[str, np.ndarray]:
        """The first similarities, by label; nothing without pairs."""
        if not self.n_pairs:
            return {}
        tied = [np.bincount(group, minlength=len(has)) @ has for group, has in self.shared]
        return {"column": direct, "part": self.part_seed, "kind": (tied[0] > 0).astype(float), "value": (tied[1] > 0).astype(float)}

    def settled(self, first: Mapping[str, np.ndarray], rounds: int, eps: float) -> dict[str, np.ndarray]:
        n_parts = np.maximum(np.bincount(self.pair, minlength=self.n_pairs), 1)
        into_part = np.maximum(np.bincount(self.target, minlength=len(self.part_seed)), 1)
        has = [h.astype(float) if h.size <= 8 * BLOCK else h for _, h in self.shared]
        n_own = [np.maximum(h.sum(1), 1)[group] for (group, _), h in zip(self.shared, has, strict=True)]
        into = [np.maximum(np.bincount(group, minlength=len(h)) @ h, 1) for (group, _), h in zip(self.shared, has, strict=True)]
        score = dict(first)
        for _ in range(rounds):
            given = {k: first[k] + score[k] for k in first}
            after = {k: v.copy() for k, v in given.items()}
            if len(self.pair):
                after["column"] += np.bincount(self.pair, (given["part"] / into_part)[self.target], self.n_pairs)
                after["part"] += np.bincount(self.target, (given["column"] / n_parts)[self.pair], len(self.part_seed))
            for k, (group, _), h, n, m in zip(("kind", "value"), self.shared, has, n_own, into, strict=True):
                after["column"] += (h @ (given[k] / m))[group]
                after[k] += np.bincount(group, given["column"] / n, len(h)) @ h
            top = max(v.max(initial=0.0) for v in after.values()) or 1.0
            after = {k: v / top for k, v in after.items()}
            moved, score = max(np.abs(after[k] - score[k]).max(initial=0.0) for k in after), after
            if moved < eps:
                break
        return score
