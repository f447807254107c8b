"""Evaluation passages inside training documents: suffix arrays over the training text, searched for every test suffix."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.session import broadcast_if_small, materialise, ship

WORD = re.compile(r"[^\W_]+")
#: Characters of text per shard; bounds a worker's memory, a longer document is a shard of its own.
SHARD_CHARS = 4_000_000
#: Characters of evaluation items held by a worker at a time; more are searched for in blocks of this size, one after another.
ITEM_CHARS = 8_000_000
#: Hits of one step of a search; an item with more is a step of its own.
STEP_HITS = 1_000_000
#: Items that hold a run of words more often than this are matched by an automaton: as an array, their hits would grow as a product.
MAX_SAME = 4

COLUMNS = {"doc_id": "bigint", "item_id": "bigint", "longest_words": "int", "n_places": "int", "at_word": "int"}
FOUND = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())


def words(text: str | None) -> list[str]:
    """The longest runs of letters and digits, lower case."""
    found = WORD.findall(text) if text else []
    return "\n".join(found).lower().split("\n") if found else []


class TestSuffixes:
    """The suffixes of the evaluation items, at least ``min_words`` long, as word numbers; items of one text share theirs.

    Word numbers start at 2; 1 is any word no item has, 0 the gap between texts.
    """

    __test__ = False

    def __init__(self, items: Sequence[tuple[int, str | None]], min_words: int) -> None:
        self.min_words = min_words
        self.vocabulary: dict[str, int] = {}
        texts: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.texts: list[np.ndarray] = []
        for item_id, text in items:
            split = words(text)
            if item_id is not None and len(split) >= min_words:
                numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in split], np.uint32)
                at = texts.setdefault(numbers.tobytes(), len(self.texts))
                if at == len(self.texts):  # items of one text are searched for once
                    self.texts.append(numbers)
                    self.ids.append([])
                self.ids[at].append(item_id)
        self.bits = max(1, int(len(self.vocabulary) + 1).bit_length())
        counts = [len(t) - min_words + 1 for t in self.texts]
        self.item = np.repeat(np.arange(len(counts)), counts)
        self.offset = np.concatenate([np.arange(n) for n in counts]) if counts else np.zeros(0, int)
        self.keys = [np.concatenate(k) for k in zip(*[self.pack(t, np.arange(n)) for t, n in zip(self.texts, counts, strict=True)], strict=True)] if counts else []
        self._set_repetitive_aside()

    def _set_repetitive_aside(self) -> None:
        """Items that repeat themselves: of these, each run of ``min_words`` words is kept once, to find the documents to look at."""
        self.repetitive = np.zeros(len(self.texts), bool)
        if not len(self.item):
            return
        order = np.lexsort([*self.keys[::-1], self.item])
        same = np.zeros(len(order), bool)
        same[1:] = (np.diff(self.item[order]) == 0) & np.all([np.diff(k[order].view(np.int64)) == 0 for k in self.keys], axis=0)
        group = np.cumsum(~same)
        often = np.bincount(group)[group] > MAX_SAME
        self.repetitive[self.item[order][often]] = True
        again = np.zeros(len(order), bool)
        again[order[same]] = True
        kept = ~(self.repetitive[self.item] & again)
        self.item, self.offset, self.keys = self.item[kept], self.offset[kept], [k[kept] for k in self.keys]

    def pack(self, numbers: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """The first ``min_words`` words of the suffixes at ``starts``, packed into as few 64-bit keys as hold them, in order."""
        per = max(1, 64 // self.bits)
        keys = []
        for first in range(0, self.min_words, per):
            key = np.zeros(len(starts), np.uint64)
            for k in range(first, min(first + per, self.min_words)):
                key = (key << np.uint64(self.bits)) | numbers[starts + k].astype(np.uint64)
            keys.append(key)
        return keys


def suffix_array(numbers: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of a shard in order of their first ``min_words`` words, and these words as keys.

    Suffixes with a word foreign to all items, or a gap, among these words can't match any test suffix and are left out.
    """
    known = np.concatenate(([0], np.cumsum(numbers > 1)))
    starts = np.flatnonzero(known[tests.min_words :] - known[: -tests.min_words] == tests.min_words) if len(numbers) >= tests.min_words else np.zeros(0, int)
    keys = tests.pack(numbers, starts)
    order = np.lexsort(keys[::-1])
    return starts[order], [k[order] for k in keys]


def _bound(keys: list[np.ndarray], wanted: list[np.ndarray], right: bool) -> np.ndarray:
    """Binary search of many key tuples at once: the first position not before (``right``: after) each."""
    low, high = np.zeros(len(wanted[0]), int), np.full(len(wanted[0]), len(keys[0]))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.minimum(middle, len(keys[0]) - 1)
        before, same = np.zeros(len(at), bool), np.ones(len(at), bool)
        for k, w in zip(keys, wanted, strict=True):
            got = k[at]
            before |= same & (got < w)
            same &= got == w
        go_right = open_ & (before | (same if right else False))
        low = np.where(go_right, middle + 1, low)
        high = np.where(open_ & ~go_right, middle, high)
    return low


class Automaton:
    """The suffix automaton of one item: the longest match of a document with it in one pass, in memory that grows with the item alone."""

    def __init__(self, numbers: Sequence[int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, last = [-1], [0], 0
        for w in numbers:
            new = self._state({}, self.length[last] + 1, 0)
            at = last
            while at != -1 and w not in self.next[at]:
                self.next[at][w] = new
                at = self.link[at]
            if at != -1:
                to = self.next[at][w]
                if self.length[to] != self.length[at] + 1:
                    copy = self._state(dict(self.next[to]), self.length[at] + 1, self.link[to])
                    while at != -1 and self.next[at].get(w) == to:
                        self.next[at][w] = copy
                        at = self.link[at]
                    self.link[to], to = copy, copy
                self.link[new] = to
            last = new

    def _state(self, following: dict[int, int], length: int, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def longest(self, document: Sequence[int], least: int) -> tuple[int, int, int]:
        """(longest match, number of stretches with matches of at least ``least`` words, where the first of the longest begins)."""
        state = length = best = at = places = 0
        before = -least - 1
        for end, w in enumerate(document):
            while state and w not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if w in self.next[state]:
                state, length = self.next[state][w], length + 1
            if length >= least:
                places += end - before > least
                before = end
                if length > best:
                    best, at = length, end - length + 1
        return best, places, at


_RESULT = ("doc", "item", "longest", "places", "at")


def search_shard(texts: Sequence[str | None], tests: TestSuffixes) -> pd.DataFrame:
    """(doc, item, longest, places, at) of every document and item with a common run of ``min_words`` words; doc and item are positions."""
    return search_words([words(t) for t in texts], tests)


def search_words(texts: Sequence[Sequence[str]], tests: TestSuffixes) -> pd.DataFrame:
    number, least = tests.vocabulary.get, tests.min_words
    parts, at = [], 0
    starts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        starts[k] = at
        parts.append(np.array([*(number(w, 1) for w in text), 0], np.uint32))
        at += len(parts[-1])
    shard = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    array, keys = suffix_array(shard, tests)
    found = [pd.DataFrame({c: np.zeros(0, np.int64) for c in _RESULT})]
    if len(array) and len(tests.item):
        low, high = _bound(keys, tests.keys, right=False), _bound(keys, tests.keys, right=True)
        per_item = np.bincount(tests.item, weights=high - low, minlength=len(tests.texts))
        step = (np.cumsum(per_item) - per_item) // STEP_HITS
        met = high > low
        for s in np.unique(step[np.unique(tests.item[met])]):
            chosen = met & (step[tests.item] == s)
            n = (high - low)[chosen]
            place = array[np.repeat(low[chosen], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))]
            hits = pd.DataFrame({"item": np.repeat(tests.item[chosen], n), "place": place, "line": place - np.repeat(tests.offset[chosen], n)})
            hits["doc"] = np.searchsorted(starts, hits.place.to_numpy(), side="right") - 1
            again = tests.repetitive[hits.item.to_numpy()]
            found += [_aligned(hits[~again], starts, least), _by_automaton(hits.loc[again, ["doc", "item"]].drop_duplicates(), parts, tests)]
    return pd.concat([f for f in found if len(f)] or found, ignore_index=True).sort_values(["doc", "item"], ignore_index=True)


def _aligned(hits: pd.DataFrame, starts: np.ndarray, least: int) -> pd.DataFrame:
    """Hits that follow each other on one line (place less offset) are one match; the longest of each document and item."""
    if not len(hits):
        return hits
    hits = hits.sort_values(["item", "line", "place"], kind="stable")
    follows = (hits.item.diff() == 0) & (hits.line.diff() == 0) & (hits.place.diff() == 1)
    runs = hits.groupby((~follows).cumsum()).agg(doc=("doc", "first"), item=("item", "first"), place=("place", "first"), longest=("place", "size"))
    runs = runs.sort_values(["doc", "item", "longest", "place"], ascending=[True, True, False, True]).drop_duplicates(["doc", "item"])
    placed = hits[["doc", "item", "place"]].drop_duplicates().sort_values(["doc", "item", "place"])
    fresh = (placed.doc.diff() != 0) | (placed.item.diff() != 0) | (placed.place.diff() > least)
    stretches = placed[fresh].groupby(["doc", "item"], sort=False).size().rename("places").reset_index()
    out = runs.merge(stretches, on=["doc", "item"])
    return pd.DataFrame({"doc": out.doc, "item": out["item"], "longest": out.longest + least - 1, "places": out.places, "at": out.place - starts[out.doc.to_numpy()]})


def _by_automaton(pairs: pd.DataFrame, parts: Sequence[np.ndarray], tests: TestSuffixes) -> pd.DataFrame:
    rows = []
    for item, docs in pairs.groupby("item").doc:
        automaton = Automaton(tests.texts[item].tolist())
        rows += [(doc, item, *automaton.longest(parts[doc].tolist(), tests.min_words)) for doc in docs]
    return pd.DataFrame(rows, columns=list(_RESULT))


def leaked(documents: DataFrame, items: DataFrame, *, min_words: int = 12, shard_chars: int = SHARD_CHARS, item_chars: int = ITEM_CHARS) -> DataFrame:
    """Every document that holds ``min_words`` consecutive words of an item: (doc_id, item_id, longest_words, n_places, at_word).

    Each task makes suffix arrays over its documents, a shard at a time, and binary-searches every test suffix in them. The
    arrays are ordered by the first ``min_words`` words, which is as far as a hit needs; neighbouring hits of one alignment join
    up to the longest verbatim matches. Items that repeat themselves are matched by an automaton instead, so memory grows with
    shard, items and results, never with their product. Nothing is shuffled, and the documents are read once: the items, a
    stated query set, go to all executors in blocks of ``item_chars`` characters, of which a worker holds one at a time.

    Defined cases: null or blank texts match nothing; items with fewer words match nothing; items of one text are all
    reported; case doesn't count; n_places is the number of separate stretches of the document that are covered by matches,
    at_word where the longest match (then the first) begins; a repeated or null doc_id gives one result per row; empty tables
    give an empty result.
    """
    queries = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    ship(documents.sparkSession)
    context = documents.sparkSession.sparkContext
    blocks, part, chars = [], [], 0
    for r in queries.orderBy("item_id").toLocalIterator():
        part.append((r["item_id"], r["text"]))
        chars += len(r["text"])
        if chars >= item_chars:
            blocks.append(context.broadcast(TestSuffixes(part, min_words)))
            part, chars = [], 0
    if part or not blocks:
        blocks.append(context.broadcast(TestSuffixes(part, min_words)))
    return documents.select("doc_id", "text").mapInArrow(_searcher(blocks, shard_chars), FOUND)


def _searcher(blocks, shard_chars: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            shard = np.cumsum([len(t or "") + 1 for t in texts]) // shard_chars
            for first, last in _runs(shard):
                split = [words(t) for t in texts[first:last]]
                for block in blocks:
                    mine = block.value
                    hits = search_words(split, mine)
                    if len(hits):
                        copies = np.array([len(mine.ids[i]) for i in hits["item"]])
                        items = pa.array(np.concatenate([mine.ids[i] for i in hits["item"]]).astype(np.int64))
                        hits = hits.loc[np.repeat(hits.index.to_numpy(), copies)]
                        numbers = [pa.array(hits[c].to_numpy(np.int32)) for c in ("longest", "places", "at")]
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(first + hits.doc.to_numpy(int))), items, *numbers], names=list(COLUMNS))
                    if len(blocks) > 1:  # read again from the executor's disk when its turn comes
                        del mine
                        vars(block).pop("_value", None)

    return searched


def _runs(labels: np.ndarray) -> list[tuple[int, int]]:
    if not len(labels):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents, whole rows, in which nothing was found.

    The ids found are written once, so the texts are searched once; they are broadcast if counted small, and then no text
    moves. Documents without an id can't be told apart: if one of them leaks, all of them go.
    """
    ids = broadcast_if_small(materialise(found.select(F.col("doc_id").alias("_leaked")).distinct(), "leaked"))
    return documents.join(ids, documents["doc_id"].eqNullSafe(ids["_leaked"]), "left_anti")


def items_leaked(items: DataFrame, found: DataFrame) -> DataFrame:
    """Per item how many documents hold a passage of it and the longest; 0 and null for clean items."""
    by_item = found.groupBy("item_id").agg(F.count("*").alias("n_documents"), F.max("longest_words").alias("longest_words"))
    return items.select("item_id", "benchmark", "split_name").join(by_item, "item_id", "left").withColumn("n_documents", F.coalesce("n_documents", F.lit(0)))
