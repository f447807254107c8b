"""Suffix arrays against comparing all runs of words."""

import random
import re

import numpy as np
import pytest

from lexloom.llm import leakage as lk
from tests.conftest import rows

DOCS, ITEMS = "doc_id bigint, text string, item_id string, place int", "item_id bigint, benchmark string, split_name string, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def longest(a, b):
    best, table = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0] * (len(b) + 1)
        for j, y in enumerate(b):
            if x == y:
                row[j + 1] = table[j] + 1
                best = max(best, row[j + 1])
        table = row
    return best


def brute(docs, items, least):
    return sorted(((d, i, n) for d, t, *_ in docs for i, _, _, x in items if i is not None and (n := longest(words(t), words(x))) >= least), key=repr)


def made(seed, n_docs=60, n_items=12):
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(6)] + ["Étude", "can’t", "x_y"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, "b", "s", text(draw.randrange(0, 20))) for i in range(n_items)] + [(100, "b", "s", None), (101, "b", "s", ""), (None, "b", "s", text(9))]
    docs = []
    for d in range(n_docs):
        parts = [text(draw.randrange(0, 30))]
        if draw.random() < 0.6:
            w = words(draw.choice(items[:n_items])[3])
            parts += [", ".join(w[draw.randrange(3):]).upper(), "— unknown █ " + text(4)] * draw.randrange(1, 3)
        docs.append((d, "\n".join(parts), "c", 1))
    return docs + [(900, None, "c", 1), (901, "  ", "c", 1), (None, items[0][3], "c", 1), ((1 << 53) + 1, items[1][3], "c", 1)], items


@pytest.mark.parametrize(("seed", "least", "chars", "block"), [(1, 5, 4_000_000, 8_000_000), (2, 5, 50, 8_000_000), (3, 3, 400, 90), (4, 12, 4_000_000, 8_000_000), (5, 4, 4_000_000, 1)])
def test_against_brute_force(spark, seed, least, chars, block):
    docs, items = made(seed)
    found = lk.leaked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), min_words=least, shard_chars=chars, item_chars=block)
    assert rows(found.select("doc_id", "item_id", "longest_words")) == brute(docs, items, least)


def test_the_array_is_sorted_and_the_search_finds_its_bounds():
    tests = lk.TestSuffixes([(1, "a b c a b d a b c")], 2)
    shard = np.array([tests.vocabulary.get(w, 1) for w in "a b c z a b a b d q a".split()] + [0], np.uint32)
    places, keys = lk.suffix_array(shard, tests)
    order = [tuple(shard[p:p + 2]) for p in places]
    assert order == sorted(order) and set(places) == {i for i in range(len(shard) - 1) if shard[i] > 1 and shard[i + 1] > 1}
    low, high = lk._bound(keys, tests.keys, False), lk._bound(keys, tests.keys, True)
    for k, offset in enumerate(tests.offset):
        wanted = [tests.vocabulary[w] for w in "a b c a b d a b c".split()[offset:offset + 2]]
        assert [list(x) for x in order[low[k]:high[k]]] == [wanted] * order.count(tuple(wanted))


def test_place_and_length_of_a_match(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "one two " + passage + " three", "", 0), (2, " ".join(passage.split()[:11]), "", 0), (3, " ".join(passage.split()[3:15]), "", 0)], DOCS)
    items = spark.createDataFrame([(5, "b", "s", passage.upper()), (6, "b", "s", passage.replace(" ", "; "))], ITEMS)
    assert rows(lk.leaked(docs, items)) == [(1, 5, 30, 1, 2), (1, 6, 30, 1, 2), (3, 5, 12, 1, 0), (3, 6, 12, 1, 0)]
    found = lk.leaked(docs, items)
    assert [r.doc_id for r in lk.without_leaks(docs, found).collect()] == [2]
    ids = [None, 7, None]
    unnamed = spark.createDataFrame([(i, t, "", 0) for i, t in zip(ids, [passage, "clean", "clean"], strict=True)], DOCS)
    assert [r.doc_id for r in lk.without_leaks(unnamed, lk.leaked(unnamed, items)).collect()] == [7]
    assert rows(lk.items_leaked(items, found)) == [(5, "b", "s", 2, 30), (6, "b", "s", 2, 30)]


def test_nothing_and_very_long(spark):
    items = spark.createDataFrame([(5, "b", "s", " ".join(f"p{i}" for i in range(12)))], ITEMS)
    long = ("x " * 400_000) + " ".join(f"p{i}" for i in range(12))
    docs = spark.createDataFrame([(1, long, "", 0)], DOCS)
    assert rows(lk.leaked(docs, items)) == [(1, 5, 12, 1, 400_000)]
    assert lk.leaked(docs.limit(0), items).count() == 0 and lk.leaked(docs, items.limit(0)).count() == 0


def test_items_that_repeat_themselves(spark, monkeypatch):
    """By arrays and by automata the same: longest match, stretches, place."""
    draw = random.Random(11)
    items = [(i, "b", "s", " ".join(draw.choice("xy") for _ in range(draw.randrange(8, 40)))) for i in range(15)]
    docs = [(d, " ".join(draw.choice("xyz" if d % 2 else "xyyyy") for _ in range(60)), "c", 1) for d in range(40)]
    results = []
    for most in (1, 4, 10**9):
        monkeypatch.setattr(lk, "MAX_SAME", most)
        monkeypatch.setattr(lk, "STEP_HITS", 50 if most == 4 else 10**6)
        found = lk.search_shard([t for _, t, *_ in docs], lk.TestSuffixes([(i, t) for i, _, _, t in items], 6))
        results.append(found.astype(int).values.tolist())
    assert results[0] == results[1] == results[2]
    assert [r[:3] for r in results[0]] == [list(x) for x in sorted(brute(docs, items, 6))]


def test_memory_does_not_grow_as_a_product():
    import tracemalloc

    tests = lk.TestSuffixes([(1, "x " * 1000), (2, "x " * 1000)], 12)
    tracemalloc.start()
    found = lk.search_shard(["x " * 40_000, "y"], tests)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.values.tolist() == [[0, 0, 1000, 1, 0]] and tests.ids == [[1, 2]] and peak < 60 << 20  # as hits, 40 million


def test_many_copies_of_one_item(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    items = spark.createDataFrame([(i, "b", "s", passage) for i in range(500)], ITEMS)
    docs = spark.createDataFrame([(d, passage + " tail", "", 0) for d in range(20)], DOCS)
    assert lk.leaked(docs, items).count() == 500 * 20
