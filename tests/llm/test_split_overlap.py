"""Held-out names in the training split, against comparing every pair."""

import random

import pytest

from lexloom.llm import split_overlap as so
from tests.conftest import rows


def near(a, b):
    """Distance at most 1, neighbours swapped counting as one."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1:] == b[i + 1:] or a[i + 1:] == b[i:] or a[i:] == b[i + 1:] or (a[i:i + 2] == b[i:i + 2][::-1] and a[i + 2:] == b[i + 2:] and len(a) == len(b))


def brute(held, training):
    return sorted({(i, w, k) for i, h in held for w, k, t in training if h and t and (h == t or (len(h) >= 5 and near(h, t)))}, key=repr)


@pytest.mark.parametrize(("seed", "limit", "longest"), [(1, 200_000, 16), (2, 200_000, 6), (3, 1, 5), (4, 200_000, 4)])
def test_against_all_pairs(spark, seed, limit, longest):
    draw = random.Random(seed)
    word = lambda n, letters: "".join(draw.choice(letters) for _ in range(n))
    held = [(i, word(draw.randrange(0, 11), "abc")) for i in range(40)]

    def altered(w):
        i = draw.randrange(len(w) + 1)
        return draw.choice([w[:i] + "x" + w[i:], w[:i] + w[i + 1:], w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:], w[:i] + "y" + w[i + 1:], w, w + "zz"])

    training = [("t", str(i), altered(draw.choice(held)[1]) if draw.random() < 0.5 else word(draw.randrange(0, 9), "abc")) for i in range(400)] + [("t", "9", None), ("u", "1", held[0][1])]
    h = spark.createDataFrame([*held, (99, None)], "eval_id bigint, eval_key string")
    t = spark.createDataFrame([(*x, "clash") for x in training], "found_in string, found_key string, key string, gram string")
    found = so.overlaps(h, t, broadcast_rows=limit, max_skip=longest)  # a limit of 1: partitioned instead of broadcast
    assert rows(found.select("eval_id", "found_in", "found_key")) == brute(held, training)


def test_kind_and_containment(spark):
    h = spark.createDataFrame([(1, "figma"), (2, "figm")], "eval_id bigint, eval_key string")
    t = spark.createDataFrame([("t", "1", "figma"), ("t", "2", "figna"), ("t", "3", "figm")], "found_in string, found_key string, key string")
    found = {(r.eval_id, r.found_key): (r.match, round(r.containment, 2)) for r in so.overlaps(h, t).collect()}
    assert found == {(1, "1"): ("exact", 1.0), (1, "2"): ("almost", 0.67), (1, "3"): ("almost", 0.67), (2, "3"): ("exact", 1.0)}


def test_tables_with_nulls_and_nothing(spark):
    holdout = spark.createDataFrame([(1, " Figma™", None, None, None), (2, None, "a", "b", None), (3, "—", "a", "b", None)], "holdout_id bigint, name_line string, split_name string, source_name string, sealed_on string")
    names = spark.createDataFrame([(7, "ｆｉｇｍａｔｍ", "x"), (8, None, "x")], "norm_id bigint, normalized string, key string")
    artifacts = spark.createDataFrame([("a", "induction", ["FIGMATN", None, "figmatm", "figmatm"], None), ("b", "induction", None, {"exact": None})], "artifact_id string, use_kind string, names array<string>, excluded_by_holdout map<string,bigint>")
    found = so.holdout_overlaps(holdout, names, artifacts)
    assert rows(found.select("eval_id", "found_in", "found_key", "match")) == [(1, "corpus_artifact", "a", "exact"), (1, "normalised_record", "7", "exact")]
    assert rows(so.per_split_and_source(found, holdout)) == [("unknown", "unknown", "corpus_artifact", "exact", 1, 1), ("unknown", "unknown", "normalised_record", "exact", 1, 1)]
    assert rows(so.artifact_claims(found, artifacts)) == [("a", "induction", None, 1), ("b", "induction", 0, 0)]
    assert so.holdout_overlaps(holdout.limit(0), names, artifacts).count() == 0 == so.holdout_overlaps(holdout, names.limit(0), artifacts.limit(0)).count()


def test_candidates_are_few_more_than_overlaps(spark):
    draw = random.Random(9)
    weights = [len("etaoinshrdlucmfwypvbgkjqxz") - i for i in range(26)]
    name = lambda: "".join(draw.choices("etaoinshrdlucmfwypvbgkjqxz", weights, k=draw.randrange(5, 8)))
    h = spark.createDataFrame([(i, name()) for i in range(4000)], "eval_id bigint, eval_key string")
    t = spark.createDataFrame([("t", str(i), name() if i % 3 else "hotname") for i in range(6000)], "found_in string, found_key string, key string")
    near_ones = so.candidates(h, t).distinct().count()
    assert near_ones <= 5 * max(50, so.overlaps(h, t).count())


def test_long_and_hot_keys(spark):
    long = "ab" * 2000
    h = spark.createDataFrame([(1, long), (2, "hotname")], "eval_id bigint, eval_key string")
    t = spark.createDataFrame([("t", "x", long[:1500] + "z" + long[1500:]), ("t", "y", "c" * 50_000), *[("t", str(i), "hotnome") for i in range(300)]], "found_in string, found_key string, key string")
    found = so.overlaps(h, t)
    assert found.where("eval_id = 1").count() == 1 and found.where("eval_id = 2 and match = 'almost'").count() == 300 and found.count() == 301
