"""Reading levels: held-out accuracy, the fit on a case that is plain, and the defined cases."""

import random

import numpy as np
import pytest

from lexloom.llm import reading_level as rl

EASY = "The cow was near the gate. They hit the roof and lost the van. No one took it."
HARD = "Notwithstanding the acknowledged inadequacy of the underlying particulars, the doctrine of estoppel necessitates interlocutory characterisation; constitutional entitlement presupposes adjudication."
DOCS = "doc_id bigint, text string, lang string, source string, band int, level double"


def text(draw, share):
    pick = lambda s: draw.choice([x for x in s.replace(";", ".").split(".") if x.strip()]).strip() + ". "
    return "".join(pick(HARD if draw.random() < share else EASY) for _ in range(12))


@pytest.fixture(scope="module")
def model():
    draw = random.Random(1)
    bands = [draw.randrange(1, 6) for _ in range(150)]
    return rl.fit([text(draw, (b - 1) / 4) for b in bands], bands)


def test_levels_follow_the_text(model):
    draw = random.Random(2)
    found = model.scorer().documents([text(draw, s) for s in (0, 0.25, 0.5, 0.75, 1) for _ in range(20)])
    means = found.difficulty.to_numpy().reshape(5, 20).mean(axis=1)
    assert (np.diff(means) > 0.4).all() and means[0] < 2 and means[-1] > 4
    assert np.allclose(found[[f"share_{k}" for k in range(1, 6)]].sum(axis=1), 1)


def test_held_out_accuracy(spark, folder):
    """On the test data of the next size, where there are labels enough."""
    larger = folder.replace("sf0.001", "sf0.1")
    documents, labels = spark.read.parquet(f"{larger}/documents.parquet"), spark.read.parquet(f"{larger}/reading_labels.parquet")
    kept, held = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    found = rl.accuracy(rl.reading_levels(documents.join(held.select("doc_id").distinct(), "doc_id", "left_semi"), rl.fit(*rl.labelled_sample(documents, kept))), held).first()
    assert found["n_documents"] > 200 and found["mean_error"] < 0.3 and found["same_band"] > 0.8 and found["within_one"] > 0.99 and found["correlation"] > 0.95


def test_defined_cases(spark, model):
    docs = spark.createDataFrame([(1, None, "en", "s", 1, 1.0), (2, " \n ", "en", "s", 1, 1.0), (3, "12. ¶ !", None, "s", 1, 1.0), (4, "Das Gericht prüft den Vertrag.", "de", "s", 1, 1.0), (5, (EASY + " ") * 20_000, "en", "s", 1, 1.0), (5, HARD, "en", "s", 1, 1.0), (None, HARD.split(";")[0], "en", "s", 1, 1.0)], DOCS)
    found = {(r.doc_id, r.n_sentences): r for r in rl.reading_levels(docs, model).collect()}
    assert found[1, 0].band is None and found[2, 0].difficulty is None and found[2, 0].share_1 is None and found[None, 1].band is not None
    assert found[4, 1].band in range(1, 6) and found[5, 60_000].band == 1 and (3, 1) in found
    assert rl.reading_levels(docs.limit(0), model).count() == 0
    assert rl.profile(rl.reading_levels(docs, model), docs.dropDuplicates(["doc_id"])).count() >= 2


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, EASY, "en", "s", 1, 1.0)], DOCS)
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 9), (3, 77, 2)], "label_id bigint, doc_id bigint, band int")
    texts, bands = rl.labelled_sample(docs, labels)
    assert texts == [] and rl.reading_levels(docs, rl.fit(texts, bands)).first()["band"] is None


def test_isotonic_fit():
    x, y = rl.isotonic(np.array([1.0, 2, 3, 4]), np.array([1.0, 3, 2, 4]))
    assert y.tolist() == [1, 2.5, 4] and (np.diff(y) > 0).all() and x.tolist() == [1, 2.5, 4]


def test_sentences():
    ends = np.array([t in rl.ENDS for t in rl.tokens_of("One two. Three 4.5\n\nFive!  Six?")])
    assert len(rl.sentence_starts(ends)) == 4 and rl.tokens_of("No. 12 Äpfel") == ["no", ".", "0", "äpfel"]
