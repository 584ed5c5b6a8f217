"""The toxicity classifier: held-out accuracy, counterfactual swaps, odd tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.llm.toxicity import (
    IDENTITY_TERMS,
    Examples,
    Features,
    Model,
    example,
    fit,
    score,
    swapped,
    swaps_of,
    toxicity_report,
    train,
    words_of,
)

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = "/root/testdata/sf0.1"
SWAPS = swaps_of(IDENTITY_TERMS)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{name}.parquet") for name in ("documents", "labels"))
    return docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels


def test_held_out_accuracy(tables):
    docs, labels = tables
    found = {r.doc_id: r for r in toxicity_report(docs, labels).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert set(found) == set(known) and all(r.held_out == held_out(d) for d, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())
    apart = [(found[d].predicted, t) for d, t in known.items() if held_out(d)]
    caught = [p for p, t in apart if t]
    clean = [p for p, t in apart if not t]
    assert len(caught) > 50 and np.mean(caught) > 0.85 and np.mean(clean) < 0.01


def test_held_out_labels_play_no_part(tables):
    docs, labels = tables
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic"))
                               .otherwise(F.col("toxic")))
    some = docs.where("doc_id < 800")
    one, two = train(some, labels), train(some, turned)
    assert one.bias == two.bias and (one.weights == two.weights).all() and one.weights.any()


def sentences(seed, n, toxic_about):
    """Insults that mostly name one group, and clean sentences that seldom name any."""
    rnd = random.Random(seed)
    filler = [f"word{i}" for i in range(300)]
    found = []
    for i in range(n):
        words, toxic = rnd.choices(filler, k=12), int(i % 3 == 0)
        if toxic:
            words += [rnd.choice(["scum", "vermin", "trash", "filth"])] * (rnd.random() < 0.8)
            words += [toxic_about] * (rnd.random() < 0.9)
        elif rnd.random() < 0.03:
            words.append(toxic_about)
        rnd.shuffle(words)
        found.append((" ".join(words), toxic))
    return found


def trained(penalty):
    features = Features()
    made = [example(features, words_of(t), SWAPS, 2) for t, _ in sentences(1, 1500, "muslims")]
    data = Examples.of([(ids, toxic, counter) for (ids, counter), (_, toxic) in zip(made, sentences(1, 1500, "muslims"))])
    return fit(data, swap_penalty=penalty)


def test_swap_penalty_spares_neutral_mentions():
    free, held = trained(0), trained(10)
    rnd = random.Random(2)
    neutral = [f"the {group} of word{rnd.randrange(300)} met word{rnd.randrange(300)}"
               for group in ("muslims", "christians", "hindus") for _ in range(60)]
    insults = [f"word{rnd.randrange(300)} {group} are {slur} word{rnd.randrange(300)}"
               for group in ("muslims", "christians", "") for slur in ("scum", "vermin", "trash", "filth") for _ in range(20)]
    wrong = [np.mean([m.score(t) >= 0.5 for t in neutral]) for m in (free, held)]
    caught = np.mean([held.score(t) >= 0.5 for t in insults])
    gap = [np.mean([abs(m.score(t) - m.score(" ".join(swapped(words_of(t), SWAPS, 0)))) for t in neutral]) for m in (free, held)]
    assert wrong[0] > 0.3 and wrong[1] == 0
    assert caught > 0.95 and gap[1] < gap[0] / 5


def test_swaps_stay_within_their_kind():
    assert SWAPS["women"][0] == "men" and "women" not in SWAPS["women"] and "muslims" not in SWAPS["women"]
    assert swapped({"the", "gay", "word"}, SWAPS, 0) == {"the", "lesbian", "word"}
    features = Features()
    ids, counter = example(features, {"the", "women"}, SWAPS, 2)
    assert len(counter) == 2
    added = {i for i in counter[0] if i >= 0}
    removed = {-i - 1 for i in counter[0] if i < 0}
    assert (set(ids) - removed) | added == set(features.of({"the", "men"}))
    assert example(features, {"the", "word"}, SWAPS, 2)[1] == []


def test_odd_tables(spark):
    long = " ".join(f"clean{i}" for i in range(200_000)) + " scum"
    docs = spark.createDataFrame([
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", 1), (None, "scum", "en", "a", 1), (4, "scum", None, "b", 1),
        (4, "scum", None, "b", 1), (4, "other text", None, "b", 1), (5, "clean words", "en", "b", 1)], SHAPE)
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (77, 1), (1, None), (3, 7)], "doc_id long, toxic int")
    found = toxicity_report(docs.withColumn("score", F.lit("x")).withColumn("place", F.lit("y")), labels)
    got = found.collect()
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and len(got) == 8
    bias = next(r.score for r in got if r.doc_id == 1)
    assert bias == next(r.score for r in got if r.doc_id == 2) and not next(r.held_out for r in got if r.doc_id is None)
    assert rows(toxicity_report(docs.where("false"), labels)) == []
    for none in (labels.where("false"), labels.where("toxic = 0"), labels.where("toxic = 1")):
        assert len({r.score for r in toxicity_report(docs, none).collect()}) == 1


def test_bounds_of_the_sample(tables):
    docs, labels = tables
    few = train(docs, labels, most_rows=200)
    assert few.weights.any() and not np.array_equal(few.weights, train(docs, labels, most_rows=400).weights)
    assert train(docs, labels, most_features=200_000).weights.any()


def test_scores_of_a_known_model(spark):
    model = Model(np.zeros(1 << 18, np.float32), 0.0)
    for i in model.features.of_word("scum"):
        model.weights[i] = 1.5
    docs = spark.createDataFrame([(1, "SCUM", "en", "a", 1), (2, "fine", "en", "a", 1)], SHAPE)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert got[1] == pytest.approx(1 / (1 + np.exp(-1.5 * len(model.features.of_word("scum"))))) and got[2] == 0.5
