"""The toxicity classifier against plain loops, on rare words and on repeated labels."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from doselens.llm import toxicity

WORDS = ["harbour", "window", "letter", "garden", "river", "market", "winter", "cousin", "bridge", "kettle"]


def corpus(spark, n=400, rare=6):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 40))
        toxic = int(i % 5 == 0)
        if toxic:
            words[rng.randrange(len(words))] = "zorgblat" if i >= 5 * rare else "quuxwitz"
        rows.append((i, " ".join(words), toxic))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(3)


def grams(text):
    """Character n-grams of the words of an ASCII text, with a blank for either border."""
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        for length in toxicity.LENGTHS:
            found.update(padded[i : i + length] for i in range(len(padded) - length + 1))
    return found


def place_of(gram):
    """The place of one n-gram, character by character from its end; a blank counts as 0."""
    mixed = 0x811C9DC5 + len(gram)
    for c in reversed(gram):
        mixed = ((mixed ^ (0 if c == " " else ord(c))) * 0x01000193) % 2**32
    mixed ^= mixed >> 15
    return (mixed * 0x85EBCA6B) % 2**32 >> (32 - toxicity.BITS)


def test_places_are_those_of_the_ngrams():
    """A text that ends in a letter has no border there."""
    for seed in range(20):
        text = "".join(random.Random(seed).choices("abc  -D1", k=300)) + " "
        expected = Counter()
        for gram, n in grams(text).items():
            expected[place_of(gram)] += n
        assert Counter(toxicity.places(text).tolist()) == expected


def test_fit_is_the_minimum(spark):
    """No small step lowers the penalised loss that a plain loop computes."""
    rng = np.random.default_rng(3)
    n, width = 120, 9
    present = rng.random((n, width)) < 0.3
    labels = (present[:, 0] | (rng.random(n) < 0.1)).astype(float)
    ratios = rng.normal(1, 0.5, width)
    rows, columns = np.nonzero(present)
    fitted = toxicity._logistic(rows, columns.astype(np.int32), ratios, labels)

    def loss(weights):
        total = toxicity.PENALTY * n / 100 * (weights[:-1] ** 2).sum() / 2
        for i in range(n):
            margin = weights[-1] + sum(weights[j] * ratios[j] for j in range(width) if present[i, j])
            total += math.log1p(math.exp(margin)) - labels[i] * margin
        return total

    best = loss(fitted)
    for j in range(width + 1):
        for step in (-0.01, 0.01):
            moved = fitted.copy()
            moved[j] += step
            assert loss(moved) > best


def test_counts_and_ratios_equal_plain_counting(spark):
    frame = corpus(spark)
    counted = {r.place: (r.toxic, r.other) for r in toxicity._class_counts(frame.select("text", "toxic")).collect()}
    expected = {}
    for text, toxic in frame.select("text", "toxic").collect():
        for place in set(toxicity.places(text).tolist()):
            have = expected.setdefault(place, [0, 0])
            have[1 - toxic] += 1
    assert counted == {p: tuple(v) for p, v in expected.items()}


def test_rare_words_and_long_texts(spark):
    frame = corpus(spark)
    labels = frame.select("doc_id", "toxic")
    model = toxicity.learn(frame.select("doc_id", "text"), labels)
    table = model.table()
    clean = " ".join(random.Random(4).choices(WORDS, k=60_000))
    assert model.score(clean, table) < 0.1 and model.score("", table) < toxicity.THRESHOLD
    assert model.score("my cousin said quuxwitz", table) > 0.5 > model.score("my cousin said witz", table)
    assert model.score("ZORGBLAT!", table) > 0.5 and model.score(clean + " zorgblat", table) > 0.5
    scored = toxicity.add_scores(frame.select("doc_id", "text"), model).join(labels, "doc_id")
    assert scored.where("predicted != toxic").count() == 0


def test_repeated_rows_of_labelled_ids_count_once(spark):
    frame = corpus(spark)
    texts, labels = frame.select("doc_id", "text"), frame.select("doc_id", "toxic")
    once = toxicity.learn(texts, labels)
    hot = texts.where("doc_id = 7").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy")
    many = toxicity.learn(texts.unionByName(hot).unionByName(texts), labels.unionByName(labels))
    assert (once.kept == many.kept).all() and np.allclose(once.weights, many.weights) and once.intercept == many.intercept
    later = texts.where("doc_id = 7").withColumn("text", F.lit("~ another text under the id"))
    assert (toxicity.learn(texts.unionByName(later), labels).kept == once.kept).all()
