"""Training on all labelled rows (operator 4)."""

import numpy as np
import pyarrow as pa

from boostframe.llm import toxicity
from tests.conftest import make_spark

SCHEMA = "doc_id long, text string"


def labelled(seed, n, size):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    for i in range(n):
        text = list(rng.choice(words, size))
        if i % 3 == 0:
            text[int(rng.integers(size))] = "grobnak"
        yield i, " ".join(text), int(i % 3 == 0)


def test_long_texts_are_learned_from():
    """Labelled texts of more than 20,000 characters only: all of them train, in several tasks."""
    spark, rows = make_spark(), list(labelled(0, 150, 3500))
    docs = spark.createDataFrame([r[:2] for r in rows], SCHEMA).repartition(3)
    model = toxicity.train(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int"), held_fold=None)
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.score(docs, model).collect()}
    assert np.mean([got[i] == bool(label) for i, _, label in rows]) > 0.95


def test_counts_are_of_all_labelled_texts():
    """More clean rows than any bound of a sample: a word of all of them is counted in every one that trains."""
    spark = make_spark()
    texts = [f"common word{i}" for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(4000)], "doc_id long, toxic int")
    rows = toxicity._known(docs, labels, None)
    assert rows.count() == 4000
    held = toxicity._occurrences(rows)
    row = toxicity.words_of(pa.array(["common"]))[2][0, 0]
    assert held[0, 0, row] >= 3960 and held[1, 0, row] >= 40
    one = toxicity.occurrences(*toxicity.words_of(pa.array(texts))[:3], np.array([int(i % 100 == 0) for i in range(4000)]))
    assert (one == held).all()


def test_moves_are_averaged_over_the_tasks_that_made_them():
    rng = np.random.default_rng(0)
    texts, y = pa.array(["foul day", "fine day"] * 20), np.array([1, 0] * 20)
    index, per_text, buckets, _ = toxicity.words_of(texts)
    learner = toxicity.Learner(toxicity._start(toxicity.occurrences(index, per_text, buckets, y), 20, 20, rng))
    start = learner.model.tables.copy(), learner.rest.copy()
    learner.learn(index, per_text, buckets, y, np.ones(40), rng)
    end, moves = (learner.model.tables.copy(), learner.rest.copy()), list(learner.moves())
    learner.model.tables[:], learner.rest[:], learner.seen[:], learner.rest_seen[:] = start[0], start[1], learner.first[1], learner.first[3]
    for key, rows, n, move in moves:              # two tasks that made the same moves
        learner.take(key, rows, n * 2, move * 2)
    assert np.allclose(learner.model.tables, end[0], atol=1e-6) and np.allclose(learner.rest, end[1], atol=1e-6)
    assert (learner.model.tables != start[0]).any()
