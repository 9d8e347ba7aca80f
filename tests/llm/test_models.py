import random
import zlib

import corpus_brute as brute
import numpy as np
import pytest

from lossmill.llm.ppm import language_scores
from lossmill.llm.quality import accepted, fit, marginals, scored, train


@pytest.mark.parametrize("order, options", [(5, {}), (3, {"part_cells": 60, "frequent_words": 10})])
def test_language_scores(table, order, options):
    docs = brute.texts(5, 60) | {900: "Zq\x00\x7f €x", 901: "unseen żółw"}
    held = {d for d in docs if zlib.crc32(str(d).encode()) % 7 == 2}
    want = brute.ppm(docs, held, order)
    rows = language_scores(table(docs.items()), order=order, **options).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert r.held_out == (r.doc_id in held)
        assert r.base_score == pytest.approx(want[r.doc_id][3], abs=1e-6)
        assert r.score == pytest.approx(want[r.doc_id][4], abs=1e-6)


def test_scores_of_odd_and_empty_tables(odd, table):
    assert language_scores(odd).count() == 8
    assert language_scores(table([(1, "x")]).where("false")).count() == 0


def test_marginals_sum_over_all_labellings():
    rng = np.random.default_rng(1)
    scores, pairs, firsts = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    good, expected = marginals(scores, pairs, firsts)
    want, want_pairs = np.zeros(9), np.zeros((2, 2))
    for a, b in zip(firsts, firsts[1:]):
        n, total, own, own_pairs = b - a, 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            weight = np.exp(sum(scores[a + i] * y[i] for i in range(n)) + sum(pairs[p, q] for p, q in zip(y, y[1:])))
            total += weight
            own += weight * np.array(y)
            for p, q in zip(y, y[1:]):
                own_pairs[p, q] += weight
        want[a:b], want_pairs = own / total, want_pairs + own_pairs / total
    assert good == pytest.approx(want) and expected == pytest.approx(want_pairs)


def made(rng, good):
    words = [rng.choice(brute.VOCABULARY) for _ in range(rng.randint(5, 60))]
    if not good:
        words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w + "&&&" for w in words]
    return "".join(w + rng.choice(["\n", " ", " ", " "]) for w in words)


def test_quality(spark, table):
    rng = random.Random(4)
    labels = {i: int(rng.random() < 0.7) for i in range(400)}
    docs = table([(i, made(rng, y)) for i, y in labels.items()] + [(900, None), (901, "")])
    known = spark.createDataFrame([*labels.items(), (None, 1), (5, None)], "doc_id long, quality int")
    field = train(docs, known)
    scores = {r.doc_id: r.score for r in scored(docs, field).collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(scores[i] >= 0.3) == labels[i] for i in held]) > 0.95
    assert all(0 <= x <= 1 for x in scores.values()) and len(scores) == 402
    kept = accepted(docs, field)
    assert kept.columns == docs.columns and kept.count() == sum(x >= 0.3 for x in scores.values())


def test_no_labels(spark, odd):
    field = train(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in scored(odd, field).collect()} == {0.5}
    assert fit(np.zeros((0, 3)), np.array([0]), np.zeros(0, dtype=int)).weights.tolist() == [0, 0, 0]
