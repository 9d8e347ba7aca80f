import random
from collections import Counter

import corpus_brute as brute
import numpy as np
import pytest

from lossmill.llm.decontaminate import RADIUS, contaminated


def best_windows(docs, items):
    """The most similar window of each document and item; a document shorter than the item is one window."""
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    known = {i: brute.lowered(t).split() for i, t in items.items()}
    sizes = {i: min(5, len(w)) for i, w in known.items()}
    df = Counter(s for i, w in known.items() for s in set(grams(w, sizes[i])))
    weight = lambda s: int(round(1000 * np.log1p(len(items) / max(df[s], 1))))
    best = {}
    for d, t in docs.items():
        words = brute.lowered(t).split()
        for i, item in known.items():
            two = grams(item, sizes[i])
            for start in range(max(1, len(words) - len(item) + 1)):
                window = words[start : start + len(item)]
                one = grams(window, sizes[i])
                both = sum(weight(s) * min(one[s], two[s]) for s in one)
                if both:
                    similar = both / sum(weight(s) * max(one[s], two[s]) for s in one.keys() | two.keys())
                    if similar >= 0.8:
                        best[d, i] = min(best.get((d, i), (0, 0, 0)), (-similar, start, len(window)))
    return {k: (start, n, -s) for k, (s, start, n) in best.items()}


def test_documents_shorter_than_an_item(spark, table):
    rng = random.Random(8)
    words = lambda n: [rng.choice(brute.VOCABULARY) for _ in range(n)]
    items = {i: " ".join(words(rng.randint(5, 50))) for i in range(11)} | {11: " ".join(words(40)), 12: "only three words"}
    docs = {}
    for i, text in items.items():
        w = text.split()
        for n, cut in enumerate((w[1:], w[2:], w[:-1], w[:-2], w[1:-1], w[6:], w[: len(w) // 2], w + words(9))):
            docs[10 * i + n] = " ".join(cut)
    docs |= {900: "three words", 901: "", 902: None}
    want = best_windows(docs, items)
    assert all((110 + n, 11) in want for n in range(5))
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for size in (8_000_000, 300):
        rows = contaminated(table(docs.items()), benchmark, pass_bytes=size).collect()
        assert {(r.doc_id, r.item_id): (r.start_word, r.n_words) for r in rows} == {k: v[:2] for k, v in want.items()}
        assert all(r.similarity == pytest.approx(want[r.doc_id, r.item_id][2]) and r.distance <= RADIUS for r in rows)
