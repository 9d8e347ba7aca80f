import random
from collections import Counter

import corpus_brute as brute
import numpy as np

from lossmill.llm.decontaminate import RADIUS, contaminated
from lossmill.llm.licenses import TEMPLATES, license_matches
from lossmill.llm.vector_search import nearest_neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>").repartition(3)


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(900, 12)).astype(np.float32)
    matrix[300:420] = matrix[300]  # a crowd of equal vectors
    frame = vectors(spark, [(i, v.tolist()) for i, v in enumerate(matrix)])
    rows = nearest_neighbours(frame, frame.where("vec_id % 100 = 0"), shard_rows=250).collect()
    hits = 0
    for q in range(0, 900, 100):
        gap = np.sqrt(((matrix.astype(np.float64) - matrix[q].astype(np.float64)) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(900), gap)) if i != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == q)
        assert [r for r, *_ in mine] == list(range(1, 11))
        assert all(abs(s - gap[v]) < 1e-9 for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & set(want))
    assert hits / 90 >= 0.9


def test_vectors_without_part(spark):
    rows = [(0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]), (6, [float("inf"), 0.0]), (None, [1.0, 2.0]), (1, [1.0, 1.0]), (7, [1.0, 2.0, 3.0])]
    frame = vectors(spark, rows)
    found = [tuple(r) for r in nearest_neighbours(frame, frame).collect()]
    assert sorted(found) == [(0, 1, 1, 1.0), (1, 1, 0, 1.0)]
    assert nearest_neighbours(frame.where("false"), frame.where("false")).count() == 0


def brute_matches(docs, items):
    def grams(words):
        n = min(5, len(words))
        return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()

    known = {i: brute.lowered(t).split() for i, t in items.items()}
    df = Counter(s for w in known.values() for s in set(grams(w)))
    size = len([t for t in items.values() if t is not None])
    weight = lambda s: int(round(1000 * np.log1p(size / max(df[s], 1))))
    best = {}
    for d, t in docs.items():
        words = brute.lowered(t).split()
        for i, item in known.items():
            two = grams(item)
            for start in range(len(words) - len(item) + 1 if item else 0):
                one = grams(words[start : start + len(item)])
                both = sum(weight(s) * min(one[s], two[s]) for s in one)
                if both:
                    similar = both / sum(weight(s) * max(one[s], two[s]) for s in one.keys() | two.keys())
                    if similar >= 0.8:
                        best[d, i] = min(best.get((d, i), (0, 0)), (-similar, start))
    return {k: (start, -s) for k, (s, start) in best.items()}


def test_contaminated(spark, table):
    rng = random.Random(6)
    words = lambda n: [rng.choice(brute.VOCABULARY) for _ in range(n)]
    items = {i: " ".join(words(rng.randint(14, 50))) for i in range(12)} | {20: "only three words", 21: None, 22: ""}
    docs = {}
    for d in range(60):
        text = words(rng.randint(0, 80))
        if d % 3 == 0:
            passage = items[d % 12].upper().split()
            if d % 2:
                passage[rng.randrange(len(passage))] = "other"
            at = rng.randint(0, len(text))
            text = text[:at] + passage + text[at:]
        docs[d] = " ".join(text)
    docs |= {97: "has Only THREE words", 98: None, 99: ""}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute_matches(docs, items)
    assert len(want) > 10
    for size in (8_000_000, 300):
        rows = contaminated(table(docs.items()), benchmark, pass_bytes=size).collect()
        assert {(r.doc_id, r.item_id): r.start_word for r in rows} == {k: v[0] for k, v in want.items()}
        assert all(abs(r.similarity - want[r.doc_id, r.item_id][1]) < 1e-9 and r.distance <= RADIUS for r in rows)
    assert contaminated(table(docs.items()), benchmark.where("false")).count() == 0


def test_licenses(table, odd):
    filler = "one two three four five six seven eight nine ten " * 3
    docs = {i: filler + TEMPLATES[name] + " " + filler for i, name in enumerate(sorted(TEMPLATES))}
    docs |= {50: "# RELEASED under\nthe MIT license!", 51: "a license of another kind", 52: None, 53: ""}
    docs |= {54: TEMPLATES["MIT-permission"].replace("restriction", "limits"), 55: "Released under"}
    found = {}
    for r in license_matches(table(docs.items())).collect():
        assert 0.8 <= r.contained <= 1
        found.setdefault(r.doc_id, set()).add(r.license)
    for i, name in enumerate(sorted(TEMPLATES)):
        assert name in found[i]
    assert found[50] == {"MIT"} and found[54] == {"MIT-permission"}
    assert not set(found) & {51, 52, 53, 55}
    assert license_matches(odd).count() == 0
    assert license_matches(table(docs.items()), {}).count() == 0
