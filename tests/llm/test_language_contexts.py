import math
import os
import random
import zlib
from collections import Counter, defaultdict

import corpus_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmill.llm.ppm import language_scores
from lossmill.llm.queries import op3_language_scores


def scores(docs, held_out, order):
    """Prediction by partial matching whose contexts are the last symbols of the whole text."""
    trie = defaultdict(Counter)

    def symbols(text):
        s = [32] * order + [x for w in brute.lowered(text).split() for x in [*w, 32]] + ["end"]
        return [(tuple(s[i - order : i]), s[i]) for i in range(order, len(s))]

    for d, t in docs.items():
        for context, x in symbols(t) if d not in held_out else []:
            for k in range(len(context) + 1):
                trie[context[len(context) - k :]][x] += 1

    def cost(context, x):
        result, excluded = 0.0, set()
        while True:
            seen = {s: n for s, n in trie.get(context, {}).items() if s not in excluded}
            if seen:
                room = sum(seen.values()) + len(seen)
                if x in seen:
                    return result + math.log10(seen[x] / room)
                result += math.log10(len(seen) / room)
            excluded |= set(seen)
            if not context:
                return result - math.log10(257 - len(excluded))
            context = context[1:]

    return {d: sum(cost(c, x) for c, x in symbols(t)) for d, t in docs.items()}


@pytest.mark.parametrize("options", [{}, {"order": 3, "part_cells": 60, "frequent_words": 10}])
def test_contexts_go_over_words(table, options):
    docs = brute.texts(5, 60) | {900: "Zq\x00\x7f €x", 901: "unseen żółw"}
    held = {d for d in docs if zlib.crc32(str(d).encode()) % 7 == 2}
    want = scores(docs, held, options.get("order", 6))
    rows = language_scores(table(docs.items()), across=True, **options).collect()
    assert {r.doc_id: r.score for r in rows} == pytest.approx(want, abs=1e-6)


def test_query_tells_shuffled_words_apart(spark, table, tmp_path):
    rng = random.Random(3)
    order = [f"w{i}" for i in range(30)]
    shuffled = rng.sample(order, len(order))
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    docs = {i: " ".join(order) for i in range(40)} | {held[0]: " ".join(order), held[1]: " ".join(shuffled)}
    table(docs.items()).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op3_language_scores(spark, str(tmp_path)).collect()}
    first, second = found[held[0]], found[held[1]]
    assert first.base_score == pytest.approx(second.base_score)
    assert first.score > second.score + 10 and first.score > first.base_score


GIVEN = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(GIVEN), reason="needs the given tables")
def test_held_out_score_beats_the_base(spark):
    found = op3_language_scores(spark, GIVEN).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > found[1]


def test_a_repeated_word_takes_no_more_room(monkeypatch):
    """Cells are made for different words, not for all; a trie of an earlier model does not stay beside them."""
    import pyarrow as pa

    from lossmill.llm import ppm

    made = []
    monkeypatch.setattr(ppm, "text_cells", lambda *x, f=ppm.text_cells: made.append(f(*x)) or made[-1])
    ppm._tries["earlier"] = None
    columns = [pa.array(["of the " * 5000, " ", "", None]), pa.array([False, False, False, True])]
    batch = pa.RecordBatch.from_arrays(columns, ["text", "held_out"])
    rows = [r for b in ppm._statistics(iter([batch]), np.zeros(0, dtype=np.uint64), 3, False) for r in b.to_pylist()]
    assert not ppm._tries
    assert sum(len(cells) for cells, _ in made) < 100
    cells = {r["code"]: r["count"] for r in rows if r["kind"] == 0}
    assert sum(cells.values()) == 5000 * (3 + 4) + 3  # letters and the space of each word, and three ends
    want = dict(zip(*np.unique(ppm.text_cells(*_whole(["of the " * 5000, " ", ""]), 3, False)[0], return_counts=True)))
    assert cells == want


def _whole(texts):
    import pyarrow as pa

    from lossmill.llm.textscan import chunks, lower_ascii, words

    (chunk,) = chunks(pa.array(texts))
    data = lower_ascii(chunk.data)
    return data, words(data, chunk.offsets)


def test_a_frequent_word_is_looked_up_once(monkeypatch):
    """In whatever many batches it comes: its cells are counted by its total, and its cost is kept."""
    import pyarrow as pa

    from lossmill.llm import ppm

    class Sent:
        value = None

    texts = ["of the sea", "the of the land", "the the", "of"]
    _, found = _whole(["of the"])
    frequent = np.sort(found.hashes)
    batches = [pa.RecordBatch.from_pydict({"key": [i], "text": [t], "held_out": [False]}) for i, t in enumerate(texts)]
    rows = [r for b in ppm._statistics(iter(batches), frequent, 3, False) for r in b.to_pylist()]
    cells = {r["code"]: r["count"] for r in rows if r["kind"] == 0}
    assert cells == dict(zip(*np.unique(ppm.text_cells(*_whole(texts), 3, False)[0], return_counts=True)))
    assert sorted(r["count"] for r in rows if r["kind"] == 1) == [3, 5]

    code, count = (np.array(x) for x in zip(*sorted(cells.items())))
    short = {}
    for k in (0, 1):
        own, place = np.unique(code & ((1 << (9 * (k + 1))) - 1), return_inverse=True)
        short[k] = own, np.bincount(place, weights=count).astype(np.int64)
    Sent.value = ("here", code, count, short)
    want = {}
    for i, batch in enumerate(batches):  # each alone, by a model of its own
        ppm._tries.clear()
        (alone,) = ppm._sums(iter([batch]), np.zeros(0, dtype=np.uint64), np.zeros(0), Sent, 0, 1, 3, False)
        want[i] = alone["score"][0].as_py()
    ppm._tries.clear()
    asked = []
    monkeypatch.setattr(ppm.Trie, "costs", lambda self, cells, f=ppm.Trie.costs: asked.append(len(cells)) or f(self, cells))
    together = list(ppm._sums(iter(batches), frequent, np.ones(2), Sent, 0, 1, 3, False))
    assert {i: b["score"][0].as_py() for i, b in enumerate(together)} == pytest.approx(want, abs=1e-12)
    assert asked[0] == 1 and asked[2] == 5 and asked[3:] == [0, 0]  # the end; "land " after the first batch; nothing new
    ppm._tries.clear()


def test_a_trie_takes_half_the_room_for_small_counts():
    """Costs are those of 64-bit counts, and larger counts keep them."""
    from lossmill.llm import ppm

    code = np.unique(ppm.text_cells(*_whole(["of the sea", "the land"]), 3, False)[0])
    tries = []
    for count in (np.arange(1, len(code) + 1), np.arange(1, len(code) + 1) << 32):
        short = {}
        for k in (0, 1):
            own, place = np.unique(code & ((1 << (9 * (k + 1))) - 1), return_inverse=True)
            short[k] = own, np.bincount(place, weights=count).astype(np.int64)
        tries.append(ppm.Trie(code, count, short, 3))
    small, large = tries
    assert {x.dtype for x in [small.levels[3][1], *small.contexts[3][1:]]} == {np.dtype(np.int32)}
    assert large.levels[3][1].tolist() == [n << 32 for n in small.levels[3][1].tolist()]
    assert large.contexts[0][1].tolist() == [n << 32 for n in small.contexts[0][1].tolist()]
    assert np.isfinite(large.costs(code)).all()
