import random

import corpus_brute as brute
import numpy as np
import pytest

from lossmill.llm import set_join, suffix_dedup
from lossmill.llm.minhash_dedup import near_duplicates, rows_per_band
from lossmill.llm.substring_dedup import remove_repeated_words
from lossmill.llm.suffix_dedup import agreement, decode_front, front_code, merge_runs, remove_repeated_bytes, spread_bounds
from lossmill.llm.textscan import cover, gram_hashes, sliding_min


def result(frame):
    return {r.doc_id: (r["size"], r.removed, bytes(r.kept)) for r in frame.collect()}


@pytest.mark.parametrize("crowd", [50_000, 3])
def test_repeated_words(table, crowd):
    docs = brute.texts(1)
    assert result(remove_repeated_words(table(docs.items()), crowd=crowd)) == brute.without_words(docs, 20)


@pytest.mark.parametrize("ranges", [1, 30])
def test_repeated_bytes(table, ranges):
    docs = brute.texts(2)
    found = remove_repeated_bytes(table(docs.items()), ranges=ranges)
    assert result(found) == brute.without_bytes(docs, 200)
    for row in found.collect():
        spans = [(s.start, s.length) for s in row.spans]
        assert sum(n for _, n in spans) == row.removed
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("length, percent, crowd", [(3, 85, 64), (5, 80, 64), (3, 85, 2), (5, 80, 1)])
def test_near_duplicates(table, length, percent, crowd):
    docs = brute.copies(3) | {900: None, 901: "", 902: " \n", 903: "One two", 904: "one  TWO"}
    rows = near_duplicates(table(docs.items()), length, percent, crowd=crowd).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute.components(docs, length, percent)


@pytest.mark.parametrize("changes", [(2, 3), (1, 1, 2, 6)])
def test_near_copies_below_the_threshold(table, monkeypatch, changes):
    """Most pairs share a bucket and are not similar: they are not made, and no link is lost."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    docs = {}
    for i in range(200):
        words = list(base)
        for _ in range(2 * rng.choice(changes)):
            words[rng.randrange(len(words))] = rng.choice([f"n{i}", "often"])
        docs[i] = " ".join(words)
    compared = []
    beside = set_join._beside

    def counting(rows, edges):
        compared.append(edges.count())
        return beside(rows, edges)

    monkeypatch.setattr(set_join, "_beside", counting)
    found = near_duplicates(table(docs.items()), 3, 85, crowd=16).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.components(docs, 3, 85)
    # A member meets fewer than 16 others in each of its small buckets, whatever the size of the group.
    assert 0 < sum(compared) < len(docs) * (len(docs) - 1) / 2 / 4


def test_large_group_of_copies(table):
    docs = {i: "one and the same text of these words again" for i in range(700)} | {i: f"alone {i} of all" for i in range(700, 720)}
    found = near_duplicates(table(docs.items()), 3, 85).collect()
    assert sum(r.kept for r in found) == 21
    kept = {r.doc_id for r in remove_repeated_words(table(docs.items()), length=5, anchor=2).collect() if not r.removed}
    assert kept == {0, *range(700, 720)}


def test_odd_rows(odd):
    """Rows that repeat id and text are one document; other texts without own id are documents of their own."""
    assert near_duplicates(odd).count() == 8
    by_text = {bytes(r.kept): r for r in remove_repeated_words(odd).collect()}
    assert remove_repeated_words(odd).count() == 8 and by_text[b"a b c"]["size"] == 3
    long = [r for r in remove_repeated_bytes(odd).collect() if r.doc_id == 5][0]
    assert (long["size"], long.removed, bytes(long.kept)) == (70_000, 70_000, b"")


def test_empty_table(table):
    none = table([(1, "x")]).where("false")
    assert near_duplicates(none).count() == 0
    assert remove_repeated_words(none).count() == 0
    assert remove_repeated_bytes(none).count() == 0


def test_merge_of_runs():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 30)).tolist()) for _ in range(400)]
    runs = [sorted(strings[i::7]) for i in range(7)]
    coded = [front_code(x) for x in runs]
    assert [decode_front(*x) for x in coded] == runs
    merged, last = [], b""
    for run, place, agrees in merge_runs([(x, y[0]) for x, y in zip(runs, coded)]):
        merged.append(runs[run][place])
        assert len(merged) == 1 or agrees == agreement(last, merged[-1])
        last = merged[-1]
    assert merged == sorted(strings)


def test_arrays():
    values = np.array([5, 3, 8, 1, 9, 2], dtype=np.uint64)
    assert sliding_min(values, 3).tolist() == [3, 1, 1, 1]
    grams = gram_hashes(np.array([1, 2, 3, 1, 2, 3], dtype=np.uint64), 3)
    assert grams[0] == grams[3] and len(set(grams.tolist())) == 3
    assert cover(np.array([1, 2]), np.array([3, 4]), 6).tolist() == [False, True, True, True, False, False]


def test_bands_find_pairs_at_the_threshold():
    for percent in (60, 80, 85, 95):
        rows = rows_per_band(percent)
        assert (1 - (percent / 100) ** rows) ** (128 // rows) <= 1e-6


def test_an_anchor_is_cut_only_where_it_fills_more_than_a_range():
    """A cut through an anchor leaves each window of its suffixes as a row to be compared."""
    few = [b"a" * 64 + b"%03d" % i for i in range(5)]
    strings = sorted([b"%064d" % i for i in range(45)] + few)
    assert spread_bounds(strings, 5, 64) == [strings[i][:64] for i in (10, 20, 30, 40)]
    assert spread_bounds(sorted(strings[:40] + few * 2), 5, 64)[-1] == few[0][:64]
    crowd = sorted(strings[:20] + [b"a" * 64 + b"%03d" % i for i in range(40)])
    bounds = spread_bounds(crowd, 6, 64)
    assert [len(x) for x in bounds] == [64, 67, 67, 67, 67] and bounds == sorted(set(bounds))
    assert spread_bounds([], 5, 64) == []


@pytest.mark.parametrize("whole", [True, False])
def test_ranges_with_whole_and_with_cut_anchors_remove_the_same(spark, monkeypatch, whole):
    """One passage in every document with other words around it; whole anchors leave nothing open."""
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefghij "), 260))
    texts = ["".join(rng.choice(list("klmnopq "), 150)) + passage + "".join(rng.choice(list("rstuvwx "), 150)) for _ in range(24)]
    texts += ["".join(rng.choice(list("ABCDEFGH "), 900)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if not whole:
        monkeypatch.setattr(suffix_dedup, "spread_bounds", lambda s, n, anchor: sorted({s[len(s) * i // n] for i in range(1, n)}))
    merged = []
    real = suffix_dedup.cut_lineage
    monkeypatch.setattr(suffix_dedup, "cut_lineage", lambda f: merged.append(real(f)) or merged[-1])
    found = {r["doc_id"]: r["removed"] for r in remove_repeated_bytes(docs, ranges=3).collect()}
    assert all(found[i] >= 260 if i < 24 else found[i] == 0 for i in range(84))
    if not whole:
        assert merged[-1].where("high IS NOT NULL").count() > 24
