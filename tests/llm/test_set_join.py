import random

import corpus_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lossmill.llm import set_join
from lossmill.llm.set_join import shared, similar_sets


def found(frame, **options):
    rows = similar_sets(frame, **options).collect()
    assert all((r.n_links > 0) or r.component_id is not None for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


@pytest.mark.parametrize("length, percent, crowd, depth", [(3, 90, 64, 4), (3, 85, 2, 4), (5, 80, 3, 0), (2, 70, 4, 1)])
def test_links_equal_brute_force(table, length, percent, crowd, depth):
    docs = brute.copies(3) | {900: None, 901: "", 902: " \n", 903: "One two", 904: "one  TWO"}
    got = found(table(docs.items()), length=length, percent=percent, crowd=crowd, depth=depth)
    assert got == brute.components(docs, length, percent)


def relatives(seed, members, changes):
    """One long text with a few words changed in each of many copies; most pairs are near the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    made = {}
    for i in range(members):
        words = list(base)
        for _ in range(rng.choice(changes)):
            words[rng.randrange(len(words))] = rng.choice([f"n{i}", "often"])
        made[i] = " ".join(words)
    return made


@pytest.mark.parametrize("changes", [(0, 1, 2, 3), (2, 3), (1, 1, 2, 6)])
def test_a_crowd_of_relatives(table, changes):
    docs = relatives(5, 150, changes)
    assert found(table(docs.items()), length=3, percent=90, crowd=8) == brute.components(docs, 3, 90)


def test_relatives_are_not_compared_in_pairs(table, monkeypatch):
    docs = relatives(6, 240, (2, 3))
    pairs = []
    beside = set_join._beside

    def counting(rows, edges):
        pairs.append(edges.count())
        return beside(rows, edges)

    monkeypatch.setattr(set_join, "_beside", counting)
    similar_sets(table(docs.items()), length=3, percent=90, crowd=16).count()
    assert sum(pairs) < 8 * len(docs) < len(docs) * (len(docs) - 1) / 2


def test_exact_copies_are_one_set(table):
    docs = {i: "one and the same  text of these words again" for i in range(500)} | {i: f"alone {i} of all" for i in range(500, 510)}
    got = found(table(docs.items()))
    assert {c for _, c in got.values()} == {0, *range(500, 510)}


def test_odd_and_empty_tables(odd, table):
    rows = similar_sets(odd).collect()
    assert len(rows) == 8 and sum(r.n_shingles == 0 for r in rows) == 4
    assert similar_sets(table([(1, "x")]).where("false")).count() == 0
    assert similar_sets(table([(1, "x y"), (2, None)])).select(F.sum("n_shingles")).first()[0] == 1


def test_shared():
    a, b = np.array([1, 4, 9, 12]), np.array([0, 4, 12, 13, 20])
    assert shared(a, b) == shared(b, a) == 2 and shared(a[:0], b) == 0


def test_buckets_that_hang_together_have_one_centre(spark):
    """Each set is answered once, not once around every bucket's centre; neighbours in size still meet."""
    from lossmill.llm.minhash_dedup import _group_stars

    sizes = {k: 15 + k % 5 for k in range(40)}  # 15 | 16 17 18 19: a class ends below 16
    rows = [(band, (band * 7) % 40, k, sizes[k], 40) for band in range(1, 6) for k in sizes if (k + band) % 4 or k == band * 7 % 40]
    rows += [(9, 100, k, 50, 3) for k in (100, 101, 102)]
    found = _group_stars(spark.createDataFrame(rows, "band long, centre long, key long, n_shingles long, members long"), 85).collect()
    of = {}
    for centre, key in found:
        of.setdefault(key, set()).add(centre)
    assert len({c for k, cs in of.items() if k < 100 for c in cs}) <= 2
    assert len(found) == sum(map(len, of.values())) <= 2 * len(of)
    assert of[100] == of[101] == of[102] and len(of[100]) == 1 and max(of[100]) >= 100
    for a in sizes:
        for b in sizes:
            if 100 * min(sizes[a], sizes[b]) >= 85 * max(sizes[a], sizes[b]):
                assert of[a] & of[b]


def test_sets_connected_already_need_no_common_difference(spark):
    def differences(*tokens):
        return np.array(sorted(tokens), dtype=np.uint64).tobytes()

    own = {1: range(2), 2: range(10, 40), 3: range(20, 50), 4: range(30, 60)}
    rows = spark.createDataFrame([(0, key, 100, differences(*tokens)) for key, tokens in own.items()], set_join.ROWS)
    placed = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "key long, component long")

    def outer(*placing):
        return {r.key for r in set_join._bounded(rows, 80, *placing)[0].where("outer").collect()}

    assert outer() == {2, 3, 4}
    # Of 2, 3 and 4 only the last one can bring a new link.
    assert outer(placed) == {4}


def test_links_around_a_centre_connect_what_is_not_connected(spark, table):
    docs = relatives(9, 120, (1, 2, 6, 7))
    want = brute.components(docs, 3, 90)
    texts = table(docs.items()).selectExpr("doc_id AS key", "text")
    sets = set_join.stored_sets(texts.repartition("key"), 3, True)
    stars = texts.selectExpr("0L AS centre", "key")
    # Half of each component is connected before.
    placing = {key: want[key][1] if key % 2 else key for key in docs}
    placed = spark.createDataFrame(list(placing.items()), "key long, component long")
    links = [tuple(r) for found in set_join.around_centres(stars, sets, placed, 90, crowd=8) for r in found.collect()]
    links += list(placing.items()) + [(0, key) for key in docs if want[key][1] == want[0][1] and brute.components({0: docs[0], key: docs[key]}, 3, 90)[key][1] == 0]
    label = {key: key for key in docs}
    for _ in docs:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert label == {key: component for key, (_, component) in want.items()}


def test_sets_are_not_stored(table, spark, tmp_path, monkeypatch):
    rng = random.Random(9)
    docs = {i: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(100)}" for _ in range(400)) for i in range(300)}
    monkeypatch.setattr(set_join, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    frame = similar_sets(table(docs.items()), length=3, percent=90)
    assert frame.count() == len(docs)
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    # Hashes of shingles take 8 bytes each.
    assert 0 < stored < frame.agg(F.sum("n_shingles")).first()[0] * 4


def test_sets_of_repeated_rows(spark, monkeypatch):
    """A key's rows that follow each other share a set, however many tokens a piece may hold."""
    texts = {1: "a b c d e f", 2: "", 3: "a b", 4: "c d e f a b c", 5: None}
    rows = [(n, key, texts[key]) for n, key in enumerate([1, 1, 1, 2, 2, 3, 4, 4, 5, 1])]
    stored = set_join.StoredTexts(spark.createDataFrame(rows, "n int, key long, text string").coalesce(1), 3, True)
    for piece in (1 << 20, 5, 1):
        monkeypatch.setattr(set_join, "PIECE", piece)
        batches = [pa.RecordBatch.from_pydict(dict(zip(("n", "key", "text"), map(list, zip(*rows)))))]
        made = [r for b in set_join._formed(iter(batches), 3, True) for r in b.to_pylist()]
        assert [(r["n"], r["key"]) for r in made] == [r[:2] for r in rows]
        assert [r["size"] for r in made] == [4, 4, 4, 0, 0, 1, 5, 5, 0, 4]
        assert all(len(r["tokens"]) == 8 * r["size"] for r in made)
        assert made[0]["tokens"] == made[2]["tokens"] == made[-1]["tokens"] != made[6]["tokens"]
    found = stored.formed(stored.rows).collect()
    assert [(r.n, r.size) for r in found] == [(r["n"], r["size"]) for r in made]
