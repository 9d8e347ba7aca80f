import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lossmill.llm.periodic_runs import periodic_runs, runs_of
from lossmill.llm.queries import period_digests, with_cycles
from lossmill.llm.recompression import Grammar


def brute_runs(words, periods=4, length=6):
    n, found = len(words), {}
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            total = i + q - start
            if total >= max(length, periods * q):
                found.setdefault((start, total), q)
    return sorted((s, t, q) for (s, t), q in found.items())


def sequences(seed, count=60):
    rng = random.Random(seed)
    for _ in range(count):
        alphabet = rng.choice([1, 2, 3, 30])
        made = []
        for _ in range(rng.randint(0, 4)):
            piece = [rng.randrange(alphabet) for _ in range(rng.randint(1, 9))]
            made += piece * rng.randint(1, 9) + [rng.randrange(alphabet) for _ in range(rng.randint(0, 7))]
        yield made


def test_extensions_equal_comparison():
    for made in sequences(1):
        n = len(made)
        if n < 2:
            continue
        pairs = [(i, j) for i in range(n) for j in range(n) if i != j]
        i, j = np.array(pairs).T

        def agree(x, y):
            k = 0
            while x + k < n and y + k < n and made[x + k] == made[y + k]:
                k += 1
            return k

        assert Grammar(np.array(made)).extensions(i, j).tolist() == [agree(x, y) for x, y in pairs]


def test_the_grammar_is_shallow():
    rng = np.random.default_rng(2)
    assert len(Grammar(rng.integers(0, 50, 100_000)).levels) < 80
    assert len(Grammar(np.zeros(100_000, dtype=np.int64)).levels) == 2


def test_runs_equal_brute_force():
    made = list(sequences(2, 150)) + [[0] * 5, [0] * 6, [0, 1] * 4, [0, 1] * 3, []]
    flat = np.array([x for m in made for x in m], dtype=np.uint64)
    offsets = np.cumsum([0, *map(len, made)])
    got = [[tuple(r) for r in rows.tolist()] for rows in runs_of(flat, offsets, 4, 6)]
    assert got == [brute_runs(m) for m in made]


def test_small_pieces_change_nothing(monkeypatch):
    from lossmill.llm import periodic_runs as module

    made = list(sequences(3, 20))
    flat, offsets = np.array([x for m in made for x in m], dtype=np.uint64), np.cumsum([0, *map(len, made)])
    monkeypatch.setattr(module, "PIECE", 7)
    assert [[tuple(r) for r in rows.tolist()] for rows in runs_of(flat, offsets, 4, 6)] == [brute_runs(m) for m in made]


def wanted(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, t, q in runs for i in range(s + q, s + t)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{t},{q}\n" for s, t, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    exponent = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, exponent, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def digests(frame):
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return [(r.doc_id, tuple(r[c] for c in columns)) for r in period_digests(periodic_runs(with_cycles(frame))).collect()]


def test_digests_equal_brute_force(table):
    rng = random.Random(4)
    docs = {}
    for d, made in enumerate(sequences(5, 120)):
        docs[d] = rng.choice([" ", " \n", "\t"]).join(f"é{x}" for x in made)
    docs |= {1000 + d: " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 90))) for d in range(80)}
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d in docs) > 5
    assert dict(digests(table(docs.items()))) == {d: wanted(d, t) for d, t in docs.items()}


def test_odd_rows(odd, table):
    rows = sorted(odd.select("doc_id", "text").collect(), key=str)
    assert sorted(digests(odd), key=str) == sorted([(r.doc_id, wanted(r.doc_id, r.text)) for r in rows], key=str)
    assert digests(table([(1, "x")]).where("false")) == []


def test_a_very_long_text(table):
    text = " ".join(["a"] * 30_000 + ["b", "c", "d"] * 9_000 + [f"w{i}" for i in range(9_000)])
    (row,) = periodic_runs(table([(1, text)])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 30_000, 1), (30_000, 27_000, 3)]
    assert bytes(row.collapsed).decode().split()[:5] == ["a", "b", "c", "d", "w0"]
