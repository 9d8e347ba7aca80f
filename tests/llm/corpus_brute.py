"""Plain versions of the corpus operators, and texts to try them on."""

import itertools
import math
import random
from collections import Counter, defaultdict

VOCABULARY = ["the", "of", "é", "aa", "b", "ab", "ünd"] + [f"w{i}" for i in range(60)]


def texts(seed, documents=120):
    """Texts that share passages, some of one word repeated, NULL or empty."""
    rng = random.Random(seed)
    pool = [[rng.choice(VOCABULARY) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    made = {}
    for d in range(documents):
        kind = rng.random()
        if kind < 0.1:
            made[d] = None if kind < 0.05 else ""
        elif kind < 0.2:
            made[d] = " ".join([rng.choice(VOCABULARY) for _ in range(rng.randint(1, 3))] * rng.randint(1, 60))
        else:
            words = []
            for _ in range(rng.randint(1, 5)):
                words += rng.choice(pool) if rng.random() < 0.5 else [rng.choice(VOCABULARY) for _ in range(rng.randint(0, 40))]
            for _ in range(rng.randint(0, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
            made[d] = rng.choice([" ", "  ", "\n"]).join(words)
    return made


def copies(seed, families=20):
    """Families of texts with a few words changed."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    made = {}
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 14)):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            made[len(made)] = " ".join(w.upper() if rng.random() < 0.1 else w for w in words)
    return made


def lowered(text):
    return bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())


def without_words(docs, n):
    first = {}
    for d, t in sorted(docs.items()):
        w = (t or "").encode().split()
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), (d, i))
    out = {}
    for d, t in docs.items():
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] != (d, i):
                gone[i : i + n] = [True] * n
        out[d] = (len(w), sum(gone), b" ".join(x for x, y in zip(w, gone) if not y))
    return out


def without_bytes(docs, n):
    times = Counter()
    for t in docs.values():
        b = (t or "").encode()
        times.update(b[i : i + n] for i in range(len(b) - n + 1))
    out = {}
    for d, t in docs.items():
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if times[b[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        out[d] = (len(b), sum(gone), bytes(x for x, y in zip(b, gone) if not y))
    return out


def components(docs, n, percent):
    sets = {}
    for d, t in docs.items():
        w = lowered(t).split()
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(docs, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in docs}


def ppm(docs, held_out, order):
    count, trie = Counter(), defaultdict(Counter)

    def symbols(word):
        s = [*word, 32]
        for i, x in enumerate(s):
            yield tuple(([32] + s[:i])[-order:]), x

    for d, t in docs.items():
        if d in held_out:
            continue
        words = lowered(t).split()
        count.update(words)
        count["end"] += 1
        for context, x in [y for w in words for y in symbols(w)] + [((32,), "end")]:
            for k in range(len(context) + 1):
                trie[context[len(context) - k :]][x] += 1
    total, kinds = sum(count.values()), len(count)

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

    out = {}
    for d, t in docs.items():
        words = [*lowered(t).split(), "end"]
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in words)
        score = sum(cost(c, x) for w in words[:-1] for c, x in symbols(w)) + cost((32,), "end")
        out[d] = (len(words), sum(count[w] > 0 for w in words), total, base, score)
    return out
