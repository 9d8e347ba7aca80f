import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lossmill.llm.packing import differencing, pack_documents, windows
from lossmill.llm.queries import tokenizer_path
from lossmill.llm.simple8b import decode, encode
from lossmill.llm.token_files import read_token_files, write_token_files
from lossmill.llm.tokens import text_ids
from lossmill.session import scratch_path

PIECES = ["a", "B", "é", "É", "×", "'s", "don't", "we'LL", "́", "İ", "ß", "Σ", "中文", "1", "23", "<|endoftext|>", "!!", "&&&", "_", "-", " ", "\x1c", "\xa0", "\n", "  ", "😀", "x<", "|>", "ÿ", "Ā"]


def expected(texts, last):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [last] for t in texts]


def test_ids_are_those_of_the_tokenizer():
    rng = random.Random(2)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", None, "   "]
    found = []
    for _, ids, offsets in text_ids(pa.array(texts), tokenizer_path(), 7):
        found += [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert found == expected(texts, 7)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(values):
    values = np.array(values, dtype=np.uint64)
    coded, blocks = encode(values)
    assert (decode(coded, blocks, len(values)) == values).all()
    assert len(blocks) == -(-len(values) // 128) + 1 and blocks[-1] == len(coded)


TEXTS = {3: "some words, here", 1: None, 7: "", 5: "The same. " * 900, 2: "é 1 <|endoftext|>"}


def test_token_files(spark, table):
    path = scratch_path(spark, "test-tokens")
    write_token_files(table(TEXTS.items()), path, tokenizer_path(), 1)
    rows = sorted(read_token_files(spark, path).collect())
    before = 0
    for row, (doc_id, text) in zip(rows, sorted(TEXTS.items()), strict=True):
        ids = expected([text], 1)[0]
        assert (row.doc_id, row.start, row.n_tokens, list(row.ids)) == (doc_id, before, len(ids), ids)
        assert row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        before += len(ids)


def check_pieces(rows, texts, capacity):
    whole, filled = {}, {}
    for r in rows:
        assert r.length == len(r.ids) > 0
        whole.setdefault(r.doc_id, []).append((r.start, list(r.ids), r.doc_tokens))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in texts:
        pieces = sorted(whole[doc_id])
        ids = [i for _, x, _ in pieces for i in x]
        assert ids == expected([text], 2)[0] and {n for *_, n in pieces} == {len(ids)}
        assert [s for s, *_ in pieces] == np.cumsum([0, *(len(x) for _, x, _ in pieces)])[:-1].tolist()
    for parts in filled.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= capacity


def test_packing(table):
    rows = pack_documents(table(TEXTS.items()), tokenizer_path(), 2, capacity=64, group=8, longest=16).collect()
    check_pieces(rows, TEXTS.items(), 64)
    assert pack_documents(table([(1, "x")]).where("false"), tokenizer_path(), 2).count() == 0


def test_differencing():
    sizes = np.array([8, 7, 6, 5, 4])
    sums, members = differencing(sizes, 2)
    assert sorted(sums.tolist()) == [14, 16] and sorted(i for m in members for i in m) == list(range(5))
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 512, 3000)
    found = windows(sizes, 4096)
    assert sorted(i for m in found for i in m) == list(range(3000))
    assert max(sizes[m].sum() for m in found) <= 4096
    assert sizes.sum() / (4096 * len(found)) > 0.98


@pytest.mark.parametrize("end_id", [1])
def test_odd_rows(spark, odd, end_id):
    path = scratch_path(spark, "test-tokens")
    write_token_files(odd, path, tokenizer_path(), end_id)
    assert read_token_files(spark, path, with_ids=False).count() == 8
    assert pack_documents(odd, tokenizer_path(), 2).select("doc_id").count() >= 9
