"""Token ids of whole texts by a tokenizers file that never joins words across white space.

A batch has few different words for its length, so each is encoded once and its ids
are laid out by array operations. Most words are letters and then marks, whose ids
follow each other; letters go to the file's model directly, in lower case, and all
other words through the whole tokenizer. Ids are remembered in the worker, up to a
fixed number of words; what is forgotten is encoded again.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textscan import Chunk, chunks, range_hashes, words

REMEMBERED = 600_000

_LETTER, _MARK, _OTHER = 0, 1, 2
#: Kind of each byte, where a byte of 0xC3 counts with the one that follows it.
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and x != 0x27]] = _MARK


def _byte_characters() -> list[str]:
    """Byte-level vocabularies write a byte as itself where it is printable, else as a later character."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    later = iter(range(0x100, 0x200))
    return [chr(x) if x in plain else chr(next(later)) for x in range(256)]


_CHARACTERS = dict(enumerate(_byte_characters()))


def simple_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with simple words in lower case, which words are simple, and where their marks begin.

    Simple: letters of ASCII and Latin-1, then marks without the apostrophe. Their lower
    case depends on no neighbour, and the two parts are never one token.
    """
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = data[lead + 1]
    # The signs of multiplication and division stand among the letters.
    lead = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    marks = np.concatenate(([0], np.cumsum(kind == _MARK)))
    others = np.concatenate(([0], np.cumsum(kind == _OTHER)))
    back = np.concatenate(([0, 0], np.cumsum((kind[1:] == _LETTER) & (kind[:-1] == _MARK))))
    simple = (others[ends] == others[starts]) & (kind[starts] == _LETTER) & (back[ends] == back[starts + 1])
    turn = ends - (marks[ends] - marks[starts])
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts[simple]] += 1
    inside[ends[simple]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    lower = data.copy()
    lower[inside & (data >= 0x41) & (data <= 0x5A)] += 0x20
    lead = lead[inside[lead]]
    second = lower[lead + 1]
    lower[lead + 1] = np.where(second <= 0x9E, second + 0x20, second)
    return lower, simple, np.where(simple, turn, ends)


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}

    def _whole(self, strings: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([x.decode() for x in strings], add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32).tobytes() for x in found]

    def of(self, unique: list[bytes], letters: list[bool]) -> list[bytes]:
        """Little-endian 32-bit ids of each word; `letters`: it is letters in lower case only."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        gc.disable()  # many small objects, none in a cycle
        new = [(x, y) for x, y in zip(unique, letters) if x not in known]
        model = self.tokenizer.model.tokenize
        texts = [x.decode("latin-1").translate(_CHARACTERS) for x, y in new if y]
        ids = [[t.id for t in model(x)] for x in texts]
        sizes = [len(x) for x in ids]
        flat = np.fromiter((i for x in ids for i in x), dtype=np.uint32, count=sum(sizes)).tobytes()
        at = 0
        for (word, _), size in zip((x for x in new if x[1]), sizes):
            known[word] = flat[at : at + 4 * size]
            at += 4 * size
        whole = [x for x, y in new if not y]
        known.update(zip(whole, self._whole(whole)))
        gc.enable()
        return [known[word] for word in unique]

    def chunk_ids(self, chunk: Chunk, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a chunk's texts, each followed by `last`, and where each text begins."""
        found = words(chunk.data, chunk.offsets)
        texts = len(found.offsets) - 1
        if len(found.starts) == 0:
            return np.full(texts, last, dtype=np.uint32), np.arange(texts + 1)
        lower, simple, turn = simple_words(chunk.data, found.starts, found.ends)
        split = np.flatnonzero(turn < found.ends)
        starts = np.insert(found.starts, split + 1, turn[split])
        ends = np.insert(turn, split + 1, found.ends[split])
        letters = np.insert(simple, split + 1, False)
        firsts = found.offsets + np.searchsorted(split, found.offsets)
        _, first, inverse = np.unique(range_hashes(lower, starts, ends), return_index=True, return_inverse=True)
        raw = lower.tobytes()
        unique = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        coded = self.of(unique, letters[first].tolist())
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        table = np.append(np.frombuffer(b"".join(coded), dtype=np.uint32), np.uint32(last))
        places = np.append(np.cumsum(sizes) - sizes, len(table) - 1)
        # One more entry behind each text: the closing id.
        entry = np.insert(inverse, firsts[1:], len(coded))
        size = np.append(sizes, 1)[entry]
        stops = np.cumsum(size)
        index = np.repeat(places[entry] - (stops - size), size) + np.arange(int(stops[-1]))
        return table[index], np.append(0, stops[firsts[1:] + np.arange(texts)])


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The worker's encoder for a file."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def text_ids(column: pa.Array, path: str, last: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield first row, ids and text offsets of runs of a text column."""
    coder = encoder(path)
    for chunk in chunks(column):
        yield (chunk.first, *coder.chunk_ids(chunk, last))
