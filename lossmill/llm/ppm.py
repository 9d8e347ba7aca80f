"""Language-model scores by prediction by partial matching over bytes of texts.

A text is coded as its words, each byte by byte and closed by a space, and then an
end. The context of a symbol are the last `ORDER` symbols of the text, over word
boundaries; before a text stand spaces. `across=False` ends it at the space before
the word. Counts of all orders form a trie of contexts. A symbol is looked for in
its longest context; a context without it costs an escape, estimated by the number
of different symbols seen in it, and symbols seen there are excluded in the shorter
ones. What no context has is uniform over the symbols that remain.

The trie holds the counts of all training texts. It is applied in parts of bounded
size, each over all documents: a part has the contexts that end alike, so that each
step of the search down to two symbols stays within the part, and the tables of
shorter contexts, which are bounded by the alphabet, go with every part. Where
contexts end with the word, the cells of a word are the same wherever it stands, so
that a task makes and looks up those of its different words, and those of a
frequent word once.

Beside it stands a unigram of words with one added to every count. Words that a
sample shows to be frequent, a bounded number, are counted and looked up in tables;
all others by a shuffle on the word. Where a word ends up does not change a count.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .documents import keyed
from .textscan import Words, chunks, lower_ascii, mix, signed, words

#: The longest context whose cells fit into 63 bits.
ORDER = 6
#: Cells of the trie that are held at once, and frequent words that are held in a table.
PART_CELLS = 4_000_000
FREQUENT = 65_536
#: Cells that a task holds before it sums them, and gives them out where most are different.
HELD_CELLS = 2_000_000
#: Documents that the frequent words are taken from, at most about.
SAMPLE_DOCUMENTS = 20_000

_BITS = 9
_SPACE, _END = 0x20 + 1, 257
_ALPHABET = 257


def text_cells(raw: np.ndarray, found: Words, order: int, across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Cells (context and symbol, packed) of texts in their order, and for each cell the number of its text."""
    texts = np.arange(len(found.offsets) - 1)
    # Pieces are the words with their spaces, and after those of each text its end.
    word_at, end_at = np.arange(len(found.starts)) + found.row_of, found.offsets[1:] + texts
    sizes = np.ones(len(found.starts) + len(texts), dtype=np.int64)
    sizes[word_at] += found.ends - found.starts
    opens = np.full(len(sizes), not across)
    opens[found.offsets[:-1] + texts] = True
    # Where contexts begin anew, spaces go before, as a text's beginning; before a single word one space and empty places.
    firsts = np.cumsum(sizes + order * opens) - sizes
    symbols = np.zeros(int(sizes.sum()) + order * int(opens.sum()), dtype=np.int64)
    for j in range(1, (order if across else min(order, 1)) + 1):
        symbols[firsts[opens] - j] = _SPACE
    word_sizes = sizes[word_at] - 1
    place = np.arange(int(word_sizes.sum()))
    before = np.cumsum(word_sizes) - word_sizes
    symbols[place + np.repeat(firsts[word_at] - before, word_sizes)] = raw[place + np.repeat(found.starts - before, word_sizes)].astype(np.int64) + 1
    symbols[firsts[word_at] + word_sizes] = _SPACE
    symbols[firsts[end_at]] = _END
    cells = symbols.copy()
    for j in range(1, order + 1):
        cells[j:] |= symbols[:-j] << (_BITS * j)
    text = np.zeros(len(sizes), dtype=np.int64)
    text[word_at], text[end_at] = found.row_of, texts
    own = np.ones(len(symbols), dtype=bool)
    for j in range(1, order + 1):
        own[firsts[opens] - j] = False
    return cells[own], np.repeat(text, sizes)


def word_cells(raw: np.ndarray, found: Words, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of single words, given by where each stands first, and for each cell the number of its word.

    Contexts end with the word; a text is its words' cells and `end_cell`.
    """
    apart = Words(found.starts[first], found.ends[first], found.hashes[first], np.arange(len(first) + 1))
    cells, word = text_cells(raw, apart, order, False)
    own = (cells & ((1 << _BITS) - 1)) != _END
    return cells[own], word[own]


def end_cell(order: int) -> np.ndarray:
    """The cell of the end of a text, where contexts end with the word."""
    return np.array([(_SPACE << _BITS) | _END if order else _END])


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in half the room, where they are small enough."""
    return counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts


class Trie:
    """Counts of one part of the trie, and the cost of every cell that belongs to it."""

    def __init__(self, cells: np.ndarray, counts: np.ndarray, short: dict[int, tuple[np.ndarray, np.ndarray]], order: int):
        """`cells`, `counts`: longest contexts of the part; `short`: cells and counts of orders 0 and 1 of the whole."""
        self.order = order
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(order + 1):
            if k in short:
                cell, count = short[k]
            else:
                cell, inverse = np.unique(cells & ((1 << (_BITS * (k + 1))) - 1), return_inverse=True)
                count = np.bincount(inverse, weights=counts, minlength=len(cell)).astype(np.int64)
            self.levels.append((cell, _narrow(count)))
        self.contexts = []
        for k, (cell, count) in enumerate(self.levels):
            context, first, kinds = np.unique(cell >> _BITS, return_index=True, return_counts=True)
            total = np.add.reduceat(count, first, dtype=np.int64) if len(first) else count
            shared = np.zeros(len(context), dtype=np.int64)
            if k and len(first):
                shared = np.add.reduceat(self._counts(k - 1, cell & ((1 << (_BITS * k)) - 1)), first, dtype=np.int64)
            self.contexts.append((context, *map(_narrow, (total, kinds, shared))))

    def _counts(self, k: int, cell: np.ndarray) -> np.ndarray:
        known, count = self.levels[k]
        if not len(known):
            return np.zeros(len(cell), dtype=np.int64)
        at = np.minimum(np.searchsorted(known, cell), len(known) - 1)
        return np.where(known[at] == cell, count[at], 0)

    def costs(self, cells: np.ndarray) -> np.ndarray:
        """log10 of the probability of each cell's symbol in its context."""
        result = np.zeros(len(cells))
        open_ = np.arange(len(cells))
        #: What the next longer context has seen: its kinds of symbols, and their count at this order.
        kinds_above, shared_above = np.zeros(len(cells), dtype=np.int64), np.zeros(len(cells), dtype=np.int64)
        for k in range(self.order, -1, -1):
            if not len(open_):
                return result
            cell = cells[open_] & ((1 << (_BITS * (k + 1))) - 1)
            context, total, kinds, shared = self.contexts[k]
            if not len(context):
                continue
            own = cell >> _BITS
            at = np.minimum(np.searchsorted(context, own), len(context) - 1)
            seen = context[at] == own
            if k < self.order:
                # A context that is no shorter than the one before has been asked already.
                same = seen & (own == (cells[open_] >> _BITS) & ((1 << (_BITS * (k + 1))) - 1))
                shared_above[open_[same]] = shared[at][same]
                seen &= ~same
            left = np.where(seen, total[at] - shared_above[open_], 0)
            different = np.where(seen, kinds[at] - kinds_above[open_], 0)
            count = np.where(seen, self._counts(k, cell), 0)
            useful = different > 0
            found = useful & (count > 0)
            room = np.maximum(left + different, 1)
            result[open_[found]] += np.log10(count[found] / room[found])
            missed = useful & ~found
            result[open_[missed]] += np.log10(different[missed] / room[missed])
            kinds_above[open_[seen]], shared_above[open_[seen]] = kinds[at][seen], shared[at][seen]
            open_ = open_[~found]
        if len(open_):
            result[open_] -= np.log10(np.maximum(_ALPHABET - kinds_above[open_], 1))
        return result


def cell_part(cells: np.ndarray, parts: int) -> np.ndarray:
    """The part of a cell: by the last two symbols of its context."""
    ending = (cells >> _BITS) & ((1 << (2 * _BITS)) - 1)
    return (mix(ending.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _chunk_words(chunk) -> tuple:
    """Bytes of a chunk; hashes of its different words; where each stands first; of all words which one; words of each text."""
    data = lower_ascii(chunk.data)
    found = words(data, chunk.offsets)
    unique, first, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
    return data, unique, first, inverse, found


def _held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 7 == 2


def _lookup(table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _statistics(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, order: int, across: bool) -> Iterator[pa.RecordBatch]:
    """Rows kind, code, count of training texts: cells of the trie (0), frequent words (1), all tokens (2), ends (3)."""
    _tries.clear()  # of an earlier model
    totals = np.zeros(len(frequent), dtype=np.int64)
    tokens = ends = 0
    held: list[tuple[np.ndarray, np.ndarray]] = []
    # Cells of frequent words, with the word's place: made once a task, counted by the word's total.
    made, of_frequent = np.zeros(len(frequent), dtype=bool), []
    rows = 0

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        cell, inverse = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
        return cell, np.bincount(inverse, weights=np.concatenate([x for _, x in parts]))

    for batch in batches:
        train = ~batch["held_out"].to_numpy(zero_copy_only=False)
        for chunk in chunks(batch["text"]):
            raw, unique, first, inverse, found = _chunk_words(chunk)
            own = train[chunk.first : chunk.first + chunk.rows]
            counts = np.bincount(inverse, weights=own[found.row_of], minlength=len(unique))
            tokens += int(counts.sum())
            ends += int(own.sum())
            at, there = _lookup(frequent, unique)
            totals[at[there]] += counts[there].astype(np.int64)
            if across:
                cell, text = text_cells(raw, found, order, across)
                held.append(np.unique(cell[own[text]], return_counts=True))
            else:
                fresh = np.flatnonzero((counts > 0) & there)
                fresh = fresh[~made[at[fresh]]]
                made[at[fresh]] = True
                cell, word = word_cells(raw, found, first[fresh], order)
                of_frequent.append((cell, at[fresh][word]))
                trained = np.flatnonzero((counts > 0) & ~there)
                cell, word = word_cells(raw, found, first[trained], order)
                held.append(summed([(cell, counts[trained][word])]))
            rows += len(held[-1][0])
            if rows > HELD_CELLS:
                held = [summed(held)]
                rows = len(held[0][0])
                if rows > HELD_CELLS // 2:
                    yield _statistic_rows(0, *held[0])
                    held, rows = [], 0
    if not across and ends:
        held.append((end_cell(order), np.array([ends])))
        held += [(cell, totals[word]) for cell, word in of_frequent]
    if held:
        yield _statistic_rows(0, *summed(held))
    used = np.flatnonzero(totals)
    yield _statistic_rows(1, used, totals[used])
    yield _statistic_rows(2, np.array([0]), np.array([tokens + ends]))
    yield _statistic_rows(3, np.array([0]), np.array([ends]))


def _statistic_rows(kind: int, code: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(code), kind, dtype=np.int32)), pa.array(code.astype(np.int64)), pa.array(count.astype(np.int64))],
        ["kind", "code", "count"],
    )


def _rare_words(batches: Iterator[pa.RecordBatch], frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows word, key, times, train of the words that are in no table, once per text."""
    for batch in batches:
        keys, train = batch["key"].to_numpy(), ~batch["held_out"].to_numpy(zero_copy_only=False)
        for chunk in chunks(batch["text"]):
            _, unique, _, inverse, found = _chunk_words(chunk)
            _, there = _lookup(frequent, unique)
            rare = ~there[inverse]
            pair = found.row_of[rare] * max(len(unique), 1) + inverse[rare]
            pair, times = np.unique(pair, return_counts=True)
            row, word = pair // max(len(unique), 1), pair % max(len(unique), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(unique[word])),
                    pa.array(keys[chunk.first + row]),
                    pa.array(times.astype(np.int32)),
                    pa.array(train[chunk.first + row]),
                ],
                ["word", "key", "times", "train"],
            )


def _sampled_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            _, unique, _, inverse, _ = _chunk_words(chunk)
            count = np.bincount(inverse, minlength=len(unique))
            yield pa.RecordBatch.from_arrays([pa.array(signed(unique)), pa.array(count.astype(np.int64))], ["word", "count"])


SUMS = "key long, n_tokens long, known long, logs double, score double"


def _sums(
    batches: Iterator[pa.RecordBatch], frequent: np.ndarray, counts: np.ndarray, trie, part: int, parts: int, order: int, across: bool
) -> Iterator[pa.RecordBatch]:
    """Per text what the tables and one part of the trie give."""
    model, costs = _trie(trie.value, order, len(frequent))
    logs = np.log10(counts + 1.0)
    end = end_cell(order)
    end_cost = float(model.costs(end)[0]) if cell_part(end, parts)[0] == part else 0.0
    for batch in batches:
        for chunk in chunks(batch["text"]):
            raw, unique, first, inverse, found = _chunk_words(chunk)
            at, there = _lookup(frequent, unique)
            log_of, known_of = np.zeros(len(unique)), np.zeros(len(unique))
            log_of[there], known_of[there] = logs[at[there]], counts[at[there]] > 0
            total = [np.bincount(found.row_of, weights=x[inverse], minlength=chunk.rows) for x in (known_of, log_of)]
            done = np.zeros(len(unique), dtype=bool)
            done[there] = ~np.isnan(costs[at[there]])
            todo = np.flatnonzero(~done)
            cell, owner = text_cells(raw, found, order, across) if across else word_cells(raw, found, first[todo], order)
            if parts > 1:
                mine = cell_part(cell, parts) == part
                cell, owner = cell[mine], owner[mine]
            code, place = np.unique(cell, return_inverse=True)
            cost = model.costs(code)[place]
            if across:
                score = np.bincount(owner, weights=cost, minlength=chunk.rows)
            else:
                of_word = np.zeros(len(unique))
                of_word[todo] = np.bincount(owner, weights=cost, minlength=len(todo))
                of_word[done] = costs[at[done]]
                costs[at[there]] = of_word[there]
                score = np.bincount(found.row_of, weights=of_word[inverse], minlength=chunk.rows) + end_cost
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"].slice(chunk.first, chunk.rows),
                    pa.array(np.diff(found.offsets) + 1),
                    pa.array(total[0].astype(np.int64)),
                    pa.array(total[1]),
                    pa.array(score),
                ],
                ["key", "n_tokens", "known", "logs", "score"],
            )


def _arrays(frame: DataFrame) -> list[np.ndarray]:
    """Columns of whole numbers, by way of Arrow: no object per value."""
    found = frame.toArrow()
    return [np.asarray(found[c].to_numpy(), dtype=np.int64) for c in frame.columns]


def _trie_part(statistics: DataFrame, part: int, parts: int) -> tuple:
    """One part of the trie and the short contexts of the whole, as arrays; workers make the trie of them."""
    cells = statistics.where("kind = 0")
    ending = f"shiftright(code, {_BITS}) & {(1 << (2 * _BITS)) - 1}"
    short = {}
    for k in (0, 1):
        own = cells.groupBy((F.col("code").bitwiseAND((1 << (_BITS * (k + 1))) - 1)).alias("code")).agg(F.sum("count").alias("count"))
        short[k] = tuple(_arrays(own.orderBy("code")))
    if parts > 1:
        (endings,) = _arrays(cells.select(F.expr(ending).alias("ending")).distinct())
        mine = endings[cell_part(endings << _BITS, parts) == part]
        wanted = statistics.sparkSession.createDataFrame([(int(x),) for x in mine], "ending long")
        cells = cells.withColumn("ending", F.expr(ending)).join(wanted, "ending")
    return (uuid.uuid4().hex, *_arrays(cells.select("code", "count")), short)


_tries: dict[str, tuple[Trie, np.ndarray]] = {}


def _trie(parts: tuple, order: int, frequent: int) -> tuple[Trie, np.ndarray]:
    """The worker's trie, of one part at a time, and what frequent words cost in it, as far as they have been met."""
    name, cells, counts, short = parts
    if name not in _tries:
        _tries.clear()
        _tries[name] = Trie(cells, counts, short, order), np.full(frequent, np.nan)
    return _tries[name]


def language_scores(
    docs: DataFrame, order: int = ORDER, part_cells: int = PART_CELLS, frequent_words: int = FREQUENT, across: bool = False
) -> DataFrame:
    """Rows doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one for each document.

    Learns from documents whose crc32 of the id modulo 7 is not 2; a document without
    an id is held out of neither. `across`: contexts go over word boundaries. A NULL or empty text is the end alone. Without
    training texts every symbol is uniform and every word unknown. Rows that repeat
    an id: see `documents.keyed`. Words are told apart by 64-bit hashes.
    """
    docs = keyed(docs)
    spark = docs.sparkSession
    held = F.coalesce(_held_out(F.col("doc_id")), F.lit(False))
    texts = docs.select("key", "text", held.alias("held_out"))
    rows = max(1, docs.select("key").count())
    share = max(1, rows // SAMPLE_DOCUMENTS)
    sample = texts.where(F.pmod(F.xxhash64("key"), F.lit(share)) == 0)
    top = (
        sample.select("text")
        .mapInArrow(_sampled_words, "word long, count long")
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "word")
        .limit(frequent_words)
        .select("word")
    )
    frequent = np.sort(_arrays(top)[0].view(np.uint64))

    statistics = texts.select("text", "held_out").mapInArrow(
        partial(_statistics, frequent=frequent, order=order, across=across), "kind int, code long, count long"
    )
    statistics = cut_lineage(statistics.groupBy("kind", "code").agg(F.sum("count").alias("count")))
    counts = np.zeros(len(frequent), dtype=np.int64)
    places, found = _arrays(statistics.where("kind = 1").select("code", "count"))
    counts[places] = found
    totals = statistics.where("kind = 2").agg(F.sum("count")).first()
    train_tokens = int(totals[0] or 0)

    of_word = Window.partitionBy("word")
    rare = (
        texts.mapInArrow(partial(_rare_words, frequent=frequent), "word long, key long, times int, train boolean")
        .withColumn("count", F.sum(F.when(F.col("train"), F.col("times")).otherwise(0)).over(of_word))
        .withColumn("first", F.row_number().over(of_word.orderBy("key")) == 1)
        .groupBy("key")
        .agg(
            F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
            F.sum(F.col("times") * F.log10(F.col("count") + 1)).alias("rare_logs"),
            F.sum((F.col("first") & (F.col("count") > 0)).cast("long")).alias("rare_kinds"),
        )
    )
    rare = cut_lineage(rare)
    rare_kinds = rare.agg(F.sum("rare_kinds")).first()[0] or 0
    ends = statistics.where("kind = 3").agg(F.sum("count")).first()[0] or 0
    kinds = int((counts > 0).sum()) + int(rare_kinds) + (1 if ends else 0)
    room = float(np.log10(train_tokens + kinds + 1))

    parts = max(1, -(-statistics.where("kind = 0").count() // part_cells))
    sums = None
    for part in range(parts):
        trie = spark.sparkContext.broadcast(_trie_part(statistics, part, parts))
        work = partial(_sums, frequent=frequent, counts=counts, trie=trie, part=part, parts=parts, order=order, across=across)
        one = texts.select("key", "text").mapInArrow(work, SUMS)
        sums = one if sums is None else sums.unionAll(one)
    if parts > 1:
        sums = sums.groupBy("key").agg(
            *(F.max(x).alias(x) for x in ("n_tokens", "known", "logs")), F.sum("score").alias("score")
        )
    known = F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(1 if ends else 0)
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 1)))
    ids = docs.select("key", "doc_id", held.alias("held_out"))
    return (
        sums.join(rare, "key", "left")
        .join(ids, "key")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            known.cast("long").alias("n_known"),
            F.lit(train_tokens).cast("long").alias("train_tokens"),
            (logs - F.col("n_tokens") * room).alias("base_score"),
            "score",
        )
    )
