"""Token ids of a corpus in files of Simple-8b words, in the order of the documents.

Documents are dealt out by ranges of their id and written in order; every range is a
shard. A stored row holds the words of some whole documents, the offset of each
block, the documents' ids and lengths, and how many ids of the shard stand before.
The files are Parquet, so they lie wherever Spark can write, and each row can be
decoded by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .documents import keyed
from .simple8b import decode, encode
from .tokens import text_ids

STORED = (
    "shard int, before long, doc_ids array<bigint>, lengths array<bigint>, ids long, words binary, block_offsets binary"
)


def _stored(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    shard, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        for first, ids, offsets in text_ids(batch["text"], tokenizer, end_id):
            coded, blocks = encode(ids)
            rows = len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([batch["doc_id"][first : first + rows].to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(offsets)], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([coded.astype("<u8").tobytes()], pa.binary()),
                    pa.array([blocks.astype("<u4").tobytes()], pa.binary()),
                ],
                ["shard", "before", "doc_ids", "lengths", "ids", "words", "block_offsets"],
            )
            before += len(ids)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode whole texts (NULL: empty), each followed by `end_id`, in ascending order of id.

    Rows that repeat an id or have none: see `documents.keyed`; a document without
    an id comes last. An empty table writes an empty table.
    """
    docs = keyed(docs)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.repartitionByRange(parts, "key").sortWithinPartitions("key")
    ordered.select("doc_id", "text").mapInArrow(
        partial(_stored, tokenizer=tokenizer, end_id=end_id), STORED
    ).write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch], bases: dict[int, int], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            lengths = np.array(batch["lengths"][row].as_py(), dtype=np.int64)
            coded = np.frombuffer(batch["words"][row].as_buffer(), dtype="<u8")
            blocks = np.frombuffer(batch["block_offsets"][row].as_buffer(), dtype="<u4")
            ids = decode(coded, blocks, batch["ids"][row].as_py()).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            base = bases[batch["shard"][row].as_py()] + batch["before"][row].as_py()
            pieces = [ids[a:b] for a, b in zip(starts, ends)]
            columns = {
                "doc_id": batch["doc_ids"][row].values,
                "start": pa.array(starts + base),
                "n_tokens": pa.array(lengths),
                "ids_crc32": pa.array([zlib.crc32(x) for x in pieces], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(pieces, pa.list_(pa.uint32())).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(columns)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Rows doc_id, start, n_tokens, ids_crc32 and, if asked for, ids of written files.

    `start` counts the ids of all documents before. Only one total per shard comes
    to the driver.
    """
    stored = spark.read.parquet(path)
    totals = dict(stored.groupBy("shard").agg(F.sum("ids")).collect())
    bases, before = {}, 0
    for shard in sorted(totals):
        bases[shard] = before
        before += totals[shard]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<bigint>" * with_ids
    return stored.mapInArrow(partial(_read, bases=bases, with_ids=with_ids), schema)
