"""Near-duplicate documents by one-permutation hashing.

A document's set are its distinct runs of words, as 64-bit hashes. One hash function
deals the set out to bins; a bin's value is the smallest hash in it, and an empty bin
borrows from the bin that a hash of its number and the attempt points to, until one
is filled (optimal densification). Bins are joined to bands; documents that agree in
a band share its bucket. Bands are chosen so that a pair at the threshold is missed
with a probability below one in a million.

A bucket gives a star: edges from one member to all others, never its pairs. Each
document checks its strongest edge on the full sets, and then those edges whose ends
are not connected yet. What the stars leave open are buckets whose members are not all
connected by then. In small ones the members outside the largest component are checked
with all others of a different one; in larger ones all members are answered from how
their sets differ from the star's centre (see `set_join`), which never makes the pairs
of a group. Equal sets are one document from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import connected
from .documents import keyed, plain_ids
from .set_join import around_centres, compared_pairs, stored_sets
from .shingles import shingle_sets
from .textscan import chunks, mix, signed

SHINGLE = 5
#: Similarity in hundredths from which documents are linked.
PERCENT = 80
BINS = 128
MISSED = 1e-6
#: Members of a star that are checked together with one copy of its centre.
STAR = 500
#: Members of an open bucket up to which they are compared with each other.
CROWD = 64
#: How much larger than the smallest set of a class of sizes its sets can be.
CLASS = 4


def rows_per_band(percent: int) -> int:
    """Most bins per band that keep the chance of missing a pair at the threshold small."""
    for rows in range(16, 1, -1):
        if (1 - (percent / 100) ** rows) ** (BINS // rows) <= MISSED:
            return rows
    return 1


def signatures(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Matrix of the bins of each set; rows of empty sets mean nothing."""
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(offsets))
    cell = row * BINS + (values >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(cell), dtype=bool)
    first[1:] = cell[1:] != cell[:-1]
    table = np.zeros(rows * BINS, dtype=np.uint64)
    filled = np.zeros(rows * BINS, dtype=bool)
    table[cell[first]] = values[first]
    filled[cell[first]] = True
    wanting = np.flatnonzero(~filled)
    wanting = wanting[np.diff(offsets)[wanting // BINS] > 0]
    attempt = 0
    while len(wanting):
        attempt += 1
        own = (wanting % BINS).astype(np.uint64)
        lender = mix(own * np.uint64(0x100000001B3) + mix(np.array([attempt], dtype=np.uint64))) % np.uint64(BINS)
        source = wanting - wanting % BINS + lender.astype(np.int64)
        found = filled[source]
        table[wanting[found]] = table[source[found]]
        wanting = wanting[~found]
    return table.reshape(rows, BINS)


def _signed_documents(batches: Iterator[pa.RecordBatch], length: int, fold_case: bool, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in chunks(batch["text"]):
            values, offsets = shingle_sets(chunk.data, chunk.offsets, length, fold_case)
            sizes = np.diff(offsets)
            total = np.zeros((2, len(values) + 1), dtype=np.uint64)
            np.cumsum(mix(values), out=total[0, 1:])
            np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
            whole = total[:, offsets[1:]] - total[:, offsets[:-1]]
            table = signatures(values, offsets)
            bands = np.zeros((len(sizes), BINS // rows), dtype=np.uint64)
            for band in range(bands.shape[1]):
                key = np.full(len(sizes), band + 1, dtype=np.uint64)
                for i in range(band * rows, (band + 1) * rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, i])
                bands[:, band] = key
            places = np.append(0, np.cumsum(np.where(sizes > 0, bands.shape[1], 0)))
            part = slice(chunk.first, chunk.first + chunk.rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"][part],
                    batch["doc_id"][part],
                    pa.array(sizes.astype(np.int64)),
                    pa.array(signed(whole[0].copy())),
                    pa.array(signed(whole[1].copy())),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(signed(bands[sizes > 0].reshape(-1)))),
                ],
                ["key", "doc_id", "n_shingles", "set_high", "set_low", "bands"],
            )


SIGNED = "key long, doc_id long, n_shingles long, set_high long, set_low long, bands array<bigint>"


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) else 0
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def _checked_stars(batches: Iterator[pa.RecordBatch], length: int, fold_case: bool, percent: int) -> Iterator[pa.RecordBatch]:
    """Sorted by star with its centre first: the edges whose sets are similar."""
    centre, centre_set = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        stars, keys = batch["centre"].to_numpy(), batch["key"].to_numpy()
        out: tuple[list, list] = ([], [])
        for chunk in chunks(batch["text"]):
            values, offsets = shingle_sets(chunk.data, chunk.offsets, length, fold_case)
            for row in range(chunk.rows):
                star, key = stars[chunk.first + row], keys[chunk.first + row]
                own = values[offsets[row] : offsets[row + 1]]
                if star == key:
                    centre, centre_set = star, own.copy()
                elif star == centre and similar(centre_set, own, percent):
                    out[0].append(star)
                    out[1].append(key)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b"])


def _size_fits(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _open_links(texts: DataFrame, rows: DataFrame, length: int, fold_case: bool, percent: int, crowd: int) -> list[DataFrame]:
    """Links that connect different components inside a bucket.

    `rows` are those of the buckets with several components: band, place, key,
    n_shingles, component, bands, members, centre. In a bucket of at most `crowd`
    members those outside its largest component are compared with all of another
    one, each pair once. In larger ones every member is answered from how it differs
    from a centre of all buckets that hang together, so that nothing is made for pairs
    that share no difference.
    """
    small, large = rows.where(F.col("members") <= crowd), rows.where(F.col("members") > crowd)
    parts = small.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    few = small.join(largest, "band").where("component <> largest").alias("x")
    # An earlier small bucket that both share has brought the pair already.
    earlier = F.arrays_overlap(F.col("x.before"), F.col("y.before"))
    pairs = few.join(
        small.alias("y"),
        (F.col("x.band") == F.col("y.band"))
        & (F.col("x.component") != F.col("y.component"))
        & ((F.col("y.component") == F.col("x.largest")) | (F.col("x.key") < F.col("y.key")))
        & _size_fits("x.n_shingles", "y.n_shingles", percent)
        & ~earlier,
    ).select(F.col("x.key").alias("centre"), F.col("y.key").alias("key"))
    stars = cut_lineage(_group_stars(large, percent))
    sets = stored_sets(texts.join(rows.select("key").distinct(), "key"), length, fold_case)
    placed = cut_lineage(large.select("key", "component").distinct())
    return [compared_pairs(pairs, sets, percent), *around_centres(stars, sets, placed, percent)]


def _group_stars(large: DataFrame, percent: int) -> DataFrame:
    """Rows centre, key: members of buckets that hang together, with one centre for each class of sizes.

    The buckets of a family have many members in common, and each its own centre. A set
    is answered once around the centre of all, not once for each bucket's. Sizes of a class
    differ by a factor of `CLASS` at most, so that a difference is not longer than a
    few times the set; sets that can be linked with some of the class below are in that too.
    """
    near = large.select(F.col("centre").alias("a"), F.col("key").alias("b")).where("a <> b").distinct()
    group = connected(near).select(F.col("node").alias("key"), F.col("component").alias("group"))
    sizes = large.groupBy("key", "n_shingles").agg(F.sum("members").alias("company"))
    own = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(CLASS) + 1e-9)
    fits_below = F.col("n_shingles") * percent <= 100 * F.pow(F.lit(float(CLASS)), F.col("own"))
    dealt = sizes.join(group, "key").withColumn("own", own)
    dealt = dealt.withColumn("kind", F.explode(F.when(fits_below, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))))
    centres = dealt.groupBy("group", "kind").agg(F.max(F.struct("company", (-F.col("key")).alias("minus"))).alias("top"))
    centres = centres.select("group", "kind", (-F.col("top.minus")).alias("centre"))
    return dealt.join(centres, ["group", "kind"]).select("centre", "key").distinct()


def _checked(edges: DataFrame, texts: DataFrame, length: int, fold_case: bool, percent: int) -> DataFrame:
    """Edges key, centre whose full sets are similar, as a, b; a large star goes to several tasks, each with its centre."""
    shares = edges.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / STAR).alias("shares"))
    own = edges.join(shares, "centre").select("centre", "key", F.pmod(F.xxhash64("key"), F.col("shares")).alias("share"))
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))
    points = own.union(shares.select("centre", F.col("centre").alias("key"), turns.alias("share")))
    return cut_lineage(
        points.join(texts, "key")
        .select("centre", "share", "key", "text")
        .repartition("centre", "share")
        .sortWithinPartitions("centre", "share", F.col("key") != F.col("centre"), "key")
        .select("centre", "key", "text")
        .mapInArrow(partial(_checked_stars, length=length, fold_case=fold_case, percent=percent), "a long, b long")
    )


def _placed(placing: DataFrame, links: DataFrame) -> DataFrame:
    """Rows key, component after joining the components that links connect."""
    one = placing.select(F.col("key").alias("a"), F.col("component").alias("one"))
    two = placing.select(F.col("key").alias("b"), F.col("component").alias("two"))
    joined = links.join(one, "a").join(two, "b").where("one <> two")
    between = cut_lineage(joined.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct())
    if between.isEmpty():
        return placing
    merged = connected(between).select(F.col("node").alias("component"), F.col("component").alias("merged"))
    return cut_lineage(
        placing.join(merged, "component", "left").select("key", F.coalesce("merged", "component").alias("component"))
    )


def near_duplicates(
    docs: DataFrame,
    length: int = SHINGLE,
    percent: int = PERCENT,
    fold_case: bool = True,
    has_keys: bool = False,
    crowd: int = CROWD,
) -> DataFrame:
    """Rows key, doc_id, n_shingles, component_id, kept: one for each document.

    component_id is the smallest id that links reach, kept whether it is the row's
    own. Texts that are NULL, empty or without words have no set and no links. Rows
    that repeat an id: see `documents.keyed`; without an id component_id may be
    NULL. An empty table gives no rows.
    """
    docs = docs if has_keys else keyed(docs)
    rows = rows_per_band(percent)
    signed_docs = cut_lineage(
        docs.mapInArrow(partial(_signed_documents, length=length, fold_case=fold_case, rows=rows), SIGNED)
    )
    same_set = ["set_high", "set_low", "n_shingles"]
    filled = signed_docs.where("n_shingles > 0")
    sets = cut_lineage(filled.groupBy(*same_set).agg(F.min("key").alias("key"), F.min_by("bands", "key").alias("bands")))

    buckets = sets.select("key", "n_shingles", F.posexplode("bands").alias("place", "band"))
    crowds = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    member = cut_lineage(buckets.join(crowds, "band").select("band", "place", "key", "n_shingles", "members"))
    # A star's centre is the member with most company in all its buckets: copies differ less from it than from each other.
    company = member.groupBy("key").agg(F.sum("members").alias("company"))
    centres = cut_lineage(
        member.join(company, "key")
        .groupBy("band")
        .agg(F.max(F.struct("company", (-F.col("key")).alias("minus"), F.col("n_shingles").alias("size"))).alias("top"))
        .select("band", (-F.col("top.minus")).alias("centre"), F.col("top.size").alias("centre_size"), F.col("top.company").alias("weight"))
    )
    edges = (
        member.join(centres, "band")
        .where("key <> centre")
        .where(_size_fits("n_shingles", "centre_size", percent))
        .groupBy("key", "centre")
        .agg(F.count(F.lit(1)).alias("bands"), F.max("weight").alias("weight"))
    )
    edges = cut_lineage(edges)
    first = edges.groupBy("key").agg(F.max(F.struct("bands", "weight", (-F.col("centre")).alias("minus"))).alias("top"))
    first = cut_lineage(first.select("key", (-F.col("top.minus")).alias("centre")))
    texts = cut_lineage(docs.select("key", "text").join(member.select("key").distinct(), "key"))
    check = partial(_checked, texts=texts, length=length, fold_case=fold_case, percent=percent)

    placing = cut_lineage(sets.select("key", F.col("key").alias("component")))
    placing = _placed(placing, check(first))
    others = edges.select("key", "centre").join(first, ["key", "centre"], "left_anti")
    others = others.join(placing, "key").withColumnRenamed("component", "own")
    others = others.join(placing.select(F.col("key").alias("centre"), "component"), "centre").where("own <> component")
    others = cut_lineage(others.select("key", "centre"))
    if not others.isEmpty():
        placing = _placed(placing, check(others))
    member = cut_lineage(member.join(placing, "key").select("band", "place", "key", "n_shingles", "component", "members"))
    divided = member.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    of_band = centres.select("band", "centre").join(divided.select("band"), "band")
    open_rows = cut_lineage(member.join(of_band, "band"))
    if not open_rows.isEmpty():
        # For each row the small open buckets of its document that come before it.
        own = open_rows.where(F.col("members") <= crowd).groupBy("key").agg(F.collect_list(F.struct("place", "band")).alias("own"))
        open_rows = open_rows.join(own, "key", "left").withColumn(
            "before", F.expr("transform(filter(own, x -> x.place < place), x -> x.band)")
        )
        open_rows = cut_lineage(open_rows.drop("own"))
        found = _open_links(texts, open_rows, length, fold_case, percent, crowd)
        placing = _placed(placing, cut_lineage(reduce(DataFrame.union, found).distinct()))

    of_set = sets.join(placing, "key").select(*same_set, "component")
    placed = signed_docs.select("key", "doc_id", *same_set).join(of_set, same_set, "left")
    placed = placed.select("key", "doc_id", "n_shingles", F.coalesce("component", "key").alias("component"))
    if plain_ids(docs):
        placed = placed.withColumn("component_id", F.col("component"))
    else:
        placed = cut_lineage(placed)
        names = placed.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
        placed = placed.join(names, "component")
    return placed.select("key", "doc_id", "n_shingles", "component_id", (F.col("key") == F.col("component")).alias("kept"))
