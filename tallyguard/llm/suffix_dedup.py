"""Removal of byte strings that occur more than once, by distributed prefix doubling.

A position's rank stands for the bytes that follow it: two positions have the same rank if these agree. The first rank,
for a quarter of ``length`` or what halving it above ``gram`` bytes gives, is a 64-bit hash. Each round pairs a
position's rank with that of the position ``shift`` bytes on, counts equal pairs (with map-side combine), sorts those
that more than one position has, numbers them in that order and hands the numbers back as ranks for ``shift`` bytes
more. Positions whose pair is unique leave, and with them each one that needs their rank. Ranks for 400 bytes come from
those for 100 and 200.

Anchors prune the first round only (see ``repeats``): positions whose strings share an anchor, and then ``TOGETHER``
neighbours at a time, are left out where the bytes common to their strings occur once, and settled where the whole
block of their strings occurs again. What neither test decides is ranked, each position on its own, and with it the
positions whose ranks it needs.

A round moves three narrow rows for each position that is left. Equal pairs are met by a shuffle join that splits
skewed keys; the neighbour at ``shift`` is found by a window over positions of one text with the same remainder, which
holds a text's length divided by ``shift`` rows at most.

Defined cases: a null or empty text has no bytes and nothing to remove; a text shorter than ``length`` keeps all;
copies of a text of at least ``length`` bytes lose all of it, every one of them; repeated rows count as copies;
an empty table gives no rows. Matches never cross texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.repeats import FIELD, Repeats, grouped_runs, narrowed, texts_of, units_of, without_runs
from tallyguard.plans.scratch import write_once

PAIRS = "t long, at long, a long, b long"
#: neighbouring positions that the second pruning test takes together
TOGETHER = 48


def lengths(length: int, gram: int) -> list[int]:
    """Bytes that ranks stand for, round by round, the last ``length``."""
    sizes = [length]
    while len(sizes) < 2 or (sizes[0] + 1) // 2 >= gram:
        sizes.insert(0, (sizes[0] + 1) // 2)
    return sizes


def offsets(sizes: list[int]) -> np.ndarray:
    """How far from a position ranks for ``sizes[1]`` bytes are needed to rank it for all of ``sizes[-1]``."""
    needed = {0}
    for small, large in zip(sizes[1:], sizes[2:]):
        needed |= {x + large - small for x in needed}
    return np.array(sorted(needed), np.int64)


def first_ranks(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes that start at each position, from two runs of a power of two of bytes."""
    with np.errstate(over="ignore"):
        part, factor = 1, 0xD1342543DE82EF95
        while 2 * part <= size:
            hashes = hashes[:-part] * np.uint64(factor) + hashes[part:]
            factor, part = factor * factor % 2**64, 2 * part
        hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        if part < size:
            hashes = hashes[: part - size] * np.uint64(0x9E3779B97F4A7C15) + hashes[size - part :]
            hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def _wanted(refs: np.ndarray, reach: np.ndarray, end: int) -> np.ndarray:
    """Positions, ascending, that have to be ranked for the runs in ``refs``."""
    place, near, far = refs >> (2 * FIELD), (refs >> FIELD) & ((1 << FIELD) - 1), refs & ((1 << FIELD) - 1)
    edges = np.zeros(end + 1, np.int32)
    for shift in reach:
        np.add.at(edges, place - far + shift, 1)
        np.add.at(edges, place - near + shift + 1, -1)
    return np.flatnonzero(np.cumsum(edges[:-1]))


def _first_pairs(length: int, gram: int):
    sizes = lengths(length, gram)
    reach, shift = offsets(sizes), sizes[1] - sizes[0]

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts, ids, refs = (batch.column(names.index(c)) for c in ("text", "t", "refs"))
            for i in range(batch.num_rows):
                _, _, hashes = units_of(texts[i].as_py(), "bytes")
                ranks = first_ranks(hashes, sizes[0]).view(np.int64)
                at = _wanted(refs[i].values.to_numpy(), reach, len(ranks) - shift)
                for part in np.array_split(at, len(at) // 65536 + 1):
                    columns = [np.full(len(part), ids[i].as_py(), np.int64), part, ranks[part], ranks[part + shift]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["t", "at", "a", "b"])

    return run


def reranked(pairs: DataFrame) -> DataFrame:
    """``t``, ``at`` and ``rank`` of the positions whose pair another one has too."""
    again = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    # ascending ids in sorted order, written so that they stay what they are
    ranks = write_once(again.sort("a", "b").withColumn("rank", F.monotonically_increasing_id()), "ranks")
    return pairs.join(ranks, ["a", "b"]).select("t", "at", "rank")


def next_pairs(ranked: DataFrame, shift: int) -> DataFrame:
    """Each position's rank with that of the position ``shift`` bytes on; without one it is unique and leaves."""
    same = Window.partitionBy("t", F.col("at") % shift).orderBy("at")
    ahead = F.lead(F.struct("at", "rank")).over(same)
    paired = ranked.withColumn("ahead", ahead).filter(F.col("ahead.at") == F.col("at") + shift)
    return paired.select("t", "at", F.col("rank").alias("a"), F.col("ahead.rank").alias("b"))


def repeated_positions(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """``k1``, ``k2`` of a text and ``runs`` (first, last) of positions whose ``length`` bytes start elsewhere too."""
    widest = length - gram + 1
    steps = (widest, TOGETHER) if widest > TOGETHER else (widest,)
    settled, refs = narrowed(docs, _spec(length, gram), steps)
    if refs is None:
        return grouped_runs(settled)
    refs = write_once(refs.withColumn("t", F.monotonically_increasing_id()), "open")
    sizes = lengths(length, gram)
    pairs = texts_of(docs, refs, "t").mapInArrow(_first_pairs(length, gram), PAIRS)
    for small, large in zip(sizes[1:], sizes[2:]):
        pairs = write_once(pairs, "pairs")
        pairs = next_pairs(reranked(pairs), large - small)
    found = reranked(write_once(pairs, "pairs"))
    in_text = Window.partitionBy("t").orderBy("at")
    islands = found.withColumn("island", F.col("at") - F.row_number().over(in_text))
    runs = islands.groupBy("t", "island").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    runs = runs.join(refs.select("t", "k1", "k2"), "t").select("k1", "k2", "first", "last")
    return grouped_runs(settled.unionByName(runs))


def _spec(length: int, gram: int) -> Repeats:
    widest = length - gram + 1
    return Repeats("bytes", length, gram, (widest, 1) if widest > 1 else (1,))


def remove_repeated_bytes(docs: DataFrame, length: int = 400, gram: int = 64) -> DataFrame:
    """``doc_id``, ``units`` (bytes), removed ``spans`` and ``kept`` bytes of every row."""
    return without_runs(docs, repeated_positions(docs, length, gram), _spec(length, gram))
