"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints at most three bits apart agree on one of two 32-bit halves up to one bit. Every different
fingerprint is indexed under 64 signatures, each a half with one bit deleted; equal signatures meet, and the whole
distance is checked. A link is looked at under one signature only (the first half that agrees; the bit that differs,
or bit 0 where the halves are equal), and of the links under a signature only a spanning forest is kept, so a group of
n fingerprints costs n - 1 rows, not all pairs.

A signature under which very many fingerprints lie is not compared as it is: the other half is cut into four pieces,
of which one must agree, and so on, until what is left to differ bounds the group (at most 2**14 fingerprints).

Linked groups are joined with large-star and small-star steps (Kiveris et al.) on written tables.

Defined cases: a null or empty text has fingerprint zero and links like any other; repeated rows share a fingerprint;
a null doc_id is a row like any other but never names a component unless all of its ids are null; an empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import plain, rows_chosen, text_key
from tallyguard.plans.scratch import write_once

SEED = 42
#: fingerprints under a signature from which on it is refined; results do not depend on it
CROWD = 4096
#: bytes of a signature's row, and how many of them a task makes
ENTRY_BYTES, TASK_BYTES = 24, 16 << 20
#: (lowest bit, width) of the pieces that the 32, then 24, then 18 bits are cut into which may still differ
CUTS = (
    ((0, 8), (8, 8), (16, 8), (24, 8)),
    ((0, 6), (6, 6), (12, 6), (18, 6)),
    ((0, 5), (5, 5), (10, 4), (14, 4)),
)


def simhash(text: str, shingle: int) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles, repeats included."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in map(b" ".join, grams)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id``, ``key`` of the text and ``fp``, the fingerprint as a signed 64-bit integer, for every row."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = np.array([simhash(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(found.view(np.int64))], ["doc_id", "key", "fp"]
                )

    keyed = plain(docs).withColumn("key", text_key())
    return keyed.mapInArrow(run, "doc_id long, key binary, fp long")


def _signatures():
    """Under each of 64 signatures: its number, and the half with the bit deleted, as one integer."""
    for number in range(64):
        half = F.shiftrightunsigned("fp", 32) if number < 32 else F.col("fp").bitwiseAND(0xFFFFFFFF)
        masked = half.bitwiseAND(0xFFFFFFFF ^ (1 << (number % 32)))
        yield F.struct(F.lit(number).alias("number"), masked.alias("part"))


def _without(k: int, at: int, width: int):
    """Piece ``k`` of the column ``rest``, and the bits that are left when it is taken out."""
    above = F.shiftleft(F.shiftrightunsigned("rest", at + width), at)
    below = F.col("rest").bitwiseAND((1 << at) - 1)
    same = F.shiftrightunsigned("rest", at).bitwiseAND((1 << width) - 1)
    return F.struct(F.lit(k).alias("k"), same.alias("same"), above.bitwiseOR(below).alias("rest"))


def _linked(fps: np.ndarray, number: int, distance: int):
    """Spanning forest of the links that belong to signature ``number`` among the fingerprints of one group."""
    high, bit = number < 32, number % 32
    own = np.uint64(1 << (bit + (32 if high else 0)))

    def near(x):
        ok = np.bitwise_count(x) <= distance
        if bit:
            ok &= (x & own) != 0
        if not high:
            ok &= np.bitwise_count(x >> np.uint64(32)) > 1
        return ok

    if len(fps) == 2:
        return [(0, 1)] if near(fps[:1] ^ fps[1:])[0] else []
    left, frontier, edges = np.arange(len(fps)), [], []
    while len(left):
        if not frontier:
            frontier.append(left[0])
            left = left[1:]
        u = frontier.pop()
        hit = near(fps[left] ^ fps[u])
        if hit.any():
            found = left[hit]
            edges += [(u, v) for v in found]
            frontier += list(found)
            left = left[~hit]
    return edges


def _compare(distance: int):
    """Edges among runs of equal (group, number) in sorted rows of group, number, fp."""

    def edges_of(group, number, fps):
        starts = np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]) | (number[1:] != number[:-1])) + 1, [len(group)]])
        sizes = np.diff(starts)
        a, b = [], []
        for k in np.flatnonzero(sizes > 1):
            lo, hi = starts[k], starts[k + 1]
            for u, v in _linked(fps[lo:hi], int(number[lo]), distance):
                a.append(fps[lo + u])
                b.append(fps[lo + v])
        if a:
            x = np.array([a, b], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x.max(axis=0)), pa.array(x.min(axis=0))], ["u", "v"])

    def stream(batches):
        held = None
        for batch in batches:
            now = [np.asarray(batch.column(i)) for i in range(3)]
            now[2] = now[2].view(np.uint64)
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if cut:
                yield from edges_of(*(x[:cut] for x in now))
            held = [x[cut:] for x in now]
        if held is not None:
            yield from edges_of(*held)

    return stream


def links(fps: DataFrame, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Edges ``u`` > ``v`` whose connected groups are those of all links; ``fps`` holds different fingerprints."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments and one wildcard find distances up to 3")
    fps = write_once(fps, "distinct-fingerprints")
    # the table is small where its signatures are not: deal it by what comes out
    spread = max(1, math.ceil(64 * ENTRY_BYTES * fps.count() / TASK_BYTES))
    entries = fps.repartition(spread, "fp").select("fp", F.explode(F.array(*_signatures())).alias("s")).select(
        F.shiftleft("s.part", 6).bitwiseOR(F.col("s.number")).alias("group"), F.col("s.number").alias("number"), "fp"
    )
    other = F.when(F.col("number") < 32, F.col("fp").bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned("fp", 32))
    entries = entries.withColumn("rest", other)
    found = None
    for pieces in [*CUTS, None]:
        light = entries
        if pieces is not None:
            counts = entries.groupBy("group", "number").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
            heavy = write_once(counts.select("group", "number"), "crowds")
            if heavy.isEmpty():
                pieces = None
            else:
                light = entries.join(heavy, ["group", "number"], "left_anti")
        edges = (
            light.select("group", "number", "fp")
            .repartition("group")
            .sortWithinPartitions("group", "number", "fp")
            .mapInArrow(_compare(distance), "u long, v long")
        )
        found = edges if found is None else found.unionByName(edges)
        if pieces is None:
            break
        finer = F.array(*[_without(k, at, width) for k, (at, width) in enumerate(pieces)])
        entries = (
            entries.join(heavy, ["group", "number"], "left_semi")
            .select("group", "number", "fp", F.explode(finer).alias("p"))
            .select(F.xxhash64("group", "p.k", "p.same").alias("group"), "number", "fp", F.col("p.rest").alias("rest"))
        )
    return found.distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node of its group, for every node of the edges (``u`` > ``v``)."""
    edges, before = write_once(edges, "links"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_once(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_once(least.select("u", F.col("m").alias("v")).unionByName(moved).distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = state
    raise RuntimeError("the components did not settle")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Every row's ``doc_id``, ``key`` and ``fp``, its group's ``root`` and smallest doc_id, ``component_id``."""
    rows = write_once(fingerprints(docs, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(links(fps.select("fp"), distance, crowd))
    named = fps.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = write_once(named, "components")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(heads, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``docs`` with all columns, one row of each group: the one with the smallest doc_id, nulls last."""
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    kept = near_duplicates(docs, shingle, distance).groupBy("root").agg(F.min(order).alias("row"))
    kept = rows_chosen(docs, kept.select("row.doc_id", "row.key"), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])  # of rows with one doc_id and one text, one
