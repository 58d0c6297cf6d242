"""Strings of a fixed length that start at more than one place of a table of texts, found exactly.

A text is a run of units: bytes, or words. Wanted is every position whose next ``length`` units start anywhere else
too. Sorting all positions of a large table is out of reach, so positions are grouped without loss:

* The anchor of a position is the ``gram`` with the smallest hash among those inside its string (leftmost on a tie).
  It depends on the string alone, so equal strings have equal anchors at equal distance. Each anchor stands for the
  run of positions that have it: about two anchors for each ``length - gram + 1`` positions.
* All positions at a distance in [x0, x0 + step) before an anchor share a core, the units that lie in all their
  strings. Where a core starts nowhere else, no string there repeats. They also lie in one block; where the whole
  block repeats, all of them do. What neither test settles is cut into smaller steps, down to single positions, whose
  core and block are the string itself; one place of each settled block with the same core goes along.

Cores are ranked by one 64-bit hash, equal blocks by a second one together with the first. Each round counts hashes
(with map-side combine) and joins the counts back with a shuffle join that splits skewed keys; no group is gathered.
The strings of one round extend those of the round before, and what became unique is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import plain
from tallyguard.plans.scratch import write_once

RECORD = "k1 long, k2 long, ref long, core long, block long"
#: bits of a reference: anchor, nearest and farthest distance
FIELD = 12


@dataclass(frozen=True)
class Repeats:
    """``steps`` are the distances tested together in each round; the first is ``length - gram + 1``, the last 1."""

    units: str
    length: int
    gram: int
    steps: tuple[int, ...]

    def __post_init__(self):
        if self.gram & (self.gram - 1) or not 0 < self.length - self.gram + 1 < 1 << FIELD:
            raise ValueError("gram must be a power of two, and length less than 4096 above it")
        if self.steps[0] != self.length - self.gram + 1 or self.steps[-1] != 1:
            raise ValueError("steps go from length - gram + 1 to 1")


def units_of(text: str, kind: str):
    """A text's units: the bytes that hold them, where each starts (with the end), and a 64-bit hash for each."""
    import xxhash

    if kind == "bytes":
        data = text.encode()
        codes = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            hashes = codes * np.uint64(0x9E3779B97F4A7C15)
            hashes ^= hashes >> np.uint64(29)
            hashes *= np.uint64(0xBF58476D1CE4E5B9)
        return data, None, hashes
    words = text.encode().split()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    return b" ".join(words) + b" ", starts, hashes


def anchors(hashes: np.ndarray, length: int, gram: int, part: int = 1 << 22):
    """Anchors of all positions: (place, first position, last position), ascending."""
    n, window = len(hashes), length - gram + 1
    found = []
    for at in range(0, n - length + 1, part):
        own = hashes[at : at + part + length - 1]
        with np.errstate(over="ignore"):
            size, factor = 1, 0x9E3779B97F4A7C15 | 1
            grams = own
            while size < gram:
                grams = grams[:-size] * np.uint64(factor) + grams[size:]
                factor, size = factor * factor % 2**64, 2 * size
            grams = grams ^ (grams >> np.uint64(31))
            grams = grams * np.uint64(0x94D049BB133111EB)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        size = 1
        while 2 * size <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < window:
            least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64) + at
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        last = np.append(first[1:], len(place)) - 1
        found.append((place[first], first + at, last + at))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    place, first, last = (np.concatenate(x) for x in zip(*found))
    new = np.append(True, place[1:] != place[:-1])  # an anchor may go on in the next part
    return place[new], first[new], last[np.append(new[1:], True)]


def _records(text: str, refs: np.ndarray | None, spec: Repeats, step: int, only_core: bool):
    """References, core and block hashes of a text, in steps of ``step`` distances; ``refs`` None: all anchors."""
    import xxhash

    data, starts, hashes = units_of(text, spec.units)
    n, length = len(hashes), spec.length
    if n < length:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none
    if refs is None:
        place, first, last = anchors(hashes, length, spec.gram)
        near, far = place - last, place - first
    else:
        place, near, far = refs >> (2 * FIELD), (refs >> FIELD) & ((1 << FIELD) - 1), refs & ((1 << FIELD) - 1)
        pieces = far // step - near // step + 1
        row = np.repeat(np.arange(len(place)), pieces)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        x0 = (near[row] // step + nth) * step
        place, near, far = place[row], np.maximum(near[row], x0), np.minimum(far[row], x0 + step - 1)
    x0 = near // step * step
    lo, hi = place - x0, place - x0 - step + 1 + length
    low, high = np.maximum(place - x0 - step + 1, 0), np.minimum(place - x0 + length, n)
    clip = (x0 << 40) + ((low - (place - x0 - step + 1)) << 20) + (place - x0 + length - high)
    if starts is not None:
        lo, hi, low, high = starts[lo], starts[hi], starts[low], starts[high]
    digest = xxhash.xxh3_64_intdigest
    # the same bytes at two distances belong to two anchors of one place, so the distance is part of the hash
    core = _mixed([digest(data[a:b]) for a, b in zip(lo.tolist(), hi.tolist())], x0)
    if only_core:
        return None, core, None
    # and so is what is cut off at a text's ends
    block = _mixed([digest(data[a:b], 1) for a, b in zip(low.tolist(), high.tolist())], clip)
    return (place << (2 * FIELD)) | (near << FIELD) | far, core, block


def _mixed(hashes: list[int], with_: np.ndarray) -> np.ndarray:
    mixed = np.array(hashes, np.uint64) + with_.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _hashes(spec: Repeats, step: int, only_core: bool):
    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                k1, k2 = (part.column(names.index(k)).to_numpy() for k in ("k1", "k2"))
                texts = part.column(names.index("text")).to_pylist()
                refs = part.column(names.index("refs")).to_pylist() if "refs" in names else [None] * len(texts)
                ref, core, block, row = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], []
                for i, (text, own) in enumerate(zip(texts, refs)):
                    r, c, b = _records(text, None if own is None else np.array(own, np.int64), spec, step, only_core)
                    core.append(c)
                    if not only_core:
                        ref.append(r)
                        block.append(b)
                        row += [i] * len(c)
                core = pa.array(np.concatenate(core).view(np.int64))
                if only_core:
                    yield pa.RecordBatch.from_arrays([core], ["core"])
                else:
                    columns = [k1[row] if row else k1[:0], k2[row] if row else k2[:0], np.concatenate(ref), core]
                    columns.append(np.concatenate(block).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in RECORD.split(", ")])

    return run


def keyed_texts(docs: DataFrame, *more: str) -> DataFrame:
    """Texts with a 128-bit key in two halves."""
    return plain(docs, *more).withColumns({"k1": F.xxhash64("text"), "k2": _second_half("text")})


def _second_half(name: str):
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _again(records: DataFrame, *names: str) -> DataFrame:
    """The values of ``names`` that more than one record has, with one such record."""
    counted = records.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "ref")).alias("one"))
    return counted.filter("n > 1").drop("n")


def narrowed(docs: DataFrame, spec: Repeats, steps: tuple[int, ...]) -> tuple[DataFrame, DataFrame | None]:
    """``k1``, ``k2``, ``first``, ``last`` of positions that ``steps`` find to repeat, and what they leave open.

    Open is one row for a text: ``k1``, ``k2``, ``_first`` (its smallest doc_id) and ``refs``; None after step 1.
    """
    keyed = keyed_texts(docs)
    firsts = write_once(keyed.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")), "firsts")
    live, settled, refs = keyed.select("k1", "k2", "text"), None, None
    for number, step in enumerate(steps):
        if number:
            live = texts_of(docs, refs)
        records = live.mapInArrow(_hashes(spec, step, False), RECORD)
        if number:
            records = write_once(records, "records")
            cores = records.select("core")
        else:
            cores = live.mapInArrow(_hashes(spec, step, True), "core long")
        # written, so that the join has plain shuffles on both sides and can split a hot core
        twice = write_once(cores.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core"), "twice")
        kept = write_once(records.join(twice, "core", "left_semi"), "repeated")
        blocks = write_once(_again(kept, "core", "block").withColumn("whole", F.lit(True)), "blocks")
        found = write_once(kept.join(blocks.drop("one"), ["core", "block"], "left").drop("block"), "settled")
        far = F.col("ref").bitwiseAND((1 << FIELD) - 1)
        near = F.shiftrightunsigned("ref", FIELD).bitwiseAND((1 << FIELD) - 1)
        place = F.shiftrightunsigned("ref", 2 * FIELD)
        runs = found.filter("whole").select("k1", "k2", (place - far).alias("first"), (place - near).alias("last"))
        settled = runs if settled is None else settled.unionByName(runs)
        refs = None
        if step > 1:
            # with what is open goes on one place of each settled block it may agree with in part
            opened = found.filter("whole IS NULL")
            partners = blocks.join(opened.select("core").distinct(), "core", "left_semi").select("one.*")
            refs = opened.select("k1", "k2", "ref").unionByName(partners)
            refs = refs.groupBy("k1", "k2").agg(F.collect_set("ref").alias("refs")).join(firsts, ["k1", "k2"])
            refs = refs.withColumnRenamed("doc_id", "_first")
    return settled, refs


def texts_of(docs: DataFrame, refs: DataFrame, *more: str) -> DataFrame:
    """The text of every row of ``refs``, from the row of its smallest doc_id."""
    keyed = keyed_texts(docs)
    same = (keyed["k1"] == refs["k1"]) & (keyed["k2"] == refs["k2"]) & keyed["doc_id"].eqNullSafe(refs["_first"])
    return keyed.join(refs, same).select(keyed["k1"], keyed["k2"], "text", "refs", *more)


def repeated_runs(docs: DataFrame, spec: Repeats) -> DataFrame:
    """``k1``, ``k2`` of a text and ``runs``: its positions that repeat, as (first, last), neither merged nor sorted."""
    return grouped_runs(narrowed(docs, spec, spec.steps)[0])


def grouped_runs(settled: DataFrame) -> DataFrame:
    return settled.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("runs"))


def covered(runs, length: int) -> list[tuple[int, int]]:
    """Maximal spans (start, end) that the strings starting in ``runs`` cover."""
    spans: list[list[int]] = []
    for first, last in sorted((r["first"], r["last"]) for r in runs or ()):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last + length)
        else:
            spans.append([first, last + length])
    return [tuple(s) for s in spans]


def without_repeats(docs: DataFrame, spec: Repeats) -> DataFrame:
    return without_runs(docs, repeated_runs(docs, spec), spec)


def without_runs(docs: DataFrame, runs: DataFrame, spec: Repeats) -> DataFrame:
    """Every row's ``doc_id``, number of ``units``, ``spans`` that were removed (start, end in units) and ``kept``.

    ``kept`` is the rest as bytes: what is left of the text's bytes in a row, or its words with one space between.
    """
    kind, length = spec.units, spec.length
    schema = "doc_id long, units long, spans array<struct<start: long, end: long>>, kept binary"
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, texts, runs = (part.column(names.index(c)).to_pylist() for c in ("doc_id", "text", "runs"))
                sizes, all_spans, kept = [], [], []
                for text, own in zip(texts, runs):
                    units = text.encode() if kind == "bytes" else text.encode().split()
                    spans = covered(own, length)
                    bounds = [0, *(x for s in spans for x in s), len(units)]
                    left = [units[a:b] for a, b in zip(bounds[::2], bounds[1::2])]
                    kept.append(b"".join(left) if kind == "bytes" else b" ".join([w for x in left for w in x]))
                    sizes.append(len(units))
                    all_spans.append([{"start": a, "end": b} for a, b in spans])
                columns = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(all_spans, span_type), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "units", "spans", "kept"])

    runs = write_once(runs, "runs")
    return keyed_texts(docs).join(runs, ["k1", "k2"], "left").select("doc_id", "text", "runs").mapInArrow(run, schema)
