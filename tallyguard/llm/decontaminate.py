"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max pruning.

The index holds test items, sorted by their thresholds and cut into blocks. A term's postings name the items and its
weight there; its block postings name the blocks and its largest weight there. Terms are numbered by ascending largest
weight, so a query's sorted terms start with the least important ones.

Every document is cut into stretches as long as the longest item, and each two neighbouring stretches are a passage,
so that whatever is copied from an item lies whole in a passage. Every passage is a query, as a set of terms:

1. its least terms, up to a part of the smallest threshold, are skipped and bound by that part;
2. the block postings of the others bound the score of every item of each block;
3. only in blocks whose bound reaches their smallest threshold are items scored, with all terms.

All items that score ``share`` of what they score against themselves are retrieved. A retrieved item is confirmed if
at least ``overlap`` of the word shingles of its question, and as much of its answer, stand in the passage. An item
without separate columns is its question up to the last sentence, which is its answer (or the last third of its words).

The index travels to the tasks in parts of about ``part_bytes`` of item text, one part after the other. Document
frequencies, the number of items, their mean length and the longest one are those of all items in every part, so that
results do not depend on the number of parts. Documents are not shuffled.

Defined cases: a null or empty text matches nothing; items without words are left out; repeated items each match;
repeated rows give rows each; null doc_ids are kept; without items or documents there are no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import plain, rows_chosen, text_key
from tallyguard.plans.scratch import write_once

SCHEMA = (
    "doc_id long, key binary, item_id long, score double, share double, question_overlap double, "
    "answer_overlap double, first_word long, confirmed boolean"
)
#: letters in lower case, digits and all beyond ASCII stay; the rest parts words
_TABLE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_SKIP = 0.3


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_TABLE).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """An item's words up to its last sentence, and those of its last sentence."""
    parts = [w for w in map(words_of, _SENTENCE.split(text.strip())) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


@dataclass(frozen=True)
class Statistics:
    """Of all items with words: their number, words together, words of the longest, and items by term."""

    count: int
    words: int
    longest: int
    frequency: dict[bytes, int]

    @classmethod
    def of(cls, counts: list[Counter]) -> Statistics:
        sizes = [sum(c.values()) for c in counts]
        return cls(len(sizes), sum(sizes), max(sizes, default=0), Counter(t for c in counts for t in c))


class Index:
    """Inverted index of items (id, question words, answer words), which may be a part of those of ``statistics``."""

    def __init__(
        self,
        items,
        share: float,
        overlap: float,
        shingle: int,
        block: int = 8,
        k1: float = 1.2,
        b: float = 0.75,
        statistics: Statistics | None = None,
    ):
        items = [(i, q, a) for i, q, a in items if q or a]
        self.share, self.overlap, self.shingle = share, overlap, shingle
        counts = [Counter(q + a) for _, q, a in items]
        sizes = [sum(c.values()) for c in counts]
        known = statistics or Statistics.of(counts)
        self.stretch = max(32, known.longest)
        mean = known.words / max(1, known.count)
        idf = {t: math.log(1 + (known.count - n + 0.5) / (n + 0.5)) for t, n in known.frequency.items()}
        weights = [
            {t: idf[t] * n * (k1 + 1) / (n + k1 * (1 - b + b * size / mean)) for t, n in c.items()}
            for c, size in zip(counts, sizes)
        ]
        own = [sum(w.values()) for w in weights]
        order = sorted(range(len(items)), key=lambda i: own[i])
        self.items = [items[i] for i in order]
        self.own = np.array([own[i] for i in order])
        self.weights = [weights[i] for i in order]
        most: dict[bytes, float] = {}
        for w in weights:
            for t, x in w.items():
                most[t] = max(most.get(t, 0.0), x)
        terms = sorted(most, key=lambda t: (most[t], t))
        self.vocabulary = {t: i for i, t in enumerate(terms)}
        self.most = np.array([most[t] for t in terms])
        self.block = block
        self.blocks = -(-len(items) // block)
        bound: list[dict[int, float]] = [{} for _ in terms]
        for i, w in enumerate(self.weights):
            for t, x in w.items():
                own_blocks = bound[self.vocabulary[t]]
                own_blocks[i // block] = max(own_blocks.get(i // block, 0.0), x)
        self.start = np.concatenate([[0], np.cumsum([len(x) for x in bound])]).astype(np.int64)
        self.block_of = np.array([b for x in bound for b in sorted(x)], np.int64)
        self.block_most = np.array([x[b] for x in bound for b in sorted(x)])
        self.rows = np.zeros((len(self.block_of), block))  # a block posting's weight in each item of the block
        place = {(t, b): k for k, (t, b) in enumerate((t, b) for t, x in enumerate(bound) for b in sorted(x))}
        for i, w in enumerate(self.weights):
            for t, x in w.items():
                self.rows[place[self.vocabulary[t], i // block], i % block] = x
        self.need = share * self.own
        self.item_need = np.full((self.blocks, block), np.inf)
        self.item_need.ravel()[: len(items)] = self.need
        self.block_need = self.need[::block]  # ascending within and across blocks

    def _shingles(self, words: list[bytes]) -> set:
        n = min(self.shingle, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()

    def _overlap(self, part: list[bytes], passage: list[bytes]) -> float:
        wanted = self._shingles(part)
        if not wanted:
            return 1.0
        n = len(next(iter(wanted)))
        found = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)}
        return len(wanted & found) / len(wanted)

    def candidates(self, ids: np.ndarray, stretch_of: np.ndarray, stretches: int, follows: np.ndarray):
        """(stretch, item) that may reach the item's need in the passage of a stretch and the one after it.

        ``ids`` are term numbers, -1 for words of no item; ``follows`` tells whether the next stretch is of the same
        document. Also gives the distinct terms of all stretches, and where those of each start.
        """
        size = len(self.vocabulary)
        known = ids >= 0
        pairs = np.unique(stretch_of[known] * size + ids[known])
        where, term = pairs // size, pairs % size
        starts = np.searchsorted(where, np.arange(stretches + 1))
        sums = np.concatenate([[0.0], np.cumsum(self.most[term])])
        skip = 0.5 * _SKIP * self.need[0]
        vital = sums[1:] - sums[starts[where]] > skip
        cell, post = self._postings(where[vital], term[vital])
        bounds = np.bincount(cell, self.block_most[post], minlength=stretches * self.blocks)
        open_ = self._with_next(bounds.reshape(stretches, self.blocks), follows) + 2 * skip >= self.block_need
        # all terms of the stretches that take part, against the items of the open blocks
        taken = open_.copy()
        taken[1:][follows[:-1]] |= open_[:-1][follows[:-1]]
        busy = taken.any(axis=1)[where]
        cell, post = self._postings(where[busy], term[busy])
        inside = taken.ravel()[cell]
        cells, dense = np.unique(cell[inside], return_inverse=True)
        by_item = np.stack(
            [np.bincount(dense, self.rows[post[inside], k], minlength=len(cells)) for k in range(self.block)], axis=1
        )
        number = np.full(stretches * self.blocks + 1, -1)
        number[cells] = np.arange(len(cells))
        s, b = np.nonzero(open_)
        own = number[s * self.blocks + b]
        after = np.where(follows[s], number[np.minimum((s + 1) * self.blocks + b, len(number) - 1)], -1)
        by_item = np.vstack([by_item, np.zeros(self.block)])  # the last row stands for -1
        hit, k = np.nonzero(by_item[own] + by_item[after] >= self.item_need[b] - 1e-9)
        return np.stack([s[hit], b[hit] * self.block + k], axis=1), term, starts

    def _postings(self, where: np.ndarray, term: np.ndarray):
        """For each block posting of the terms: the cell (stretch, block) and the posting."""
        many = self.start[term + 1] - self.start[term]
        row = np.repeat(np.arange(len(term)), many)
        post = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + self.start[term][row]
        return where[row] * self.blocks + self.block_of[post], post

    @staticmethod
    def _with_next(bounds: np.ndarray, follows: np.ndarray) -> np.ndarray:
        pair = bounds.copy()
        pair[:-1][follows[:-1]] += bounds[1:][follows[:-1]]
        return pair

    def matches(self, words_by_doc: list[list[bytes]]):
        """(document, item, score, share, question and answer overlap, first word) of all retrieved items."""
        get, ids, stretch_of, first, owner = self.vocabulary.get, [], [], [], []
        for number, words in enumerate(words_by_doc):
            if not words:
                continue
            ids.append(np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)))
            stretch_of.append(np.arange(len(words)) // self.stretch + len(first))
            own = range(0, len(words), self.stretch)
            first += own
            owner += [number] * len(own)
        if not ids:
            return
        owner = np.array(owner)
        follows = np.append(owner[1:] == owner[:-1], False)
        found, term, starts = self.candidates(np.concatenate(ids), np.concatenate(stretch_of), len(owner), follows)
        best: dict[tuple[int, int], tuple] = {}
        names = list(self.vocabulary) if len(found) else []
        for s, i in found:
            last = s + 1 if follows[s] else s
            passage_terms = {names[t] for t in term[starts[s] : starts[last + 1]]}
            weight = self.weights[i]
            score = sum(weight[t] for t in passage_terms if t in weight)
            if score < self.need[i] - 1e-9:
                continue
            passage = words_by_doc[owner[s]][first[s] : first[s] + (2 if follows[s] else 1) * self.stretch]
            _, q, a = self.items[i]
            overlaps = self._overlap(q, passage), self._overlap(a, passage)
            rank = (min(overlaps), score, -first[s])
            key = (int(owner[s]), int(i))
            if key not in best or rank > best[key][0]:
                best[key] = (rank, score, score / self.own[i], *overlaps, first[s])
        for (number, i), (_, *rest) in best.items():
            yield number, self.items[i][0], *rest


def _search(index: Index):
    def run(batches):
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.binary(), pa.int64(), *[pa.float64()] * 4, pa.int64(), pa.bool_())
        room = max(16, 4_000_000 // max(1, index.blocks))  # stretches at a time
        for batch in batches:
            ids, keys, texts = (batch.column(i).to_pylist() for i in range(3))
            rows, at = [], 0
            while at < len(texts):
                group, held, begin = [], 0, at
                while at < len(texts) and held < room and len(group) < 256:
                    group.append(words_of(texts[at]))
                    held += len(group[-1]) // index.stretch + 1
                    at += 1
                for number, item, score, share, q, a, first in index.matches(group):
                    ok = q >= index.overlap and a >= index.overlap
                    rows.append((ids[begin + number], keys[begin + number], item, score, share, q, a, first, ok))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def _parted(texts) -> tuple[list[bytes], list[bytes]]:
    """Question and answer of an item given as one text or as two."""
    return (words_of(texts[0]), words_of(texts[1])) if len(texts) == 2 else question_and_answer(texts[0])


def _statistics(items: DataFrame, columns: list[str]) -> Callable[[int], Statistics]:
    """Statistics of all items, by grouped counts; for a ``part``, the frequencies of its own terms."""

    def run(batches):
        for batch in batches:
            part, *texts = (column.to_pylist() for column in batch.columns)
            for number, *own in zip(part, *texts):
                question, answer = _parted(own)
                terms = list(dict.fromkeys(question + answer))
                if terms:
                    rows = [number] * (len(terms) + 1), [None, *terms], [len(question) + len(answer)] * (len(terms) + 1)
                    kinds = (pa.int64(), pa.binary(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["part", "term", "words"])

    terms = write_once(items.select("part", *columns).mapInArrow(run, "part long, term binary, words long"), "item-terms")
    count, words, longest = terms.filter("term IS NULL").agg(F.count(F.lit(1)), F.sum("words"), F.max("words")).first()
    by_term = terms.filter("term IS NOT NULL").groupBy("term")
    frequency = write_once(by_term.agg(F.count(F.lit(1)).alias("n"), F.collect_set("part").alias("parts")), "item-frequencies")

    def of(part: int) -> Statistics:
        own = frequency.filter(F.array_contains("parts", F.lit(part).cast("long"))).select("term", "n").collect()
        return Statistics(count, words or 0, longest or 0, {bytes(r["term"]): r["n"] for r in own})

    return of


def retrieve(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.5,
    overlap: float = 0.5,
    shingle: int = 3,
    part_bytes: int = 8 << 20,
    question: str | None = None,
    answer: str | None = None,
) -> DataFrame:
    """All retrieved (document, item), at the item's best passage, and whether the overlap confirms them."""
    separate = question is not None and answer is not None
    columns = (question, answer) if separate else ("text",)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), *[F.coalesce(c, F.lit("")).alias(f"part{i}") for i, c in enumerate(columns)])
    size = F.lit(0)
    for i in range(len(columns)):
        size = size + F.octet_length(f"part{i}")
    total = items.agg(F.sum(size.cast("long"))).first()[0] or 0
    parts = total // part_bytes + 1
    names = [f"part{i}" for i in range(len(columns))]
    statistics = None  # a single part has them itself
    if parts > 1:
        items = items.withColumn("part", F.pmod(F.xxhash64("item_id", "part0"), F.lit(parts)))
        statistics = _statistics(items, names)
    found = None
    keyed = plain(docs).select("doc_id", text_key().alias("key"), "text")
    for number in range(parts):
        own = items.filter(F.col("part") == number) if parts > 1 else items
        rows = own.orderBy("item_id").collect()  # about part_bytes of text
        split = [(r["item_id"], *_parted([r[name] for name in names])) for r in rows]
        if not any(q or a for _, q, a in split):
            continue
        index = Index(split, share, overlap, shingle, statistics=statistics(number) if statistics else None)
        matches = keyed.mapInArrow(_search(index), SCHEMA)
        found = matches if found is None else found.unionByName(matches)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` with all columns, without those that hold a confirmed item."""
    return rows_chosen(docs, retrieve(docs, items, **options).filter("confirmed"), "left_anti")
