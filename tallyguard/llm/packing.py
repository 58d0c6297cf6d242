"""Packing of token ids into windows by the online sum-of-squares rule (Csirik, Johnson, Kenyon, Orlin, Shor, Weber).

Every partition packs its own documents, in the order in which it reads them, without a shuffle. A level array holds
how many open windows are filled to each level. A document goes to the level for which the sum of the squared counts
of partially filled windows becomes smallest; a tie goes to the fuller window. Ids beyond whole windows of a long
document are placed like a document of their own.

When a partition ends, or has ``open_windows`` windows open (which bounds its memory), the emptiest open windows are
cut up to fill the fullest, so that one stays; that one is cut into sequences whose lengths are powers of two, which
need no padding.

Defined cases: a null or empty text is a document of the end id alone; repeated rows are packed as often as they come;
a null doc_id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyguard.llm.common import plain
from tallyguard.llm.tokens import END, encoded, vocabulary_path

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class LevelPacker:
    """Windows of ``capacity`` ids. A piece is (doc_id, start, id bytes, ids of the whole document)."""

    def __init__(self, capacity: int, open_windows: int = 1024):
        self.capacity, self.open_windows = capacity, open_windows
        self.count = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list]] = {}
        self.held = 0

    def add(self, doc_id, ids: bytes):
        """Place a document; yields the windows that became full."""
        total, width = len(ids) // 4, 4 * self.capacity
        for at in range(0, len(ids), width):
            piece = (doc_id, at // 4, ids[at : at + width], total)
            if len(piece[2]) == width:
                yield [piece]
            else:
                yield from self._place(piece)
        if self.held > self.open_windows:
            yield from self._fill_up()

    def level_for(self, size: int) -> int:
        """The level, 0 for a new window, that a piece of ``size`` ids is best added to."""
        count, top = self.count, self.capacity - size
        change = 2 * (count[1 + size : self.capacity + 1] - count[1 : top + 1]) + 2
        change[-1] -= 1  # a full window no longer counts; the array's last place stays 0
        change[count[1 : top + 1] == 0] = np.iinfo(np.int64).max
        best = top - 1 - int(np.argmin(change[::-1]))
        return best + 1 if change[best] <= 2 * count[size] + 1 else 0

    def _place(self, piece):
        size = len(piece[2]) // 4
        level = self.level_for(size)
        window = self._take(level) if level else []
        window.append(piece)
        if level + size == self.capacity:
            yield window
        else:
            self.count[level + size] += 1
            self.open.setdefault(level + size, []).append(window)
            self.held += 1

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.held -= 1
        return self.open[level].pop()

    def _fill_up(self):
        """Cut up the emptiest open windows to fill the fullest; one stays open at most."""
        windows = [(level, w) for level in sorted(self.open) for w in self.open[level]]
        first, last = 0, len(windows) - 1
        spare: list = []
        while first < last or (spare and first <= last):
            level, target = windows[last]
            need = 4 * (self.capacity - level)
            while need and (spare or first < last):
                if not spare:
                    spare = windows[first][1]
                    first += 1
                doc_id, start, ids, total = spare.pop()
                if len(ids) > need:
                    spare.append((doc_id, start, ids[: len(ids) - need], total))
                    start, ids = start + (len(ids) - need) // 4, ids[len(ids) - need :]
                target.append((doc_id, start, ids, total))
                need -= len(ids)
            if need:
                spare = target
            else:
                yield target
            last -= 1
        rest = spare or (windows[first][1] if first <= last else [])
        self.open, self.count[:], self.held = {}, 0, 0
        if rest:
            level = sum(len(p[2]) for p in rest) // 4
            self.open, self.held = {level: [rest]}, 1
            self.count[level] = 1

    def finish(self):
        """The windows left: full ones, then sequences of a power of two of ids each."""
        yield from self._fill_up()
        rest = [p for windows in self.open.values() for w in windows for p in w]
        size = sum(len(p[2]) for p in rest) // 4
        rest.reverse()
        while size:
            need = room = 1 << (size.bit_length() - 1)
            window = []
            while need:
                doc_id, start, ids, total = rest.pop()
                if len(ids) > 4 * need:
                    rest.append((doc_id, start + need, ids[4 * need :], total))
                    ids = ids[: 4 * need]
                window.append((doc_id, start, ids, total))
                need -= len(ids) // 4
            size -= room
            yield window
        self.open, self.held = {}, 0
        self.count[:] = 0


def pack(
    docs: DataFrame,
    capacity: int = 4096,
    vocabulary: str | None = None,
    end: int | None = END,
    open_windows: int = 1024,
) -> DataFrame:
    """One row per piece: the document's ids from ``start``, ``length`` of them, lie at ``offset`` of ``sequence_id``.

    ``ids`` holds them as little-endian unsigned 32-bit integers. ``sequence_id`` is the number of the partition in
    its upper and of the sequence in its lower 33 bits.
    """
    path = vocabulary or vocabulary_path()

    def run(batches):
        from pyspark import TaskContext

        packer = LevelPacker(capacity, open_windows)
        number, rows, size = TaskContext.get().partitionId() << 33, [], 0

        def numbered(windows):
            nonlocal number, size
            for window in windows:
                offset = 0
                for doc_id, start, ids, total in window:
                    rows.append((doc_id, start, len(ids) // 4, ids, total, number, offset))
                    offset += len(ids) // 4
                number += 1
                size += 4 * offset

        def batch():
            nonlocal rows, size
            columns, rows, size = list(zip(*rows)), [], 0
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for doc_id, ids in encoded(batches, path, end):
            numbered(packer.add(doc_id, ids))
            if size > 8_000_000:
                yield batch()
        numbered(packer.finish())
        if rows:
            yield batch()

    return plain(docs).mapInArrow(run, SCHEMA)
