"""Token ids of whole texts by a public tokenizer file.

The tokenizer lower-cases, drops white space and never joins characters across it, so the ids of a text are the
ids of its space-separated chunks in a row. Strings of special tokens have no white space and get their own ids, as
the library gives them. Texts are split and their chunks told apart by Arrow; a task keeps the ids of chunks
it has met, and ids are laid out by index.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyguard.llm.common import worker_state

VOCABULARY = "word_bpe_49k.json"
END = 2


def byte_letters() -> dict[int, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on, in a row."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    Holds the ids of at most about ``room`` chunks and ``room`` lower-case words, each of at most 40 characters.
    """

    # letters that neither compose nor change length, then marks without an apostrophe: two separate pre-tokens
    PARTS = "^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]{1,40})(?P<marks>[.,;:!?*%$#&]{0,8})$"

    def __init__(self, path: str, room: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.room, self.known, self.words = room, {"": b""}, {"": b""}

    def forget(self) -> None:
        """Let go of the ids met so far; the tokenizer stays."""
        self.known, self.words = {"": b""}, {"": b""}

    def _encode(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _learn_words(self, words: list[str]) -> None:
        """A word or a run of marks is one pre-token: the merges of its bytes are all there is to do."""
        tokenize = self.model.tokenize
        for word in words:
            spelt = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
            self.words[word] = array("I", [t.id for t in tokenize(spelt)]).tobytes()

    def _learn(self, chunks: list[str]) -> None:
        if len(self.words) > self.room:
            self.words = {"": b""}
        parts = pc.extract_regex(pa.array(chunks, pa.string()), self.PARTS)
        columns = []
        for part in (pc.utf8_lower(parts.field("word")), parts.field("marks")):
            coded = part.dictionary_encode()
            words = _strings(coded.dictionary)
            self._learn_words([w for w in words if w not in self.words])
            columns.append([*map(self.words.__getitem__, words), None])
            columns.append(coded.indices.fill_null(len(words)).to_numpy().tolist())
        words, word, marks, mark = columns
        rest = [c for c, valid in zip(chunks, parts.is_valid().to_numpy(zero_copy_only=False).tolist()) if not valid]
        self.known.update((c, words[w] + marks[m]) for c, w, m in zip(chunks, word, mark) if words[w] is not None)
        self.known.update(zip(rest, self._encode(rest)))

    def _ids(self, chunks: list[str]) -> list[bytes]:
        found = list(map(self.known.get, chunks))
        new = [c for c, ids in zip(chunks, found) if ids is None]
        if not new:
            return found
        if len(self.known) + len(new) > self.room:
            self.known, new = {"": b""}, [c for c in chunks if c]
        self._learn([c for c in new if len(c) <= 40])
        long = [c for c in new if len(c) > 40]
        own = dict(zip(long, self._encode(long)))
        return [own[c] if c in own else self.known[c] for c in chunks]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text of a string array without nulls."""
        if not len(texts):
            return []
        chunks = pc.split_pattern(pc.replace_substring_regex(texts, "[\n\t\r]", " "), " ")
        coded = chunks.flatten().dictionary_encode()
        found = self._ids(_strings(coded.dictionary))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        own = sizes[index]
        ends = np.concatenate([[0], np.cumsum(own)])
        # the k-th id of a chunk lies k places behind the start of the chunk's ids
        places = np.arange(ends[-1]) + np.repeat(starts[index] - ends[:-1], own)
        data = np.frombuffer(b"".join(found), "<u4")[places].tobytes()
        bounds = (4 * ends[chunks.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file."""
    return worker_state(f"encoder:{path}", lambda: ChunkEncoder(path))


def _slices(texts: pa.Array, rows: int, room: int = 1 << 24):
    """Ranges of at most ``rows`` texts that together take about ``room`` bytes at most, or of one text."""
    start, held = 0, 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if at > start and (at - start == rows or held + size > room):
            yield start, at
            start, held = at, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def encoded(batches, path: str, end: int | None, rows: int = 2048):
    """(doc_id, id bytes with the end id) for record batches of ``doc_id`` and ``text``, some rows at a time.

    The worker stays for later tasks, which may be other work: it keeps the tokenizer and forgets the ids at the end.
    """
    enc = encoder(path)
    tail = b"" if end is None else int(end).to_bytes(4, "little")
    for batch in batches:
        for start, stop in _slices(batch.column("text"), rows):
            part = batch.slice(start, stop - start)
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode_all(part.column("text"))):
                yield doc_id, ids + tail
    enc.forget()
