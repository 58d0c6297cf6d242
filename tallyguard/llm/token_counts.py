"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of at most ``chunk`` code points is encoded whole. A longer one is cut into chunks that overlap; the chunks are
spread over the cluster and encoded with offsets on their own, so that no task encodes a huge text alone. In each
overlap the encodings of both chunks are compared: they are spliced at a boundary that both of them have and that is
proven stable, the one nearest to the overlap's middle. A border whose encodings share no such boundary fails, and its
text is cut again with overlaps twice as wide (and chunks, once overlaps reach their size) until all borders hold; a
text that one chunk holds is encoded whole, so this ends.

Proof of stability: the encoder only ever joins neighbours into pieces of its vocabulary, so no piece spans two
neighbouring characters that are side by side in no piece of the vocabulary. What stands before such a place has no
influence on what stands behind it. The model must not rewrite texts (identity normalisation) but for spaces, which
become U+2581, and one of these put before a text; other models are refused.

Defined cases: a null or empty text has no bytes and no tokens; repeated rows and null doc_ids keep their rows; copies
of a huge text are encoded once; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import plain, text_key, worker_state
from tallyguard.llm.tokens import vocabulary_path
from tallyguard.plans.scratch import write_once

MODEL = "piece_bpe_32k.model"
SPACE = "▁"

PLACES = "array<struct<at: long, before: long>>"
ENCODED = f"key binary, number int, last boolean, tokens long, heads {PLACES}, tails {PLACES}"


class PieceEncoder:
    """A sentencepiece model and the pairs of characters that its pieces hold."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        self.bytes = {self.model.id_to_piece(i) for i in range(size) if self.model.is_byte(i)}
        self.pairs = set()
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if piece not in self.bytes:
                self.pairs.update(piece[k : k + 2] for k in range(len(piece) - 1))
        # compatibility forms, runs of spaces and spaces at both ends: all must come back as they are
        probe = "  Ａ² ﬁ  é\t\n x  "
        if self.model.decode(self.model.encode(probe)) != probe or not self.bytes:
            raise ValueError("the model rewrites texts; its boundaries cannot be placed")

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def boundaries(self, text: str) -> tuple[list[int], list[int], int]:
        """Stable boundaries of a text as offsets in code points, the tokens before each, and the number of tokens."""
        marked, pairs, plain_bytes = SPACE + text.replace(" ", SPACE), self.pairs, self.bytes
        at, places, before, held = 0, [], [], 0
        pieces = self.model.encode(text, out_type=str)
        for number, piece in enumerate(pieces):
            if at and not held and marked[at - 1 : at + 1] not in pairs:
                places.append(at - 1)  # without the space put before the text
                before.append(number)
            if piece in plain_bytes:  # one byte of a character that is no piece
                held += 1
                if held == len(marked[at].encode()):
                    at, held = at + 1, 0
            else:
                at += len(piece)
        return places, before, len(pieces)


def piece_encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a model file."""
    return worker_state(f"pieces:{path}", lambda: PieceEncoder(path))


def _whole(path: str):
    def run(batches):
        enc = piece_encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                counts = enc.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    return run


def _cut(chunk: int, overlap: int):
    """Chunks of texts: every border lies in the middle of an overlap."""
    margin = overlap // 2

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                borders = list(range(chunk, len(text), chunk))
                starts = [0, *(max(0, b - margin) for b in borders)]
                ends = [*(min(len(text), b + margin) for b in borders), len(text)]
                for number, (start, end) in enumerate(zip(starts, ends)):
                    columns = [[key], [number], [start], [number == len(borders)], [text[start:end]]]
                    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.bool_(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "number", "start", "last", "piece"]
                    )

    return run


def _encode(path: str, overlap: int):
    """Tokens of each chunk, and its stable boundaries inside the overlap at its head and at its tail."""
    place = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))

    def run(batches):
        enc = piece_encoder(path)
        for batch in batches:
            for key, number, start, last, text in zip(*(c.to_pylist() for c in batch.columns)):
                places, before, tokens = enc.boundaries(text)
                inner = [(p, n) for p, n in zip(places, before) if 0 < p < len(text)]
                heads = [{"at": start + p, "before": n} for p, n in inner if number and p < overlap]
                tails = [{"at": start + p, "before": n} for p, n in inner if not last and p > len(text) - overlap]
                columns = [[key], [number], [last], [tokens], [heads], [tails]]
                kinds = (pa.binary(), pa.int32(), pa.bool_(), pa.int64(), place, place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "number", "last", "tokens", "heads", "tails"]
                )

    return run


def _spliced(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """``key`` and ``n_tokens`` of huge texts; null where a border has no stable boundary that both sides share."""
    chunks = texts.mapInArrow(_cut(chunk, overlap), "key binary, number int, start long, last boolean, piece string")
    # one of each copy; the chunks of a text go to different tasks
    chunks = chunks.groupBy("key", "number").agg(*[F.first(c).alias(c) for c in ("start", "last", "piece")])
    done = chunks.mapInArrow(_encode(path, overlap), ENCODED)
    none = F.lit(None).cast(PLACES)
    # border k has the tail of chunk k - 1 and the head of chunk k; the last chunk adds all its tokens
    sides = F.array(
        F.struct(F.col("number").alias("border"), F.when(F.col("number") > 0, F.col("heads")).alias("heads"), none.alias("tails"), F.lit(None).cast("long").alias("rest")),
        F.struct((F.col("number") + 1).alias("border"), none.alias("heads"), F.when(~F.col("last"), F.col("tails")).alias("tails"), F.when(F.col("last"), F.col("tokens")).alias("rest")),
    )
    sides = done.select("key", F.explode(sides).alias("s")).select("key", "s.*")
    borders = sides.groupBy("key", "border").agg(
        F.first("heads", ignorenulls=True).alias("heads"), F.first("tails", ignorenulls=True).alias("tails"), F.max("rest").alias("rest")
    )
    middle = F.col("border") * F.lit(chunk)
    heads = F.map_from_entries("heads")
    both = F.filter("tails", lambda t: F.array_contains(F.col("heads.at"), t["at"]))
    choices = F.transform(both, lambda t: F.struct(F.abs(t["at"] - middle).alias("off"), (t["before"] - heads[t["at"]]).alias("tokens")))
    add = (
        F.when(F.col("rest").isNotNull(), F.col("rest"))
        .when(F.col("heads").isNotNull(), F.array_min(choices)["tokens"])
        .otherwise(0)  # the side before a text's first chunk
    )
    added = borders.select("key", add.alias("add"))
    return added.groupBy("key").agg(F.when(F.count_if(F.col("add").isNull()) == 0, F.sum("add")).alias("n_tokens"))


def count_tokens(docs: DataFrame, model: str | None = None, chunk: int = 1 << 15, overlap: int = 512) -> DataFrame:
    """Every row's ``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens`` as the model file gives them for the whole text."""
    path = model or vocabulary_path(MODEL)
    rows = plain(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    huge = F.char_length("text") > chunk
    counted = rows.filter(~huge).mapInArrow(_whole(path), "doc_id long, n_bytes long, n_tokens long")
    long = rows.filter(huge).withColumn("key", text_key())
    texts, settled = long.select("key", "text"), None
    while True:
        found = write_once(_spliced(texts, path, chunk, overlap), "spliced")
        settled = found if settled is None else settled.unionByName(found)
        failed = found.filter("n_tokens IS NULL")
        if failed.isEmpty():
            break
        overlap *= 2
        chunk = max(chunk, overlap)
        texts = long.select("key", "text").join(failed.select("key"), "key", "left_semi")
    settled = settled.filter("n_tokens IS NOT NULL")
    return counted.unionByName(long.join(settled, "key").select("doc_id", "n_bytes", "n_tokens"))
