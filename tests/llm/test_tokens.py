from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from text_cases import clashing, rows, table

from tallyguard.llm import frames, packing, tokens


@pytest.fixture(scope="module")
def expected():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.vocabulary_path())
    tok.encode_special_tokens = True
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, tokens.END]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.sampled_from("aBé' .,!\n\t\r12ß́ <|endoftext|>İ中\x1c"), max_size=60))
def test_chunks_are_encoded_like_whole_texts(text):
    enc = tokens.ChunkEncoder(tokens.vocabulary_path())
    whole = enc.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(enc.encode(text), "<u4").tolist() == whole


def test_special_strings_get_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(tokens.vocabulary_path()), tokens.ChunkEncoder(tokens.vocabulary_path())
    texts = ["end <|endoftext|> here", "a<|endoftext|>b.<|startoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "z" * 50 + "<|endoftext|>'s\n<|endoftext|>"]
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [806, 49407, 763]
    assert [np.frombuffer(enc.encode(t), "<u4").tolist() for t in texts] == want
    found = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    assert {r.doc_id: r.doc_tokens for r in packing.pack(table(spark, found), capacity=256).collect()} == {i: len(w) + 1 for i, w in enumerate(want)}


def test_encoder_with_little_room():
    enc = tokens.ChunkEncoder(tokens.vocabulary_path(), room=3)
    for text in ("one two three four five six", "seven, eight nine. ten", "one two " + "z" * 500):
        assert np.frombuffer(enc.encode(text), "<u4").tolist() == enc.tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_forgotten_when_a_task_ends():
    path, text = tokens.vocabulary_path(), "one two, three"
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, text]})
    enc = tokens.encoder(path)
    found = tokens.encoded(iter([batch]), path, tokens.END)
    ids = next(found)[1]
    assert "two," in enc.known and "two" in enc.words
    assert [x for _, x in found] == [ids]
    assert enc.known == enc.words == {"": b""}
    assert [x for _, x in tokens.encoded(iter([batch]), path, tokens.END)] == [ids, ids]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 31), min_size=1, max_size=40))
def test_level_minimises_the_sum_of_squares(sizes):
    packer = packing.LevelPacker(32)
    for size in sizes:
        count = packer.count
        levels = [0, *np.flatnonzero(count).tolist()]

        def cost(level):
            after = count.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            return int((after.astype(int) ** 2).sum())

        fits = [level for level in levels if level + size <= 32]
        chosen = packer.level_for(size)
        assert chosen in fits and cost(chosen) == min(map(cost, fits))
        list(packer.add(1, bytes(4 * size)))


@pytest.mark.parametrize("open_windows", [2, 1024])
def test_packer_keeps_every_id_once(open_windows):
    rng = random.Random(3)
    packer, pieces, windows = packing.LevelPacker(64, open_windows), defaultdict(list), []
    docs = {i: np.arange(rng.randint(1, 200), dtype="<u4") + 1000 * i for i in range(300)}
    for i, ids in docs.items():
        windows += packer.add(i, ids.tobytes())
    windows += packer.finish()
    for window in windows:
        size = sum(len(p[2]) for p in window) // 4
        assert size == 64 or size & (size - 1) == 0
        for doc_id, start, ids, total in window:
            assert total == len(docs[doc_id])
            pieces[doc_id].append((start, np.frombuffer(ids, "<u4")))
    for i, ids in docs.items():
        assert np.concatenate([p for _, p in sorted(pieces[i], key=lambda p: p[0])]).tolist() == ids.tolist()


def test_pack_table(spark, expected):
    found = rows()
    result = packing.pack(clashing(table(spark, found)), capacity=256).collect()
    by_sequence, total = defaultdict(list), Counter()
    for r in result:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        total[r.doc_id] += r.length
        assert len(r.ids) == 4 * r.length
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    want = Counter()
    for doc_id, text, *_ in found:
        want[doc_id] += len(expected(text))
    assert total == want
    assert packing.pack(table(spark, [])).count() == 0


def test_files_round_trip(spark, expected, tmp_path):
    found = rows()
    folder = f"file://{tmp_path}/ids"
    manifest = frames.write_ids(clashing(table(spark, found)), folder, frame_bytes=2048)
    assert manifest.agg({"documents": "sum"}).first()[0] == len(found)
    result = frames.read_ids(spark, folder).orderBy("shard", "position").collect()
    assert [r.doc_id for r in result] == sorted((f[0] for f in found), key=lambda i: (i is not None, i))
    assert [r.start for r in result] == [0, *np.cumsum([r.n_tokens for r in result])[:-1].tolist()]
    want = Counter((f[0], zlib.crc32(np.array(expected(f[1]), "<u4").tobytes())) for f in found)
    assert Counter((r.doc_id, zlib.crc32(r.ids)) for r in result) == want
    some = frames.read_ids(spark, folder, {70, 140}).collect()
    assert {r.doc_id: bytes(r.ids) for r in some} == {r.doc_id: bytes(r.ids) for r in result if r.doc_id in (70, 140)}


def test_empty_table_writes_no_file(spark, tmp_path):
    frames.write_ids(table(spark, []), f"file://{tmp_path}/none")
    assert frames.read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_frames_are_standard_and_checked(tmp_path):
    import zstandard

    rng = np.random.default_rng(1)
    docs = [(i if i % 5 else None, rng.integers(0, 50_000, rng.integers(1, 900)).astype("<u4").tobytes()) for i in range(30)]
    with open(tmp_path / "a.zst", "wb") as out:
        writer = frames.FrameWriter(out, 1024, 3)
        for doc in docs:
            writer.add(*doc)
        writer.close()
    data = (tmp_path / "a.zst").read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(ids for _, ids in docs)
    reader = frames.FrameReader(open(tmp_path / "a.zst", "rb"), len(data))
    assert [reader.ids(k) for k in (7, 29, 0)] == [docs[k][1] for k in (7, 29, 0)]
    assert reader.known.tolist() == [int(d is not None) for d, _ in docs]
    broken = bytearray(data)
    reader.sums = reader.sums + 1
    reader.frame = (-1, b"")
    with pytest.raises(ValueError, match="checksum"):
        reader.ids(3)
    (tmp_path / "b.zst").write_bytes(broken[:-1])
    with pytest.raises(ValueError, match="seek table"):
        frames.FrameReader(open(tmp_path / "b.zst", "rb"), len(data) - 1)
