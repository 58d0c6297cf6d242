from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from text_cases import clashing, prose, rows, table

from tallyguard.llm import entries, repeats, seed_extend, simhash, suffix_dedup


def brute_force(found, length, words):
    units = [(t or "").encode().split() if words else (t or "").encode() for _, t, *_ in found]
    strings = Counter(tuple(u[i : i + length]) for u in units for i in range(len(u) - length + 1))
    out = []
    for (doc_id, *_), u in zip(found, units):
        gone = bytearray(len(u))
        for i in range(len(u) - length + 1):
            if strings[tuple(u[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        left = [x for x, g in zip(u, gone) if not g]
        kept = b" ".join(left) if words else bytes(left)
        spans = tuple((m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone)))
        out.append((doc_id, len(u), spans, kept))
    return Counter(out)


def collected(df):
    return Counter((r.doc_id, r.units, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in df.collect())


@pytest.mark.parametrize("length, gram", [(12, 4), (35, 8), (9, 1)])
def test_words(spark, length, gram):
    found = rows()
    result = seed_extend.remove_repeated_words(clashing(table(spark, found)), length, gram)
    assert collected(result) == brute_force(found, length, True)


@pytest.mark.parametrize("length, gram", [(60, 8), (100, 64)])
def test_bytes(spark, length, gram):
    found = rows(2)
    result = suffix_dedup.remove_repeated_bytes(clashing(table(spark, found)), length, gram)
    assert collected(result) == brute_force(found, length, False)


def test_bytes_at_full_length(spark):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdef ", k=3000))
    found = [
        (1, long, "en", "s", 0),
        (2, "x" + long[100:499] + "y", "en", "s", 0),  # a byte short
        (3, "x" + long[700:1100] + "y" + long[1500:2300], "en", "s", 0),
        (4, "z" * 1500, "en", "s", 0),  # one pair that most positions have
        (5, "ab" * 230 + long[2400:2900] + "ba" * 199, "en", "s", 0),
        (6, long[:400], "en", "s", 0),
        (6, "\u00e9" * 250 + long[1400:1810], "en", "s", 0),
        (None, None, "en", "s", 0),
    ]
    assert collected(suffix_dedup.remove_repeated_bytes(table(spark, found))) == brute_force(found, 400, False)


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    """Passages of over 50 words in two documents each: those that hold 400 bytes go whole, shorter ones stay."""
    rng = random.Random(9)
    found, planted = [], {}
    for i in range(24):
        passage = prose(rng, 51 + i) if i % 2 else prose(rng, 51 + i, ("a", "or"))
        for doc_id in (10 * i, 10 * i + 1):
            found.append((doc_id, f"{prose(rng, 80)} {passage} {prose(rng, 80)}", "en", "s", 0))
            planted[doc_id] = passage
    found += [(1000 + i, prose(rng, rng.randint(1, 300)), "en", "s", 0) for i in range(40)]
    table(spark, found).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in entries.op2_suffix_dedup(spark, str(tmp_path)).collect()}
    for doc_id, n_bytes, spans, kept in brute_force(found, 400, False):
        want = (n_bytes, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        assert (got[doc_id].n_bytes, got[doc_id].n_removed, got[doc_id].n_spans, got[doc_id].kept_sha256) == want
    assert len(got) == len(found) and all(not got[d].n_removed for d in got if d >= 1000)
    sizes = {d: len(p.encode()) for d, p in planted.items()}
    assert all(got[d].n_removed >= n for d, n in sizes.items() if n >= 400)
    assert all(not got[d].n_removed for d, n in sizes.items() if n < 380)
    assert sum(n >= 400 for n in sizes.values()) > 5 and sum(n < 380 for n in sizes.values()) > 5


def test_ranks_double_up_to_the_length():
    assert suffix_dedup.lengths(400, 64) == [100, 200, 400]
    assert suffix_dedup.lengths(100, 64) == [50, 100] and suffix_dedup.lengths(35, 8) == [9, 18, 35]
    assert list(suffix_dedup.offsets([100, 200, 400])) == [0, 200]
    text = np.frombuffer(b"abcabcabdabcabc", np.uint8).astype(np.uint64)
    for size in (1, 3, 4, 5, 7):
        ranks = suffix_dedup.first_ranks(text, size)
        strings = [bytes(text[i : i + size].astype(np.uint8)) for i in range(len(text) - size + 1)]
        assert len(ranks) == len(strings)
        assert all((ranks[i] == ranks[j]) == (x == y) for i, x in enumerate(strings) for j, y in enumerate(strings))


def test_random_repeats_over_a_tiny_alphabet(spark):
    rng = random.Random(5)
    found = [(i, "".join(rng.choices("ab", k=rng.randint(0, 90))), "en", "s", 0) for i in range(150)]
    assert collected(suffix_dedup.remove_repeated_bytes(table(spark, found), 16, 4)) == brute_force(found, 16, False)
    found = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 60))), "en", "s", 0) for i in range(150)]
    assert collected(seed_extend.remove_repeated_words(table(spark, found), 10, 2)) == brute_force(found, 10, True)


def test_empty_tables(spark):
    none = table(spark, [])
    assert seed_extend.remove_repeated_words(none).count() == 0
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0


def test_anchors_do_not_depend_on_parts():
    hashes = np.random.default_rng(2).integers(0, 30, 3000).astype(np.uint64)
    whole = repeats.anchors(hashes, 20, 4)
    assert all((a == b).all() for a, b in zip(whole, repeats.anchors(hashes, 20, 4, part=77)))
    place, first, last = whole
    assert first[0] == 0 and last[-1] == 3000 - 20 and (first[1:] == last[:-1] + 1).all()
    assert (place >= last).all() and (place - first <= 20 - 4).all()


def fingerprint(text, k=3):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(fps, distance):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_components(spark):
    rng = random.Random(4)
    found = rows(3, 60)
    base = prose(rng, 400).split()
    for i in range(30):  # near copies: one word changed
        text = list(base)
        text[rng.randrange(400)] = f"w{i}"
        found.append((5000 + i, " ".join(text), "en", "s", 0))
    result = simhash.near_duplicates(clashing(table(spark, found))).collect()
    fps = [fingerprint(t) for _, t, *_ in found]
    groups = grouped(fps, 3)
    least: dict = {}
    for (doc_id, *_), g in zip(found, groups):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    want = Counter((f[0], fp, least.get(g)) for f, fp, g in zip(found, fps, groups))
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in result) == want
    kept = simhash.keep_one(table(spark, found)).collect()
    assert len(kept) == len(set(groups))
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


@pytest.mark.parametrize("distance", [0, 1, 3])
@pytest.mark.parametrize("crowd", [1, 4096])
def test_links_keep_all_groups(spark, distance, crowd):
    rng = random.Random(6)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = {0, 2**64 - 1}
    for c in centres:
        for _ in range(25):
            x = c
            for _ in range(rng.randint(0, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), distance, crowd)
    roots = {r.node % 2**64: r.root for r in simhash.components(edges).collect()}
    groups = grouped(fps, distance)
    members: dict = {}
    for f, g in zip(fps, groups):
        members.setdefault(g, []).append(f)
    for group in members.values():
        found = {roots.get(f, ("alone", f)) for f in group}
        assert len(found) == 1 and (len(group) > 1) == (group[0] in roots)
    assert len({r for r in roots.values()}) == sum(len(g) > 1 for g in members.values())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(900, 500)], "u long, v long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 900: 500, 500: 500}
