"""Token counts, Merkle manifest and spelling variants against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from text_cases import clashing, rows, table

from tallyguard.llm import merkle, spelling, token_counts
from tallyguard.llm.tokens import vocabulary_path

# ---------------------------------------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(token_counts.MODEL))


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (300, 40), (50, 2)])
def test_counts_are_the_librarys(spark, library, chunk, overlap):
    found = rows(3) + [(9001, "<s>▁</s> " + "日本語のテキスト🙂" * 90, "ja", "s", 1), (9002, "x" * 700, "en", "s", 1)]
    got = token_counts.count_tokens(clashing(table(spark, found)), chunk=chunk, overlap=overlap).collect()
    want = Counter((d, len((t or "").encode()), len(library.encode(t or ""))) for d, t, *_ in found)
    assert Counter(tuple(r) for r in got) == want


def test_boundaries_do_not_depend_on_what_stands_before(library):
    enc, rng = token_counts.piece_encoder(vocabulary_path(token_counts.MODEL)), random.Random(4)
    for _ in range(300):
        text = "".join(rng.choices(["the ", "er", " in", "é", "日", "🙂", "  ", "\n", "\t", "\x00", "▁", "<s>", "1", "."], k=40))
        places, before, tokens = enc.boundaries(text)
        assert tokens == len(library.encode(text))
        for place, number in zip(places, before):
            if 0 < place < len(text):
                assert len(library.encode(text[:place])) == number


def test_border_without_common_boundary_widens_until_whole(spark, library):
    text = "a" * 5000  # no boundary in it is proven stable
    assert [r.n_tokens for r in token_counts.count_tokens(table(spark, [(1, text, "en", "s", 1)]), chunk=256, overlap=16).collect()] == [len(library.encode(text))]


# ---------------------------------------------------------------------------------------------- Merkle manifest


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climbed(nodes: list[str], width: int) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + width]) for i in range(0, len(levels[-1]), width)])
    return levels


def siblings(levels: list[list[str]], at: int, width: int) -> list[tuple]:
    path = []
    for level in levels[:-1]:
        first = at // width * width
        path.append(("".join(level[first:at]), "".join(level[at + 1 : first + width])))
        at //= width
    return path


def manifest_of(found: list[tuple], width: int) -> Counter:
    """Rows of (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for row in found:
        sources[row[1]].append((row[0] is not None, row[0] or 0, leaf(row), row[0]))
    trees = {s: climbed([x[2] for x in sorted(v, key=lambda x: x[:3])], width) for s, v in sources.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    top = climbed([trees[s][-1][0] for s in order], width)
    out = Counter()
    for k, s in enumerate(order):
        for i, (_, _, own, doc_id) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            path = siblings(trees[s], i, width) + siblings(top, k, width)
            out[doc_id, own, trees[s][-1][0], top[-1][0], tuple(path)] += 1
    return out


@pytest.mark.parametrize("width", [2, 3, 4])
def test_manifest(spark, many_parts, width):
    rng = random.Random(width)
    found = [(d, s, lang, n, t) for d, t, lang, s, n in rows(width)]
    found += [(7000 + i, "hot", None, i, f"line\n{rng.random()}") for i in range(200)]
    found += [(5, "alone", "en", 1, "one"), (6, "Zé", "en", 1, "two"), (7, "", "en", 1, "empty name")]
    docs = spark.createDataFrame(found, "doc_id long, source string, lang string, n_chars long, text string")
    extra = docs.withColumns({n: F.lit("x") for n in ("tree", "idx", "hash", "run", "slot", "done", "above", "path", "_tie", "h0")})
    got = merkle.manifest(extra, width=width).collect()
    shown = Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left.hex(), s.right.hex()) for s in r.path)) for r in got)
    assert shown == manifest_of(found, width)


def test_tampering_shows(spark):
    found = [(i, f"s{i % 4}", "en", i, f"text {i}") for i in range(40)]
    docs = spark.createDataFrame(found, "doc_id long, source string, lang string, n_chars long, text string")
    changed = merkle.leaf_of(merkle.COLUMNS, text=F.when(F.col("doc_id") % 7 == 3, F.lit("other")).otherwise(F.col("text")))
    got = merkle.manifest(docs, claimed=changed).select("doc_id", (merkle.folded(F.col("claimed"), F.col("path")) == F.col("root")).alias("same"))
    assert {r.doc_id for r in got.collect() if not r.same} == {i for i in range(40) if i % 7 == 3}


# ---------------------------------------------------------------------------------------------- spelling variants


def spelling_of(found: list[tuple], least: int, occurrences: int, every: int | None, ratio: int) -> set[tuple]:
    n = Counter()
    for doc_id, text, *_ in found:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.encode().lower().decode()
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if every and code % every == 0:
                word = word[: code % len(word)] + word[code % len(word) + 1 :]
            if len(word) >= least:
                n[word] += 1
    n = {w: k for w, k in n.items() if k >= occurrences}
    letters, near, form = {c for w in n for c in w}, {}, {}
    for w in n:
        cuts = {w[:i] + w[i + 1 :] for i in range(len(w))}
        swaps = {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        grown = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = {x for x in cuts | swaps | grown if x in n and x != w}
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n}


def spelled(df) -> set[tuple]:
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


@pytest.mark.parametrize("least, occurrences, every", [(5, 3, 97), (3, 1, 5), (2, 1, None)])
def test_variants(spark, least, occurrences, every):
    rng = random.Random(least)
    found = rows(5) + [(i, " ".join("".join(rng.choices("abé", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 80))), "en", "s", 1) for i in range(60)]
    got = spelling.variants(clashing(table(spark, found)), least, occurrences, every)
    assert spelled(got) == spelling_of(found, least, occurrences, every, 2)


def test_runs_of_equal_letters_count_a_neighbour_once(spark):
    found = [(1, "aaaaa aaaaaa aaaaaa aaaaaa aabaa " + "aaaaaaa " * 9, "en", "s", 1)]
    assert spelled(spelling.variants(table(spark, found), 5, 1, None)) == spelling_of(found, 5, 1, None, 2)


def test_long_texts_are_searched_whole(spark, monkeypatch):
    text = "alpha béta×gamma " * 500 + "é" * 300
    monkeypatch.setattr(spelling, "STRETCH", 7)
    assert "".join(spelling.stretches(text)) == text
    words = [w for s in spelling.stretches(text) for w in re.findall("[A-Za-zÀ-ÿ]+", s)]
    assert words == re.findall("[A-Za-zÀ-ÿ]+", text)


def test_empty_tables(spark):
    none = table(spark, [])
    assert token_counts.count_tokens(none).count() == 0
    assert merkle.manifest(none).count() == 0
    assert spelling.variants(none).count() == 0
