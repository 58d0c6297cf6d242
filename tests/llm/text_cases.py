"""Small tables for the text operators: prose with planted repeats, and the awkward cases."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, syllables=("an", "the", "or", "ti", "on", "re", "wh", "sh", "ed")) -> str:
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(words))


def rows(seed: int = 1, docs: int = 40) -> list[tuple]:
    """Documents with copies, near copies and a shared passage, then null, empty, short, long and repeated ones."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(5, 120)) for _ in range(docs)]
    passage = prose(rng, 60)
    for i in range(0, docs, 7):
        cut = len(texts[i]) // 2
        texts[i] = f"{texts[i][:cut]} {passage} {texts[i][cut:]}"
    texts += [texts[0], texts[1], texts[2].replace("the", "tha", 1), passage]
    texts += [None, "", " \n\t ", "a", "Ünïcödé wörds à la carte", "x " * 400, "ab" * 900, prose(rng, 3000), " odd space\x1c"]
    out = [(10 * i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[3], out[3]]  # repeated rows
    out += [(None, "nameless text " + prose(rng, 30), None, None, None), (None, None, None, None, None)]
    return out


def table(spark, found: list[tuple]):
    return spark.createDataFrame(found, SCHEMA)


#: names that operators use inside, as extra columns of a table
CLASHES = ("key", "k1", "k2", "fp", "refs", "bucket", "place", "copy", "next", "ids", "spans", "reads", "letters", "root", "_key", "declared", "host", "suffix", "term", "mask")


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit("x") for name in CLASHES})
