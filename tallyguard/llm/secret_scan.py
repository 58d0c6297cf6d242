"""Secret scans with a linear-chain conditional random field.

Three patterns (the base) find assignments, access keys and long hexadecimal strings. Beside them, a conditional random
field tags every white-space token as begin, inside or outside of a secret. Its features are the token's shape, the
words before and after it, and the kind of file (length, share of assignments). It is trained here: on at most
``sample`` texts with a base match and as many without, chosen by hash, of at most 20,000 characters, cut to
stretches around the tagged tokens; and on the same stretches with random secrets of other shapes put in, with and
without the words around them, so that the tagger goes by shape and not by the patterns.

Decoding is exact Viterbi. A text is first bounded: if no token's best tag, with the best transitions into and out
of it, beats outside, the path of outsides is the best one and need not be searched.

Spans count code points, the end exclusive. A tagged span is stripped of quotes and marks. If it overlaps base spans,
these stay as they are, and each part of its tokens that none of them covers is added, unless it is marks alone.

Defined cases: a null or empty text has no spans; repeated rows give equal rows; without any text there is nothing to
train on and only the patterns search; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import plain, text_key

KINDS = ("assign", "access", "hex", "crf")
OUT, BEGIN, INSIDE = 0, 1, 2
#: fixed values: the base patterns
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # as AKIA[A-Z0-9]+ of at least 18 characters
HEX = re.compile(r"[0-9a-f]{16,}")  # as [0-9a-f]+ of at least 16 characters
LEAST_VALUE = 12
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_LIKELY = r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"

_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`,;:.()[]{}<>!?*%$#&="
_GROUPED = re.compile("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}").fullmatch
_NAMES = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|akia|private|signature|session", re.IGNORECASE)


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the patterns' matches, by start, then kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                found.append((m.start(), 0, m.end(), m.start(2)))
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


# ---------------------------------------------------------------------------------------------------- features

SHAPES = 40
NEIGHBOURS = 8
FILES = 8


def shape(token: str) -> tuple[int, ...]:
    """Numbers of a token's shape features, below SHAPES."""
    core = token.strip(_EDGES)
    n = len(core)
    on = [min(n // 4, 9)]
    if 1 < n < 12 and core.isascii() and core.isalpha() and core[1:].islower() and token[0] not in "\"'`":
        on += [10, 16, 19, 23]  # most words: what follows below, at once
        return (*on, 38) if _NAMES.search(core) else tuple(on)
    digits, upper, lower = (sum(map(f, core)) for f in (str.isdigit, str.isupper, str.islower))
    others = n - digits - upper - lower
    on.append(10 + (0 if not n else min(4, 1 + int(3.99 * digits / n)) if digits else 0))
    mixed = (digits > 0) + (upper > 1) + (lower > 0)
    on.append(15 + mixed)
    on.append(19 + min(others, 3))
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(core, core[1:]))
    on.append(23 + min(turns // 2, 4))
    if n >= 16 and mixed > 1:
        on.append(28)
    if core.isascii() and n >= 12 and turns >= 4:
        on.append(29)
    if digits == n and n:
        on.append(30)
    if "@" in core or "://" in core or "www." in core:
        on.append(31)
    if not core.isascii():
        on.append(32)
    vowels = sum(c in "aeiouAEIOU" for c in core)
    if n >= 12:
        on.append(33 + min(3, int(8 * vowels / n)))
    if token[:1] in "\"'`" and token:
        on.append(37)
    if _NAMES.search(core) and n < 24:
        on.append(38)
    if _GROUPED(core):
        on.append(39)
    return tuple(on)


def neighbour(token: str) -> tuple[int, ...]:
    """Numbers of a neighbouring word's features, below NEIGHBOURS."""
    on = [0]
    if _NAMES.search(token):
        on.append(1)
    if token.endswith(("=", ":")):
        on.append(2)
    if token in ("=", ":", "=>", ":="):
        on.append(3)
    if token.endswith((".", "!", "?")):
        on.append(4)
    if len(token) >= 16:
        on.append(5)
    if any(c.isdigit() for c in token):
        on.append(6)
    return tuple(on)


def file_kind(text: str, tokens: int) -> tuple[int, ...]:
    """Numbers of a file's features, below FILES."""
    marks = text.count("=") + text.count("{") + text.count(";")
    return (min(2, tokens // 200), 3 + min(3, 20 * marks // max(1, tokens)))


class Field:
    """Weights by feature and tag, and between tags (from, to); tags are outside, begin, inside.

    Scores of shapes seen are kept in a table, and at most ``room`` tokens with their row in it.
    """

    def __init__(self, own, before, after, file, turn, room: int = 400_000):
        self.weights = (own, before, after, file, turn)
        self.file, self.turn, self.room = file, turn, room
        self.known: dict[str, int] = {}
        self.places: dict[tuple, int] = {}
        self.table: list[np.ndarray] = []
        self.array = np.zeros((0, 9))

    def __reduce__(self):
        return Field, self.weights

    def rows(self, tokens: list[str]) -> np.ndarray:
        """Numbers of the tokens' rows in the table."""
        known = self.known
        try:
            return np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            pass
        if len(known) > self.room:
            known.clear()
        for token in set(tokens):
            if token not in known and len(token) <= 64:
                known[token] = self._row(token)
        return np.array([known[t] if t in known else self._row(t) for t in tokens], np.int64)

    def _row(self, token: str) -> int:
        key = (shape(token), neighbour(token))
        if key not in self.places:
            own, before, after = self.weights[:3]
            shapes, near = list(key[0]), list(key[1])
            scores = own[shapes].sum(axis=0), before[near].sum(axis=0), after[near].sum(axis=0)
            self.places[key] = len(self.table)
            self.table.append(np.concatenate(scores))
        return self.places[key]

    def emissions(self, text: str, tokens: list[str]) -> np.ndarray:
        rows = self.rows(tokens)
        if len(self.array) != len(self.table):
            self.array = np.array(self.table)
        scores = self.array[rows]
        out = scores[:, :3] + self.file[list(file_kind(text, len(tokens)))].sum(axis=0)
        out[1:] += scores[:-1, 3:6]
        out[:-1] += scores[1:, 6:9]
        return out

    def tags(self, text: str, tokens: list[str]) -> list[int] | None:
        """Best tags (None: all outside)."""
        if not tokens:
            return None
        scores = self.emissions(text, tokens)
        turn = self.turn
        finite = [turn[a, b] for a in range(3) for b in range(3) if (a, b) != (OUT, INSIDE)]
        most = max(0.0, max(finite) - turn[OUT, OUT])
        if (scores[:, 1:].max(axis=1) - scores[:, OUT] + 2 * most).max() <= 0:
            return None
        return viterbi(scores, turn)


def viterbi(scores: np.ndarray, turn: np.ndarray) -> list[int]:
    """Best tags of a chain; inside follows begin or inside only."""
    t = turn.tolist()
    best, back = None, []
    for o, b, i in scores.tolist():
        if best is None:
            best = (o, b, float("-inf"))
            continue
        po, pb, pi = best
        to_out = max((po + t[0][0], 0), (pb + t[1][0], 1), (pi + t[2][0], 2))
        to_begin = max((po + t[0][1], 0), (pb + t[1][1], 1), (pi + t[2][1], 2))
        to_inside = max((pb + t[1][2], 1), (pi + t[2][2], 2))
        back.append((to_out[1], to_begin[1], to_inside[1]))
        best = (o + to_out[0], b + to_begin[0], i + to_inside[0])
    tag = max(range(3), key=lambda k: best[k])
    tags = [tag]
    for step in reversed(back):
        tag = step[tag]
        tags.append(tag)
    return tags[::-1]


# ---------------------------------------------------------------------------------------------------- training


def _tagged(text: str) -> tuple[list[str], list[int]]:
    """Tokens, and tags by the values of the base spans."""
    values = [(v, e) for _, _, e, v in base_spans(text)]
    tokens, tags, k, inside = [], [], 0, False
    values.sort()
    for m in _TOKEN.finditer(text):
        while k < len(values) and values[k][1] <= m.start():
            k, inside = k + 1, False
        hit = k < len(values) and values[k][0] < m.end()
        tokens.append(m[0])
        tags.append((INSIDE if inside else BEGIN) if hit else OUT)
        inside = hit
    return tokens, tags


def _made_up(rng: random.Random) -> str:
    letters = rng.choice([string.hexdigits.lower()[:16], string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/_-", string.ascii_uppercase + string.digits])
    return rng.choice(["", "", "sk_", "ghp_", "AKIA", "key-"]) + "".join(rng.choices(letters, k=rng.randint(20, 48)))


def _uuid(rng: random.Random) -> str:
    """An identifier that is no secret: digits and letters in groups of fixed sizes."""
    return "-".join("".join(rng.choices(string.hexdigits[:16], k=k)) for k in (8, 4, 4, 4, 12))


def _stretches(texts: list[str], reach: int = 10) -> list[tuple[str, list[str], list[int]]]:
    """(text, tokens, tags) around tagged tokens, or of a text's beginning, and with random secrets put in."""
    rng, found = random.Random(7), []
    for text in texts:
        tokens, tags = _tagged(text)
        if not tokens:
            continue
        hits = [i for i, t in enumerate(tags) if t == BEGIN][:3] or [rng.randrange(len(tokens))]
        for at in hits:
            lo, hi = max(0, at - reach), at + reach
            part, own = tokens[lo:hi], tags[lo:hi]
            if own[0] == INSIDE:
                own = [BEGIN, *own[1:]]
            found.append((text, part, own))
            clean = [t for t, o in zip(part, own) if o == OUT]
            if clean:
                name = rng.choice([[], [], ["token", "="], ["password:"], ["key"], ["secret", ":"], ["Authorization:", "Bearer"]])
                quote, end = rng.choice(["", "", '"', "'"]), rng.choice(["", "", ".", ",", ";"])
                place = rng.randrange(len(clean) + 1)
                new = [*clean[:place], *name, f"{quote}{_made_up(rng)}{quote}{end}", *clean[place:]]
                marks = [OUT] * place + [OUT] * len(name) + [BEGIN] + [OUT] * (len(clean) - place)
                found.append((text, new, marks))
            if rng.random() < 0.3 and clean:  # words and numbers that only look odd
                odd = rng.choice(["2024-05-01T12:30:00Z", "https://mail3.example.com/a/b?id=77", "55@mail9.example.com", "internationalisation", "1,234,567.89", "v2.13.4-rc1", "+1-202-555-0143", _uuid(rng)])
                found.append((text, [*clean[: len(clean) // 2], odd, *clean[len(clean) // 2 :]], [OUT] * (len(clean) + 1)))
    return found


def train(texts: list[str], steps: int = 80, decay: float = 1e-3) -> Field | None:
    """Maximum likelihood by forward-backward and Adam, all stretches at once; the same texts give the same weights."""
    data = _stretches(texts)
    if not data:
        return None
    width = max(len(t) for _, t, _ in data)
    sizes = (SHAPES, NEIGHBOURS, NEIGHBOURS, FILES)
    at = np.concatenate([[0], np.cumsum(sizes)])
    x = np.zeros((len(data), width, at[-1]), np.float32)
    y = np.zeros((len(data), width), np.int64)
    mask = np.zeros((len(data), width), bool)
    for n, (text, tokens, tags) in enumerate(data):
        kinds = [at[3] + k for k in file_kind(text, len(text) // 6 + 1)]
        near = [list(neighbour(t)) for t in tokens]
        for k, token in enumerate(tokens):
            x[n, k, list(shape(token))] = 1
            if k:
                x[n, k, [at[1] + f for f in near[k - 1]]] = 1
            if k + 1 < len(tokens):
                x[n, k, [at[2] + f for f in near[k + 1]]] = 1
            x[n, k, kinds] = 1
        y[n, : len(tags)], mask[n, : len(tags)] = tags, True
    flat = x.reshape(-1, at[-1])
    w, turn = np.zeros((at[-1], 3), np.float32), np.zeros((3, 3), np.float32)
    ban = np.zeros((3, 3), np.float32)
    ban[OUT, INSIDE] = -1e4
    first = np.array([0, 0, -1e4], np.float32)
    one = np.eye(3, dtype=np.float32)[y] * mask[..., None]
    pairs = (one[:, :-1, :, None] * one[:, 1:, None, :]).sum(axis=(0, 1))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(turn), np.zeros_like(turn)]

    def total(v, axis):
        top = v.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(v - top).sum(axis=axis))

    for step in range(1, steps + 1):
        e = (flat @ w).reshape(len(data), width, 3)
        move = turn + ban
        a = np.zeros_like(e)
        a[:, 0] = e[:, 0] + first
        for k in range(1, width):
            nxt = total(a[:, k - 1, :, None] + move, 1) + e[:, k]
            a[:, k] = np.where(mask[:, k, None], nxt, a[:, k - 1])
        z = total(a[:, -1], 1)
        b = np.zeros_like(e)
        expected = np.zeros((3, 3))
        for k in range(width - 2, -1, -1):
            ahead = move + (e[:, k + 1] + b[:, k + 1])[:, None, :]
            live = mask[:, k + 1]
            b[:, k] = np.where(live[:, None], total(ahead, 2), b[:, k + 1])
            expected += np.exp(a[live][:, k, :, None] + ahead[live] - z[live][:, None, None]).sum(axis=0)
        p = np.exp(a + b - z[:, None, None]) * mask[..., None]
        grads = (flat.T @ (p - one).reshape(-1, 3) / len(data) + decay * w, (expected - pairs) / len(data) + decay * turn)
        for j, (value, grad) in enumerate(zip((w, turn), grads)):
            m, v = state[2 * j], state[2 * j + 1]
            m *= 0.9
            m += 0.1 * grad
            v *= 0.999
            v += 0.001 * grad * grad
            value -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(*(w[i:j].astype(float) for i, j in zip(at, at[1:])), turn.astype(float))


def fit(docs: DataFrame, sample: int = 100) -> Field | None:
    """Train on a bounded sample: ``sample`` texts the patterns match and as many others, lowest hashes first.

    One pass over all texts finds the lowest hashes, each task keeping its ``sample`` lowest of either kind; another
    one, without the patterns, fetches the texts that have them.
    """
    short = plain(docs).filter("char_length(text) BETWEEN 1 AND 20000").select("text", F.xxhash64("doc_id", "text").alias("h"))
    lowest = Window.partitionBy("hit").orderBy("h")
    drawn = short.select("h", F.col("text").rlike(_LIKELY).alias("hit")).withColumn("place", F.row_number().over(lowest))
    hits = {r["h"]: r["hit"] for r in drawn.filter(F.col("place") <= sample).collect()}
    found = short.filter(F.col("h").isin(list(hits))).groupBy("h").agg(F.min("text").alias("text")).collect() if hits else []
    found = sorted(found, key=lambda r: (not hits[r["h"]], r["h"]))
    return train([r["text"] for r in found])


# ---------------------------------------------------------------------------------------------------- scanning


def _uncovered(text: str, places: list[tuple[int, int]], base: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of the tokens at ``places`` outside the ``base`` spans; marks go at a token's ends, not beside a base span."""
    parts = []
    for start, end in places:
        token = text[start:end]
        start += len(token) - len(token.lstrip(_EDGES))
        end -= len(token) - len(token.rstrip(_EDGES))
        for s, e in [*base, (end, end)]:
            if start < min(s, end) and text[start : min(s, end)].strip(_EDGES):
                parts.append((start, min(s, end)))
            start = max(start, e)
    return parts


def spans_of(text: str, model: Field | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, by start, then kind."""
    base = base_spans(text)
    found = [(s, k, e) for s, k, e, _ in base]
    tokens = text.split() if model else []
    tags = model.tags(text, tokens) if model else None
    if tags:
        places = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        if len(places) != len(tags):  # separators that the pattern and split() see differently
            tokens = [text[a:b] for a, b in places]
            tags = model.tags(text, tokens) or [OUT] * len(places)
        k = 0
        while k < len(tags):
            if tags[k] == OUT:
                k += 1
                continue
            last = k
            while last + 1 < len(tags) and tags[last + 1] == INSIDE:
                last += 1
            start, end = places[k][0], places[last][1]
            value = text[start:end]
            start += len(value) - len(value.lstrip(_EDGES))
            end -= len(value) - len(value.rstrip(_EDGES))
            near = [(s, e) for s, _, e, _ in base if s < end and start < e]
            if start < end:
                found += [(s, 3, e) for s, e in (_uncovered(text, places[k : last + 1], near) if near else [(start, end)])]
            k = last + 1
    return sorted(found)


SCHEMA = "doc_id long, key binary, spans array<struct<kind: string, start: long, end: long>>"


def scan(docs: DataFrame, model: Field | None = None, sample: int = 100) -> DataFrame:
    """Every row's ``doc_id``, ``key`` and ``spans``: kind, start and end in code points, by start, then kind."""
    model = model or fit(docs, sample)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [
                    [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans_of(text, model)]
                    for text in part.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(found, span)], ["doc_id", "key", "spans"]
                )

    return plain(docs).select("doc_id", text_key().alias("key"), "text").mapInArrow(run, SCHEMA)


def without_spans(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Field | None = None, sample: int = 100, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with all columns; every span in ``text`` is replaced by ``mark``, and ``n_chars``, if there, follows."""
    model = model or fit(docs, sample)

    @F.pandas_udf("string")
    def hidden(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without_spans(t, spans_of(t, model), mark) for t in texts], dtype=object)

    changed = docs.withColumn("text", hidden(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.char_length("text").cast(kind)))
    return changed
