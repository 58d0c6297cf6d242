"""License scans by template markup.

A template is license wording with marked regions: ``[...]`` may be left out, ``{n}`` stands for up to n words of any
kind (names, years). Templates are compiled to nondeterministic automata over words; a text is accepted where the
mandatory wording stands word for word. Besides, fixed phrases (the base) are found wherever their words stand in a
row.

Words are runs of digits, letters in lower case (A-Z only) and anything beyond ASCII.

Defined cases: a null or empty text has no words, no labels and score 0; repeated rows give equal rows; an empty
table gives no rows. Of the places where a template matches from one word on, the longest counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyguard.llm.common import plain

# fixed values: base phrases and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# fixed values: wording of public licenses and of notices that name them
TEMPLATES = {
    "apache-2.0": [
        "licensed under [the] apache license [version] 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at [http www apache org licenses license 2 0] [{4}] "
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ],
    "bsd-2-clause": [
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met [1] redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer [2] redistributions in binary form must reproduce the "
        "above copyright notice this list of conditions and the following disclaimer in the documentation and or "
        "other materials provided with the distribution",
    ],
    "cc-by-4.0": ["licensed under [a] [the] [creative commons] cc by 4 0 [international] [license]"],
    "cc-by-nc-4.0": ["licensed under [a] [the] [creative commons] cc by nc 4 0 [international] [license]"],
    "cc-by-sa-4.0": ["licensed under [a] [the] [creative commons] cc by sa 4 0 [international] [license]"],
    "gpl-2.0": ["licensed under the gnu general public license [gpl] [as published by the free software foundation] version 2"],
    "gpl-3.0": [
        "licensed under the gnu general public license [gpl] [as published by the free software foundation] version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ],
    "mit": [
        "[released] [licensed] under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice [{8}] shall be included in all copies or substantial portions "
        "of the software",
    ],
}

_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256)
)
_PARTS = re.compile(r"\[|\]|\{\d+\}|[^\s\[\]{}]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


@dataclass(frozen=True)
class Automaton:
    """``steps[s]`` leads from state s by a word; ``jumps[s]`` without one; ``loose`` states take any word on."""

    steps: tuple[tuple[bytes, int] | None, ...]
    jumps: tuple[tuple[int, ...], ...]
    loose: frozenset[int]
    heads: frozenset[bytes]
    rare: bytes

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.jumps[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def end(self, words: list[bytes], at: int) -> int | None:
        """The end of the longest match that starts at word ``at``."""
        final, states, found = len(self.steps) - 1, self.closure({0}), None
        while states:
            if final in states:
                found = at
            if at == len(words):
                break
            word = words[at]
            moved = {t for s in states if (step := self.steps[s]) and step[0] == word for t in (step[1],)}
            moved |= {s + 1 for s in states if s in self.loose}
            states, at = self.closure(moved), at + 1
        return found


def automaton(template: str) -> Automaton:
    """Compile a template. Optional regions may be nested."""
    steps: list = [None]
    jumps: list[set[int]] = [set()]
    loose, opened, mandatory = set(), [], []

    def state() -> int:
        steps.append(None)
        jumps.append(set())
        return len(steps) - 1

    for part in _PARTS.findall(template.lower()):
        here = len(steps) - 1
        if part == "[":
            opened.append(here)
        elif part == "]":
            end = state()
            jumps[here].add(end)
            jumps[opened.pop()].add(end)
        elif part[0] == "{":
            chain = [here, *(state() for _ in range(int(part[1:-1])))]
            end = state()
            loose.update(chain[:-1])
            for s in chain:
                jumps[s].add(end)
        else:
            steps[here] = (part.encode(), state())
            if not opened:
                mandatory.append(part.encode())
    if opened or not mandatory:
        raise ValueError("a template needs closed regions and mandatory wording")
    bare = Automaton(tuple(steps), tuple(map(tuple, jumps)), frozenset(loose), frozenset(), b"")
    first = bare.closure({0})
    if first & loose:
        raise ValueError("a template must not begin with a replaceable region")
    heads = frozenset(steps[s][0] for s in first if steps[s])
    return Automaton(bare.steps, bare.jumps, bare.loose, heads, max(mandatory, key=len))


SCHEMA = (
    "doc_id long, n_words long, places array<struct<label: string, first: long, end: long>>, "
    "matches array<struct<label: string, first: long, end: long>>"
)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Every row's ``doc_id``, number of words, ``places`` of phrases and ``matches`` of templates, in words."""
    base = [(b" %s " % phrase.encode(), len(phrase.split()), label) for phrase, label in phrases.items()]
    automata = [(label, automaton(t)) for label, texts in templates.items() for t in texts]
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])

    def places(words: list[bytes], line: bytes):
        for phrase, size, label in base:
            at, seen, number = line.find(phrase), 0, 0
            while at >= 0:
                number += line.count(b" ", seen, at)  # spaces before the phrase's own: words before it
                seen = at
                yield {"label": label, "first": number, "end": number + size}
                at = line.find(phrase, at + 1)

    def matches(words: list[bytes], line: bytes):
        likely = [(label, a) for label, a in automata if b" %s " % a.rare in line]
        heads = {h for _, a in likely for h in a.heads}
        for at, word in enumerate(words) if likely else ():
            if word in heads:
                for label, a in likely:
                    if word in a.heads and (end := a.end(words, at)) is not None:
                        yield {"label": label, "first": at, "end": end}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, found, accepted = [], [], []
                for text in part.column("text").to_pylist():
                    words = words_of(text)
                    line = b" " + b" ".join(words) + b" "
                    sizes.append(len(words))
                    found.append(list(places(words, line)))
                    accepted.append(list(matches(words, line)))
                columns = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(span)), pa.array(accepted, pa.list_(span))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "places", "matches"])

    return plain(docs).mapInArrow(run, SCHEMA)
