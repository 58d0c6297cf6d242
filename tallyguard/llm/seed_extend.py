"""Removal of word sequences that occur more than once, by seed and extend.

Seeds are winnowed anchors: word grams with the smallest hash within a window's reach. Documents meet on equal seeds.
A seed is extended both ways to all that its windows can reach, and what is equal there is a repeat as a whole; where
it is not, the windows that hold the seed are compared one by one, so that repeats are maximal: they end at the exact
word where no other place goes on alike. Repeats shorter than the threshold never match a whole window. Instead of
pairs of documents, extended seeds are compared by hash (see ``repeats``), so a passage in very many documents costs
one row for each place.

Defined cases: a null or empty text has no words; a text with fewer than ``length`` words keeps all; repeated rows
count as copies and lose all windows; an empty table gives no rows. Matches never cross texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyguard.llm.repeats import Repeats, without_repeats


def remove_repeated_words(docs: DataFrame, length: int = 35, gram: int = 8) -> DataFrame:
    """``doc_id``, ``units`` (words), removed ``spans`` (in words) and ``kept`` words, joined by a space, of every row."""
    return without_repeats(docs, Repeats("words", length, gram, (length - gram + 1, 1)))
