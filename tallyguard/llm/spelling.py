"""Spelling variants of a corpus' words by permuterm rotations.

A word's rotations are those of the word with a terminator behind it. A rotation without its last character is a prefix
that says everything about the word but that one character and where it stands: words that differ by one replaced
character share it, and a word that lacks the character has it as a whole rotation. So neighbours at one edit lie in
one prefix range of the sorted rotations, and everything in a range is a neighbour of everything else: the prefix
itself, if some word has it as rotation, and prefix + c for different characters c. Spark deals rotations by prefix,
sorts each partition and scans its ranges; a range has at most one row more than the alphabet.

No pairs are made. From its range each rotation learns how many neighbours it has there and which one is the most
frequent (running extremes before and behind it); grouping by word adds these up. A replacement shows up in one range
only. An insertion into a run of equal characters shows up once for each place in the run; it is counted where the
character before it is another one.

Words are counted by tasks first (a bounded table of counts, emptied when full) and added up by a grouped sum. Roots
are found by pointer doubling over the words that have a form.

Defined cases: a null or empty text has no words; a null doc_id counts as an empty one in hashes; repeated rows count
as often as they come; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import plain
from tallyguard.plans.scratch import write_once

TERMINATOR = "$"
#: code points of a long text that are searched at a time
STRETCH = 1 << 20


def stretches(text: str):
    """A text in parts that end between words."""
    if len(text) <= STRETCH:
        yield text
        return
    gap, at = re.compile("[^A-Za-zÀ-ÿ]"), 0
    while at < len(text):
        m = gap.search(text, at + STRETCH)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def typo(doc_id: int | None, word: str, every: int) -> str:
    """The word as the document spells it: of one in ``every`` (document, word) pairs a character is gone."""
    code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if code % every:
        return word
    at = code % len(word)
    return word[:at] + word[at + 1 :]


def _counted(least: int, every: int | None, room: int):
    """Counts of words of at least ``least`` characters, lower-cased in A-Z, over record batches."""
    words = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least).findall

    def batch_of(total: Counter) -> pa.RecordBatch:
        found = [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(found, ["word", "n"])

    def run(batches):
        total: Counter[bytes] = Counter()
        lowered: dict[str, bytes] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for stretch in stretches(text):
                        for word, n in Counter(words(stretch)).items():
                            low = lowered.get(word)
                            if low is None:
                                low = lowered[word] = word.encode().lower()  # of bytes: A-Z only
                            if every and zlib.crc32(low, start) % every == 0:
                                changed = typo(doc_id, low.decode(), every)
                                if len(changed) >= least:
                                    total[changed.encode()] += n
                            else:
                                total[low] += n
                        if len(total) > room or len(lowered) > 4 * room:
                            yield batch_of(total)
                            total, lowered = Counter(), {}
        if total:
            yield batch_of(total)

    return run


def word_counts(docs: DataFrame, least: int = 5, occurrences: int = 3, every: int | None = None, room: int = 200_000) -> DataFrame:
    """``word`` and ``n`` of the words with at least ``least`` characters and ``occurrences`` places in all texts."""
    found = plain(docs).mapInArrow(_counted(least, every, room), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def rotations(words: DataFrame) -> DataFrame:
    """All rotations of terminator-marked words: ``word``, ``n``, ``prefix`` and ``edit``.

    With ``edit`` the character that the prefix skips; null where the prefix is the whole rotation.
    """
    size = F.char_length("word")
    at = F.sequence(F.lit(0), size)

    def turned(skip: int):
        """From the k-th character on (after ``skip`` of them), the terminator, what is before."""
        return lambda k: F.concat(
            F.expr("word").substr(k + 1 + skip, F.lit(1 << 30)), F.lit(TERMINATOR), F.col("word").substr(F.lit(1), k)
        )

    whole = F.transform(at, lambda k: F.struct(turned(0)(k).alias("prefix"), F.lit(None).cast("string").alias("edit")))
    cut = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda k: F.struct(turned(1)(k).alias("prefix"), F.col("word").substr(k + 1, F.lit(1)).alias("edit")),
    )
    return words.select("word", "n", F.explode(F.concat(whole, cut)).alias("r")).select("word", "n", "r.prefix", "r.edit")


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near`` (words at one edit) and ``best``: the most frequent of them (``n``, ``word``), or null."""
    rows = rotations(words)
    # by how often, then by code points; smallest first
    own = F.struct((-F.col("n")).alias("less"), F.col("word").alias("near"))
    within = Window.partitionBy("prefix")
    sorted_ = within.orderBy(F.col("edit").asc_nulls_first())
    before = sorted_.rowsBetween(Window.unboundedPreceding, -1)
    behind = sorted_.rowsBetween(1, Window.unboundedFollowing)
    fresh = F.col("edit").isNotNull() & (F.col("edit") != F.right("prefix", F.lit(1)))
    scanned = rows.select(
        "word",
        "n",
        "edit",
        fresh.alias("fresh"),
        F.count("edit").over(within).alias("edits"),
        F.count_if(F.col("edit").isNull()).over(within).alias("whole"),
        F.count_if(fresh).over(within).alias("inserts"),
        F.least(F.min(own).over(before), F.min(own).over(behind)).alias("best"),
    )
    near = F.when(F.col("edit").isNull(), F.col("inserts")).otherwise(
        F.col("edits") - 1 + F.when(F.col("fresh"), F.col("whole")).otherwise(0)
    )
    found = scanned.groupBy("word").agg(F.first("n").alias("n"), F.sum(near).alias("n_near"), F.min("best").alias("best"))
    return found.select("word", "n", "n_near", F.when(F.col("n_near") > 0, F.struct((-F.col("best.less")).alias("n"), F.col("best.near").alias("word"))).alias("best"))


def variants(
    docs: DataFrame, least: int = 5, occurrences: int = 3, every: int | None = None, ratio: int = 2
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word of the corpus.

    ``form`` is the most frequent word at one edit if it is ``ratio`` times as frequent; ``root`` ends the forms.
    """
    if ratio < 2:
        raise ValueError("forms must grow, or they could go round")
    words = write_once(word_counts(docs, least, occurrences, every), "words")
    takes = F.col("best.n") >= ratio * F.col("n")
    found = neighbours(words).select(
        "word", "n", "n_near", F.when(takes, F.col("best.word")).alias("form"), F.when(takes, F.col("best.n")).alias("form_n")
    )
    found = write_once(found, "forms")
    links = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = write_once(links.join(onward, "root", "left").select("word", "root", "_next"), "roots")
        links = further.select("word", F.coalesce("_next", "root").alias("root"))
        if further.filter("_next IS NOT NULL").isEmpty():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
