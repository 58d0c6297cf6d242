"""I-Match fingerprints with randomised lexicons (Chowdhury et al.; Kolcz et al.), in DataFrame operations alone.

Terms are lower-case runs of letters and digits. The lexicon holds the terms whose document frequency lies in a band,
given as shares of all documents. At most (different terms of all documents, summed) / (low * documents) terms can
reach the lower bound: the lexicon's size follows the length of documents, not their number, so it may be broadcast.
MD5 deals its terms to ``subsets`` random sub-lexicons, each term to one, so that no term of the band is left out. A
document's lexicon terms are sorted, and those of each sub-lexicon are hashed together; the fingerprint is the row of
these hashes, with no entry where a sub-lexicon does not meet the document. A document with fewer than ``least``
lexicon terms has the hash of all its sorted distinct terms instead.

The likeness of two fingerprints is the share of sub-lexicons with equal hashes among those that meet either
document; for two that none meets it is 1 or 0, as their hashes of all terms are equal or not.

Defined cases: a null or empty text has no terms and the hash of none; repeated rows have equal fingerprints; an empty
table gives no rows; documents of one doc_id are ordered by the hash of their texts, and so dealt to
several ranges if there are many; null doc_ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import plain
from tallyguard.plans.scratch import write_once

_PLACE = "struct<named: boolean, id: bigint, tie: bigint>"
_ABOUT = f"struct<row: struct<copy: int, place: {_PLACE}, doc_id: bigint, n_chars: bigint>, sha256: string, whole: string>"
TERM_GAP = r"[^\p{L}\p{N}]+"


def terms(text: str | Column) -> Column:
    """Distinct terms of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), TERM_GAP)), "")


def lexicon(docs: DataFrame, low: float, high: float, subsets: int) -> DataFrame:
    """``term`` and ``sub``, the number of its sub-lexicon, for the terms in the band."""
    total = docs.count()
    frequency = plain(docs).select(F.explode(terms("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    band = frequency.filter((F.col("df") >= low * total) & (F.col("df") <= high * total))
    return band.select("term", sub_lexicon("term", subsets).alias("sub"))


def sub_lexicon(term: str | Column, subsets: int) -> Column:
    """Number of a term's sub-lexicon, by the first four digits of its MD5."""
    return (F.conv(F.substring(F.md5(term), 1, 4), 16, 10).cast("int") % subsets).cast("int")


def in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """``bucket``, ``place``, ``copy``, ``doc_id``, ``text`` and ``next``, the text of the following document.

    Documents are dealt to ranges of doc_id and, where one doc_id fills several, of its texts' hashes. Each range also holds a copy (``copy`` 1) of the document that follows its
    last one, after the last range the first of all, so that no window spans more than a range.
    """
    rows = plain(docs).withColumns({"_id": F.coalesce("doc_id", F.lit(-(1 << 63))), "_tie": F.xxhash64("text")})
    bounds = rows.agg(F.percentile_approx("_id", [i / ranges for i in range(1, ranges)], 50 * ranges)).first()[0]
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("_tie").alias("tie"))
    rows = rows.withColumns({"bucket": _bucket(bounds or [], ranges), "place": place}).drop("_id", "_tie")
    starts = rows.groupBy("bucket").agg(F.min("place").alias("place"))  # one row for each range
    ordered = Window.orderBy("bucket")
    last = F.max("bucket").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = write_once(starts.select(F.coalesce(F.lag("bucket").over(ordered), last).alias("to"), "place"), "range-starts")
    copies = rows.drop("bucket").join(F.broadcast(heads), "place").groupBy("to", "place").agg(F.first("text").alias("text"))
    copies = copies.select(F.col("to").alias("bucket"), "place", F.lit(1).alias("copy"), F.lit(None).cast("long").alias("doc_id"), "text")
    both = rows.select("bucket", "place", F.lit(0).alias("copy"), "doc_id", "text").unionByName(copies)
    return both.withColumn("next", F.lead("text").over(Window.partitionBy("bucket").orderBy("copy", "place")))


def _bucket(bounds: list[int], ranges: int) -> Column:
    """Number of a row's range: of the bounds at or below its id, found by halves, then of its hash if its id is many bounds."""
    different = sorted(set(bounds))

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("_id") >= different[middle], below(middle + 1, high)).otherwise(below(low, middle))

    share = F.col("_tie") / float(1 << 64) + 0.5
    within = F.lit(ranges)  # ids behind a hot one
    for hot in different:
        parts = bounds.count(hot)
        if parts > 1:
            within = F.when(F.col("_id") == hot, F.least(F.floor(share * parts), F.lit(parts - 1))).otherwise(within)
    return (below(0, len(different)).cast("long") * (ranges + 1) + within).alias("bucket")


def edited(text: str = "text", following: str = "next") -> Column:
    """The text with its last half, rounded down, replaced by the first as many code points of the following one."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(following, half))


def likeness(a: str | Column, b: str | Column) -> Column:
    """Likeness of two fingerprints given as structs of ``subs`` and ``whole``."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.size(F.array_intersect(a["subs"], b["subs"]))
    met = F.size(F.array_union(_numbers(a["subs"]), _numbers(b["subs"])))
    alike = F.when(a["whole"] == b["whole"], 1.0).otherwise(0.0)
    return F.when(met == 0, alike).otherwise(same / met)


def _numbers(subs: Column) -> Column:
    return F.transform(subs, lambda s: F.substring_index(s, ":", 1))


def fingerprint_text(fingerprint: str) -> Column:
    subs = F.concat_ws(".", f"{fingerprint}.subs")
    return F.when(F.size(f"{fingerprint}.subs") > 0, subs).otherwise(F.concat(F.lit("="), f"{fingerprint}.whole"))


def _hashes(kept: str) -> Column:
    """``sub:hash`` of each sub-lexicon among sorted structs of ``sub`` and ``term``: one pass marks where one begins."""

    def marked(t, i):
        fresh = (i == 0) | (F.get(kept, i - 1)["sub"] != t["sub"])
        return F.when(fresh, F.concat(F.lit("\n"), t["sub"].cast("string"), F.lit(":"), t["term"])).otherwise(F.concat(F.lit(" "), t["term"]))

    runs = F.split(F.substring(F.array_join(F.transform(kept, marked), ""), 2, 1 << 30), "\n")
    return F.transform(runs, lambda r: F.concat(F.substring_index(r, ":", 1), F.lit(":"), F.substring(F.md5(r), 1, 10)))


def fingerprints(
    docs: DataFrame,
    low: float = 0.002,
    high: float = 0.25,
    subsets: int = 64,
    least: int = 4,
    ranges: int | None = None,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Every row's ``doc_id``, ``n_chars``, fingerprint, and those of its edited text and of the next document."""
    spark = docs.sparkSession
    words = write_once(lexicon(docs, low, high, subsets), "lexicon")
    few = words.count() <= broadcast_rows
    # a term that no text has stands for the text itself, so that a text without lexicon terms keeps its row
    words = words.unionByName(spark.range(1).select(F.lit("").alias("term"), F.lit(-1).alias("sub")))
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(docs, ranges).select(
        "bucket",
        F.struct("copy", "place", "doc_id", F.char_length("text").cast("long").alias("n_chars")).alias("row"),
        (F.monotonically_increasing_id() * 2).alias("number"),
        "text",
        F.when(F.col("copy") == 0, edited()).alias("edited"),
    )
    # even numbers are texts, odd ones their edited versions
    versions = F.array(*[F.struct(F.lit(v).alias("v"), F.col(n).alias("text")) for v, n in enumerate(("text", "edited"))])
    rows = rows.select("bucket", "row", "number", F.explode(versions).alias("version")).filter("version.text IS NOT NULL")
    rows = rows.select(
        "bucket",
        (F.col("number") + F.col("version.v")).alias("number"),
        F.when(F.col("version.v") == 0, F.col("row")).alias("row"),
        F.when(F.col("version.v") == 1, F.sha2("version.text", 256)).alias("sha256"),
        terms("version.text").alias("terms"),
    )
    about = F.struct("row", "sha256", F.md5(F.concat_ws(" ", F.sort_array("terms"))).alias("whole"))
    entries = F.concat(
        F.array(F.struct(F.lit("").alias("term"), about.alias("about"))),
        F.transform("terms", lambda t: F.struct(t.alias("term"), F.lit(None).cast(_ABOUT).alias("about"))),
    )
    found = rows.select("bucket", "number", F.explode(entries).alias("e")).select("bucket", "number", "e.term", "e.about")
    found = found.join(F.broadcast(words) if few else words, "term")
    kept = F.collect_list(F.when(F.col("sub") >= 0, F.struct("sub", "term")))
    found = found.groupBy("bucket", "number").agg(F.max("about").alias("about"), F.sort_array(kept).alias("kept"))
    subs = F.when(F.size("kept") < least, F.array().cast("array<string>")).otherwise(_hashes("kept"))
    found = found.select("bucket", "number", "about", F.struct(subs.alias("subs"), F.col("about.whole").alias("whole")).alias("f"))
    text = F.col("number") % 2 == 0
    found = found.groupBy("bucket", F.floor(F.col("number") / 2).alias("number")).agg(
        F.max(F.when(text, F.col("about.row"))).alias("row"),
        F.max(F.when(text, F.col("f"))).alias("fingerprint"),
        F.max("about.sha256").alias("edited_sha256"),
        F.max(F.when(~text, F.col("f"))).alias("edited_fingerprint"),
    )
    order = Window.partitionBy("bucket").orderBy("row.copy", "row.place")
    found = found.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).filter("row.copy = 0")
    return found.select("row.doc_id", "row.n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint")
