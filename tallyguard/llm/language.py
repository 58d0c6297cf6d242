"""Language identification that fuses evidence by Bayes' rule.

log P(language | everything) = text log-likelihood * ``temper`` + log P(declared language | language)
                               + log P(language | host) + constant

* Text: byte trigrams of the lower-case letters, hashed into a table of log-probabilities for each language. The model
  is fitted on at most ``sample`` different texts for each declared language, those of the lowest hashes. The ``languages``
  most frequent declared values have a column each (256 KB); all rarer ones share one more column, fitted on ``sample``
  texts of theirs. So the table is bounded, and a text that reads like the shared column is in the language it declares.
* Declared values are compared by their first subtag, in lower case: ``en-GB`` is ``en``.
* Declared markup language: how often each value is declared on texts that read as each language.
* Host: languages of the host's other texts, smoothed towards the address suffix, which is smoothed towards all texts
  (Dirichlet weight ``strength`` at each level). A text's own reading does not count towards its own prior.

All counts are grouped aggregations over all rows, with map-side combine; a host with a third of all rows is one row
of the prior table, joined back by a shuffle join that splits skewed keys.

A text is rejected if it has no letters, reads worse under every language than letters drawn at random, or its best
posterior is below ``least``.

Defined cases: a null or empty text has no letters and is rejected (language null); null declared values, hosts and
suffixes are values of their own that say little or nothing; repeated rows are separate observations; a text
that reads like the shared column and declares no rare language is in language ``und``; without any declared language
nothing can be fitted and every text is rejected; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.llm.common import rows_chosen, text_key
from tallyguard.plans.scratch import write_once

BUCKETS = 1 << 16
#: language of a text that is in some rare language and does not declare which
UNDETERMINED = "und"
_GAP = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class TextModel:
    """``table`` holds, by trigram bucket, a log-probability for each language; with ``rest``, a last one for all others."""

    languages: tuple[str, ...]
    table: np.ndarray
    rest: bool = False


def grams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text's letters, a space between words."""
    letters = _GAP.sub(" ", text.lower()).strip()
    if not letters:
        return np.zeros(0, np.uint32)
    data = np.frombuffer(f" {letters} ".encode(), np.uint8).astype(np.uint32)
    codes = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return (codes * np.uint32(2654435761)) >> np.uint32(16)


def fit(docs: DataFrame, languages: int = 256, sample: int = 500, smoothing: float = 0.1) -> TextModel:
    """Fit on rows of ``text`` and ``declared``, on ``sample`` different texts of at most 20,000 characters for each column."""
    labelled = docs.filter("declared IS NOT NULL AND declared != ''")
    labelled = labelled.select("declared", "text", (F.char_length("text") <= 20_000).alias("short"), F.xxhash64("text").alias("h"))
    counts = labelled.groupBy("declared").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.when(F.col("short"), F.col("h")), 0.02).alias("texts")
    )
    counts = write_once(counts, "languages")
    frequent = counts.orderBy(F.desc("n"), F.asc("declared")).limit(languages).collect()
    found = {r["declared"]: r["texts"] for r in frequent}
    names = sorted(found)
    values, texts = counts.agg(F.count(F.lit(1)), F.sum("texts")).first()
    rest = values > len(names)
    seen = np.zeros((BUCKETS, len(names) + int(rest)), np.uint32)
    if names:
        share = lambda texts: min(1.0, 1.5 * sample / max(1, texts))
        shares = [(name, i, share(found[name])) for i, name in enumerate(names)]
        shares = F.broadcast(docs.sparkSession.createDataFrame(shares, "declared string, place int, share double"))
        short = labelled.filter("short").join(shares, "declared", "left" if rest else "inner")
        if rest:
            short = short.fillna({"place": len(names), "share": share(texts - sum(found.values()))})
        drawn = short.filter(F.pmod("h", F.lit(1 << 30)) < F.col("share") * float(1 << 30))
        drawn = drawn.groupBy("place", "h").agg(F.min("text").alias("text"))  # copies once
        rank = F.row_number().over(Window.partitionBy("place").orderBy("h"))
        chosen = drawn.withColumn("rank", rank).filter(F.col("rank") <= sample).select("place", "text")
        for row in chosen.toLocalIterator():
            seen[:, row["place"]] += np.bincount(grams(row["text"]), minlength=BUCKETS).astype(np.uint32)
    table = np.log((seen + smoothing) / (seen.sum(axis=0) + smoothing * BUCKETS)).astype(np.float32)
    return TextModel(tuple(names), table, rest)


def read(docs: DataFrame, model: TextModel) -> DataFrame:
    """Add ``letters`` (trigrams), ``loglik`` for each language and ``reads``, the number of the best one (-1: none)."""
    table, base = model.table, float(-np.log(BUCKETS))
    step = max(1, min(1 << 20, (1 << 23) // max(1, table.shape[1])))
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != "text")

    def run(batches):
        for batch in batches:
            sizes, sums = [], []
            for text in batch.column(batch.schema.names.index("text")).to_pylist():
                codes = grams(text)
                total = np.zeros(table.shape[1])
                for at in range(0, len(codes), step):
                    total += table[codes[at : at + step]].sum(axis=0, dtype=np.float64)
                sizes.append(len(codes))
                sums.append(total)
            best = [int(np.argmax(s)) if n and len(s) and s.max() > base * n else -1 for n, s in zip(sizes, sums)]
            columns = [batch.column(batch.schema.names.index(c)) for c in kept]
            columns += [pa.array(sizes, pa.int64()), pa.array([s.tolist() for s in sums], pa.list_(pa.float64())), pa.array(best, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "letters", "loglik", "reads"])

    return docs.mapInArrow(run, f"{schema}, letters long, loglik array<double>, reads int")


def _counts(size: int) -> Column:
    return F.array(*[F.sum(F.when(F.col("reads") == i, 1.0).otherwise(0.0)) for i in range(size)])


def _without_own(counts: str) -> Column:
    """Counts of the languages that the other texts read as."""
    return F.transform(counts, lambda n, i: n - F.when(i == F.col("reads"), 1.0).otherwise(0.0))


def _smoothed(counts: Column, parent: Column, strength: float) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.zip_with(counts, parent, lambda n, p: (n + strength * p) / (total + strength))


def host_priors(read_rows: DataFrame, size: int, strength: float) -> DataFrame:
    """For each (suffix, host): ``counts`` of languages read there and ``parent``, the suffix's smoothed shares."""
    hosts = read_rows.groupBy("suffix", "host").agg(_counts(size).alias("counts"))
    hosts = write_once(hosts, "hosts")
    add = [F.sum(F.col("counts")[i]).alias(f"n{i}") for i in range(size)]
    suffixes = hosts.groupBy("suffix").agg(*add).select("suffix", F.array(*[f"n{i}" for i in range(size)]).alias("own"))
    totals = hosts.agg(*add).first()
    totals = [float(x or 0) + 1 for x in totals]
    root = F.array(*[F.lit(x / sum(totals)) for x in totals])
    parents = suffixes.select(F.col("suffix").alias("_suffix"), _smoothed(F.col("own"), root, strength).alias("parent"))
    return hosts.join(parents, hosts["suffix"].eqNullSafe(parents["_suffix"])).drop("_suffix")


def identify(
    docs: DataFrame,
    languages: int = 256,
    sample: int = 500,
    temper: float = 0.2,
    strength: float = 20.0,
    least: float = 0.5,
    model: TextModel | None = None,
) -> DataFrame:
    """``docs`` with ``text``, ``declared``, ``host``, ``suffix`` and any others; returns all but the text, and

    ``language``, ``posterior`` of it, and ``accepted``.
    """
    names = ("text", "declared", "host", "suffix")
    others = [c for c in docs.columns if c not in names]
    clean = F.nullif(F.substring_index(F.translate(F.lower(F.trim("declared")), "_", "-"), "-", 1), F.lit(""))
    docs = docs.select(*others, F.coalesce("text", F.lit("")).alias("text"), clean.alias("declared"), "host", "suffix")
    model = model or fit(docs, languages, sample)
    size = model.table.shape[1]
    if not size:
        nothing = F.lit(None)
        return docs.drop("text").withColumns(
            {"language": nothing.cast("string"), "posterior": nothing.cast("double"), "accepted": F.lit(False)}
        )
    rows = write_once(read(docs, model), "read")
    priors = host_priors(rows, size, strength).withColumnsRenamed({"suffix": "_suffix", "host": "_host"})
    said = rows.groupBy("declared").agg(_counts(size).alias("said")).withColumnRenamed("declared", "_declared")
    said = write_once(said, "declared")
    seen = said.agg(F.count(F.lit(1)), *[F.sum(F.col("said")[i]) for i in range(size)]).first()
    half, known = 0.5 * seen[0], F.array(*[F.lit(float(x or 0)) for x in seen[1:]])
    said = said.withColumn("known", known)
    rows = rows.join(priors, rows["suffix"].eqNullSafe(priors["_suffix"]) & rows["host"].eqNullSafe(priors["_host"]))
    rows = rows.join(said, rows["declared"].eqNullSafe(said["_declared"]))
    prior = F.transform(_smoothed(_without_own("counts"), F.col("parent"), strength), lambda p: F.log(p))
    declared = F.zip_with(_without_own("said"), _without_own("known"), lambda n, k: F.log((n + 0.5) / (k + half)))
    fused = F.zip_with(F.zip_with("loglik", declared, lambda a, b: a * temper + b), prior, lambda a, b: a + b)
    rows = rows.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    total = F.aggregate("fused", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    posterior = 1.0 / total
    own = F.array(*map(F.lit, model.languages))
    rare = F.when(F.array_contains(own, F.col("declared")), F.lit(UNDETERMINED)).otherwise(F.coalesce("declared", F.lit(UNDETERMINED)))
    place = F.array_position("fused", F.col("top")).cast("int")
    name = F.when(place <= len(model.languages), F.get(own, place - 1)).otherwise(rare)
    kept = (F.col("letters") > 0) & (F.col("reads") >= 0) & (posterior >= least)
    return rows.select(
        *others,
        "declared",
        "host",
        "suffix",
        F.when(F.col("letters") > 0, name).alias("language"),
        posterior.alias("posterior"),
        kept.alias("accepted"),
    )


def from_documents(docs: DataFrame, *others: Column | str) -> DataFrame:
    """Evidence of the documents table: its ``lang`` is declared, its ``source`` is the host; there is no address."""
    return docs.select(*others, "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def from_pages(pages: DataFrame, *others: Column | str) -> DataFrame:
    """Evidence of raw pages: text without markup, the language of the html tag, host and last part of the host."""
    host = F.lower(F.parse_url("url", F.lit("HOST")))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>|&\w+;", " ")
    declared = F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    return pages.select(*others, text.alias("text"), declared.alias("declared"), host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"))


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with all columns, without the rows whose language is rejected."""
    id_, key = F.col("doc_id").cast("long"), text_key(F.coalesce("text", F.lit("")))
    found = identify(from_documents(docs, id_.alias("doc_id"), key.alias("key")), **options)
    return rows_chosen(docs, found.filter("NOT accepted"), "left_anti")
