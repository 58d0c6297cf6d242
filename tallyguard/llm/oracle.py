"""SQL of the text queries that plain SQL can express."""

from __future__ import annotations

OP2 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (
  SELECT doc_id, i, md5_number(substring(h, 2 * i + 1, 800)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d WHERE length(h) >= 800)
),
again AS (SELECT m FROM p GROUP BY m HAVING count(*) > 1),
s AS (SELECT doc_id, i FROM p WHERE m IN (SELECT m FROM again)),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 400 AS b
  FROM (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
    FROM (
      SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh
      FROM s
    )
  )
  GROUP BY doc_id, run
),
gaps AS (
  SELECT r.doc_id, coalesce(lag(b) OVER w, 0) AS a, r.a AS b FROM runs r WINDOW w AS (PARTITION BY r.doc_id ORDER BY r.a)
  UNION ALL
  SELECT d.doc_id, coalesce(max(r.b), 0), length(any_value(d.h)) // 2
  FROM d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id
),
kept AS (
  SELECT g.doc_id, string_agg(substring(d.h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
  FROM gaps g JOIN d ON d.doc_id = g.doc_id WHERE b > a GROUP BY g.doc_id
),
removed AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(removed.n, 0) AS n_removed,
       coalesce(removed.spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
),
p AS (
  SELECT doc_id, i, md5_number(array_to_string(list_slice(w, i, i + 34), ' ')) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
),
again AS (SELECT m FROM p GROUP BY m HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, i + j AS k FROM p, (SELECT unnest(range(0, 35)) AS j) WHERE m IN (SELECT m FROM again)
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.k) AS text
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.k = words.k
  WHERE gone.k IS NULL GROUP BY words.doc_id
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(removed.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id
"""

OP3 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER w, first_value(coalesce(text, '')) OVER w) AS following,
         coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id
  FROM documents WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
e AS (
  SELECT *, left(text, length(text) - length(text) // 2) || left(following, length(text) // 2) AS edited FROM d
),
versions AS (
  SELECT doc_id, v, t, list_sort([x FOR x IN list_distinct(string_split_regex(lower(t), '[^\p{L}\p{N}]+')) IF x <> '']) AS terms
  FROM (SELECT doc_id, 0 AS v, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e)
),
spread AS (SELECT doc_id, v, unnest(terms) AS term FROM versions),
lexicon AS (
  SELECT term FROM spread WHERE v = 0 GROUP BY term
  HAVING count(*) >= 0.002 * (SELECT count(*) FROM documents) AND count(*) <= 0.25 * (SELECT count(*) FROM documents)
),
subs AS (SELECT term, ('0x' || substring(md5(term), 1, 4))::INT % 64 AS j FROM lexicon),
met AS (SELECT doc_id, v, count(*) AS n FROM spread JOIN lexicon USING (term) GROUP BY doc_id, v HAVING count(*) >= 4),
codes AS (
  SELECT doc_id, v, j, j || ':' || substring(md5(j || ':' || string_agg(term, ' ' ORDER BY term)), 1, 10) AS code
  FROM spread JOIN subs USING (term) JOIN met USING (doc_id, v) GROUP BY doc_id, v, j
),
rows_ AS (SELECT doc_id, v, list(j) AS met, list(code) AS codes, string_agg(code, '.' ORDER BY j) AS text FROM codes GROUP BY doc_id, v),
f AS (
  SELECT x.doc_id, x.v, md5(array_to_string(x.terms, ' ')) AS whole, coalesce(r.met, []) AS met, coalesce(r.codes, []) AS codes,
         coalesce(r.text, '=' || md5(array_to_string(x.terms, ' '))) AS fingerprint
  FROM versions x LEFT JOIN rows_ r ON r.doc_id = x.doc_id AND r.v = x.v
),
pairs AS (
  SELECT e.doc_id, 'near_edited' AS kind, a.whole = b.whole AS same, len(list_intersect(a.codes, b.codes)) AS n,
         len(list_distinct(list_concat(a.met, b.met))) AS m
  FROM e JOIN f a ON a.doc_id = e.doc_id AND a.v = 0 JOIN f b ON b.doc_id = e.doc_id AND b.v = 1
  UNION ALL
  SELECT e.doc_id, 'near_next', a.whole = b.whole, len(list_intersect(a.codes, b.codes)), len(list_distinct(list_concat(a.met, b.met)))
  FROM e JOIN f a ON a.doc_id = e.doc_id AND a.v = 0 JOIN f b ON b.doc_id = e.next_id AND b.v = 0
),
near AS (
  SELECT doc_id, kind, CASE WHEN m = 0 THEN CASE WHEN same THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE n::DOUBLE / m END AS value FROM pairs
)
SELECT e.doc_id, CAST(length(e.text) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256,
       a.fingerprint, b.fingerprint AS edited_fingerprint, c.value AS near_edited, o.value AS near_next
FROM e JOIN f a ON a.doc_id = e.doc_id AND a.v = 0 JOIN f b ON b.doc_id = e.doc_id AND b.v = 1
JOIN near c ON c.doc_id = e.doc_id AND c.kind = 'near_edited' JOIN near o ON o.doc_id = e.doc_id AND o.kind = 'near_next'
"""

SQL: dict[str, str] = {"op2_suffix_dedup": OP2, "op3_imatch": OP3, "op9_seed_extend": OP9}


def _crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    code = f"CAST('0x' || substring(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    codes = f"[{code} FOR i IN range(0, octet_length(encode({text})))]"
    bit = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    step = f"list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda a, k: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {step}), 4294967295)"


def _measured(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_measured(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """Levels of all trees over ``{name}_0`` (tree, idx, h), with each node's siblings; single nodes stay as they are."""
    parts = []
    for level in range(levels):
        parts.append(
            f"""{name}_n{level} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}_{level}),
{name}_s{level} AS (
  SELECT tree, idx, h, n,
         coalesce(CASE WHEN n > 1 THEN string_agg(h, '' ORDER BY idx) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END, '') AS l,
         coalesce(CASE WHEN n > 1 THEN string_agg(h, '' ORDER BY idx) OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END, '') AS r
  FROM {name}_n{level} WINDOW run AS (PARTITION BY tree, idx // 3 ORDER BY idx)
),
{name}_{level + 1} AS (
  SELECT tree, idx // 3 AS idx, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM {name}_s{level} GROUP BY tree, idx // 3
)"""
        )
    return ",\n".join(parts)


def _fold(name: str, levels: int, start: str, tree: str) -> str:
    """From rows of ``start`` (idx, acc, proof), up through all levels: ``{name}_f{levels}``."""
    parts, before = [], start
    for level in range(levels):
        parts.append(
            f"""{name}_f{level + 1} AS (
  SELECT x.* EXCLUDE (idx, acc, proof), x.idx // 3 AS idx, proof || s.l || s.r AS proof,
         CASE WHEN s.n > 1 THEN sha256(s.l || x.acc || s.r) ELSE x.acc END AS acc
  FROM {before} x JOIN {name}_s{level} s ON s.tree = x.{tree} AND s.idx = x.idx
)"""
        )
        before = f"{name}_f{level + 1}"
    return ",\n".join(parts)


#: levels of three slots: sources of up to 3^10 documents, up to 3^6 sources
LEAVES, SOURCES = 10, 6

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS h,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
  FROM documents
),
a AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM d),
l_0 AS (SELECT tree, idx, h FROM a),
{_tree("l", LEAVES)},
b AS (SELECT tree AS source_tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx FROM l_{LEAVES}),
t_0 AS (SELECT 0 AS tree, idx, h FROM b),
{_tree("t", SOURCES)},
climbing AS (SELECT doc_id, h AS leaf, tree, idx, claimed AS acc, '' AS proof FROM a),
{_fold("l", LEAVES, "climbing", "tree")},
higher AS (
  SELECT f.doc_id, f.leaf, b.h AS subroot, 0 AS top, b.idx, f.acc, f.proof
  FROM l_f{LEAVES} f JOIN b ON b.source_tree = f.tree
),
{_fold("t", SOURCES, "higher", "top")}
SELECT f.doc_id, f.leaf, f.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.acc AS folded_root, f.acc = r.h AS verified
FROM t_f{SOURCES} f CROSS JOIN t_{SOURCES} r
"""

OP13 = rf"""
WITH runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents)
  GROUP BY 1, 2
),
coded AS (SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs WHERE length(run) >= 5),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM coded
),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
gaps AS (
  SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
),
pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON b.word = a.rest
  UNION
  SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON b.word = a.rest
),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * w.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * w.n THEN b.near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
),
r0 AS (SELECT word, coalesce(form, word) AS root FROM forms),
r1 AS (SELECT a.word, b.root FROM r0 a JOIN r0 b ON b.word = a.root),
r2 AS (SELECT a.word, b.root FROM r1 a JOIN r1 b ON b.word = a.root),
r3 AS (SELECT a.word, b.root FROM r2 a JOIN r2 b ON b.word = a.root),
r4 AS (SELECT a.word, b.root FROM r3 a JOIN r3 b ON b.word = a.root),
r5 AS (SELECT a.word, b.root FROM r4 a JOIN r4 b ON b.word = a.root),
r6 AS (SELECT a.word, b.root FROM r5 a JOIN r5 b ON b.word = a.root)
SELECT forms.word, form, r6.root, n, n_near, form_n FROM forms JOIN r6 ON r6.word = forms.word
"""

SQL.update({"op12_merkle": OP12, "op13_spelling": OP13})
