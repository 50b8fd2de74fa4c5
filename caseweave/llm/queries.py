"""Registered queries of the operators and their oracle SQL (DuckDB)."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from caseweave.llm.byte_pairs import token_counts
from caseweave.llm.common import table
from caseweave.llm.embedding_dedup import SIMILARITY, embedding_duplicates
from caseweave.llm.fingerprints import fingerprints
from caseweave.llm.license_scan import COVERAGE, DRIFT, scan_licenses
from caseweave.llm.license_texts import NOTICES, PHRASES
from caseweave.llm.mixing import mix
from caseweave.llm.near_dedup import near_duplicates
from caseweave.llm.piece_codec import encode_decode
from caseweave.llm.quality_classifier import quality
from caseweave.llm.quality_rules import quality_rules
from caseweave.llm.spelling_variants import (
    FORM_FACTOR,
    MIN_COUNT,
    MIN_LETTERS,
    TYPO_RATE,
    spelling_variants,
)
from caseweave.llm.token_alignment import align_tokenizers
from caseweave.llm.toxicity import toxicity
from caseweave.llm.web_archive import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode_decode(table(spark, sf_dir, "documents"), model)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, sf_dir, "documents"), tokenizer)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op8_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(table(spark, sf_dir, "pages"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("repetitions")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), a, b)


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_sentencepiece_codec": op2_sentencepiece_codec,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_quality_rules": op7_quality_rules,
    "op8_web_archive": op8_web_archive,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_embedding_near_dedup": op13_embedding_near_dedup,
}

OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n m ON m.doc_id = x JOIN n k ON k.doc_id = y
  WHERE 100 * c >= 75 * (m.n + k.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (
  SELECT doc_id AS id, doc_id AS root FROM documents
  UNION
  SELECT e.y, r.root FROM r JOIN e ON e.x = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM documents d JOIN c ON c.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

def _op3_sql() -> str:
    """Places by comparing words, notices by joining word triples; the notices' triples
    are written out, so nothing but the texts is read."""
    triples = []
    for notice, (label, text) in enumerate(NOTICES):
        ws = re.findall("[0-9a-z]+", text.lower())
        for at in range(len(ws) - 2):
            gram = " ".join(ws[at : at + 3])
            triples.append(f"({notice}, '{label}', {len(ws)}, {len(ws) - 2}, {at}, '{gram}')")
    places, named = [], []
    for phrase, label in PHRASES.items():
        parts = " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        found = f"list_filter(range(1, len(ws) + 1), lambda i: {parts})"
        places.append(found)
        named.append(f"CASE WHEN len({found}) > 0 THEN ['{label}'] ELSE [] END")
    return rf"""
WITH t(notice, label, notice_words, n_grams, place, gram) AS (VALUES {", ".join(triples)}),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
  FROM documents),
g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i:
      {{'pos': i - 1, 'gram': ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]}}), recursive := true)
  FROM d),
v AS (SELECT doc_id, notice, label, n_grams, place, pos, pos - place AS off FROM g JOIN t USING (gram)),
o AS (SELECT DISTINCT doc_id, notice, off AS centre FROM v),
k AS (
  SELECT v.doc_id, v.notice, label, n_grams, centre, place, arg_min(pos, (abs(off - centre), off)) AS pos
  FROM v JOIN o ON v.doc_id = o.doc_id AND v.notice = o.notice AND abs(off - centre) <= {DRIFT}
  GROUP BY v.doc_id, v.notice, label, n_grams, centre, place),
c AS (
  SELECT doc_id, label, list_reduce(
      list({{'n': 1, 'last': pos}} ORDER BY place),
      lambda a, x: CASE WHEN x.last > a.last THEN {{'n': a.n + 1, 'last': x.last}} ELSE a END).n::DOUBLE
    / n_grams AS coverage
  FROM k GROUP BY doc_id, notice, label, n_grams, centre),
l AS (
  SELECT doc_id, list(DISTINCT label) AS more, max(coverage) AS coverage FROM c
  WHERE coverage >= {COVERAGE} - 1e-9 GROUP BY doc_id),
p AS (
  SELECT doc_id, len(ws) AS n, list_concat({", ".join(places)}) AS spots,
    CAST(list_concat({", ".join(named)}) AS VARCHAR[]) AS base
  FROM d)
SELECT p.doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base,
  CAST(list_min(spots) - 1 AS BIGINT) AS first_word, CAST(list_max(spots) - 1 AS BIGINT) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(more, [])))), ',') AS labels,
  CASE WHEN len(base) > 0 THEN 1.0::DOUBLE ELSE coalesce(coverage, 0.0)::DOUBLE END AS score
FROM p LEFT JOIN l ON l.doc_id = p.doc_id
"""


OP8_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
    THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS latest
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < latest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < latest THEN latest END AS refers_to
FROM m
"""

_OP9_START = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
      AS place
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS n,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, 3.0 * n / w AS ratio, sum(n) OVER ()::BIGINT AS total,
    coalesce(sum(3 * n) OVER (ORDER BY 3.0 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0)::BIGINT AS used,
    sum(w) OVER (ORDER BY 3.0 * n / w, source ROWS BETWEEN CURRENT ROW
      AND UNBOUNDED FOLLOWING)::BIGINT AS free
  FROM s),
v AS (SELECT (total - used) / free::DOUBLE AS level FROM l
      WHERE w * ((total - used) / free::DOUBLE) <= 3 * n ORDER BY ratio, source LIMIT 1),
t AS (
  SELECT source, n, CASE WHEN level IS NULL OR w * level > 3 * n THEN (3 * n)::DOUBLE
    ELSE w * level END AS target
  FROM s LEFT JOIN v ON true),
p AS (
  SELECT *, CASE WHEN n > 0 THEN least(3, floor(target / n + 1e-9))::BIGINT ELSE 0 END AS whole
  FROM t),
r AS (SELECT *, greatest(0.0::DOUBLE, target - whole * n) AS rest FROM p),
o0 AS (
  SELECT d.*, r.n, r.target, r.whole, r.rest, 0 AS extra
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)"""

# One document of each source after the other, in order: each is taken if it fits.
_OP9_END = """,
z AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY place, doc_id, size) AS rn
  FROM o0 WHERE size > 0 AND whole < 3),
k AS (
  SELECT source, 0::BIGINT AS rn, rest AS gap, NULL::BIGINT AS doc_id, FALSE AS took FROM r
  UNION ALL
  SELECT k.source, z.rn, CASE WHEN z.size <= k.gap THEN k.gap - z.size ELSE k.gap END, z.doc_id,
    z.size <= k.gap
  FROM k JOIN z ON k.source IS NOT DISTINCT FROM z.source AND z.rn = k.rn + 1),
m AS (SELECT source, min(gap) AS missing FROM k GROUP BY source),
x AS (SELECT doc_id FROM k WHERE took),
b AS (
  SELECT z.source, arg_min(z.doc_id, (abs(z.size - m.missing), z.place, z.doc_id)) AS best
  FROM z JOIN m ON z.source IS NOT DISTINCT FROM m.source
  WHERE z.doc_id NOT IN (SELECT doc_id FROM x) AND abs(z.size - m.missing) < m.missing
  GROUP BY z.source)
SELECT o.doc_id, o.size, o.n AS source_size, o.target,
  o.size * (whole + CASE WHEN o.doc_id IN (SELECT doc_id FROM x) OR b.best = o.doc_id THEN 1 ELSE 0 END)::BIGINT
    AS taken
FROM o0 o LEFT JOIN b ON o.source IS NOT DISTINCT FROM b.source
"""

OP9_SQL = _OP9_START.replace("WITH d AS", "WITH RECURSIVE d AS") + _OP9_END


# A step of CRC-32 over a byte: the remainder of its lowest eight bits is the sum, by
# exclusive or, of what each bit leaves. Fixed value: the reversed polynomial.
def _crc_step(c: str, byte: str) -> str:
    low = f"(xor({c}, {byte}) & 255)"
    terms = []
    for bit in range(8):
        left = 1 << bit
        for _ in range(8):
            left = (left >> 1) ^ (0xEDB88320 if left & 1 else 0)
        terms.append(f"(({low} >> {bit}) & 1) * {left}")
    out = f"({c} >> 8)"
    for term in terms:
        out = f"xor({out}, {term})"
    return out


OP11_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
r AS (
  SELECT run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS hashed
  FROM t WHERE length(run) >= {MIN_LETTERS} GROUP BY doc_id, run),
h AS (
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(
    list_transform(string_split(hashed, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT]
      ELSE [195::BIGINT, (ord(x) - 64)::BIGINT] END))),
    lambda c, b: {_crc_step("c", "b")})) AS crc
  FROM r),
w AS (
  SELECT CASE WHEN crc % {TYPO_RATE} = 0
    THEN substr(run, 1, (crc % length(run))::BIGINT) || substr(run, (crc % length(run))::BIGINT + 2)
    ELSE run END AS word, n
  FROM h),
v AS (
  SELECT word, sum(n)::BIGINT AS n FROM w GROUP BY word
  HAVING length(word) >= {MIN_LETTERS} AND sum(n) >= {MIN_COUNT}),
c AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
s AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM c),
p AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM s a JOIN s b
    ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION
  SELECT s.word, s.n, v.word, v.n FROM s JOIN v ON s.less = v.word
  UNION
  SELECT v.word, v.n, s.word, s.n FROM s JOIN v ON s.less = v.word),
q AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most,
    arg_min(near, (-near_n, near)) AS near FROM p GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(q.n_near, 0) AS n_near,
    CASE WHEN most >= {FORM_FACTOR} * v.n THEN near END AS form,
    CASE WHEN most >= {FORM_FACTOR} * v.n THEN most END AS form_n
  FROM v LEFT JOIN q ON q.word = v.word),
u AS (
  SELECT word, word AS root, form AS onward FROM f
  UNION ALL
  SELECT u.word, f.word, f.form FROM u JOIN f ON f.word = u.onward)
SELECT f.word, f.form, u.root, f.n, f.n_near, f.form_n
FROM f JOIN u ON u.word = f.word AND u.onward IS NULL
"""

OP13_SQL = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
    ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= {SIMILARITY}),
r AS (
  SELECT vec_id AS id, vec_id AS root FROM embeddings
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) AS root FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, root AS component_id, vec_id = root AS kept
FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""

ORACLE: dict[str, str] = {
    "op3_license_scan": _op3_sql(),
    "op8_web_archive": OP8_SQL,
    "op9_source_mixing": OP9_SQL,
    "op1_minhash_near_dedup": OP1_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op13_embedding_near_dedup": OP13_SQL,
}
