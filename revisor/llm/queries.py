"""The registered queries of the operators, and their SQL where there is one.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisor.llm import bpe, decontaminate, fingerprints, langid, licenses, merkle, neardup, packing, periodic, rollups, substrings, urlfilter, warc
from revisor.llm.common import staged
from revisor.session import stage_dir

#: The rules of the url query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


SALTS = 64


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(_table(spark, sf_dir, "pages"), rules)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(_table(spark, sf_dir, "documents"), digest_only=True)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(_table(spark, sf_dir, "pages"))
    return warc.page_captures(warc.assemble(warc.read_records(spark, path)))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every document, revise every count to a second tokenizer, delete the repeats of equal texts.

    The revision is applied twice under one batch id; the second time has no effect.
    """
    import public_tokenizers

    versions = {"byte_bpe": public_tokenizers.path("byte_bpe_50k.tiktoken"),
                "byte_bpe_multi": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}
    docs = _table(spark, sf_dir, "documents").withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    counted, _ = staged(rollups.count_tokens(docs, versions, carry=("source", "lang", "digest")), "token-counts")
    old, new = (rollups.side(F.col("source"), F.col("lang"), F.lit(v), F.col(f"n_{v}")) for v in versions)
    rollup = rollups.Rollup(spark, stage_dir(spark, "rollup"))
    rollup.apply("load", counted.select(rollups.no_side().alias("before"), old.alias("after")))
    revise = counted.select(old.alias("before"), new.alias("after"))
    rollup.apply("revise", revise)
    rollup.apply("revise", revise)
    # texts that occur twice, dealt to SALTS keys each: a text that fills a third of the corpus meets in no one task
    first = counted.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        "digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    repeats = salted.join(first, ["digest", "salt"]).filter(F.col("doc_id") > F.col("first"))
    rollup.apply("delete-repeats", repeats.select(new.alias("before"), rollups.no_side().alias("after")))
    return rollup.totals()


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def _id_checksum(doc_id: Column) -> Column:
    """Unsigned CRC-32 of the id's decimal form."""
    return F.crc32(doc_id.cast("string"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return merkle.checked(docs, _id_checksum(F.col("doc_id")) % 5 == 0)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    found = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def _planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words of a text in which the words from ``a`` on repeat the first ``p`` of them."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(_table(spark, sf_dir, "documents"), rewrite=_planted)
    return found.select("doc_id", F.col("n_runs"), "start", "length", "period",
                        F.floor(F.col("length") * 1000 / F.col("period")).alias("exponent_milli"),
                        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_url_filter": op2_url_filter,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_license_scan": op5_license_scan,
    "op6_neardup": op6_neardup,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_token_rollup": op9_token_rollup,
    "op10_language_id": op10_language_id,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe": op12_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {}

_ORACLE_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
ORACLE_SQL["op2_url_filter"] = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_ORACLE_RULES}),
cut AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
parts AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
),
fits AS (
  SELECT p.page_id, r.*, row_number() OVER (PARTITION BY p.page_id
      ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) AS rank
  FROM parts p JOIN rules r
    ON (p.host = rule_host OR suffix(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
)
SELECT p.page_id, p.host, p.path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.rank = 1
"""

_WORDS = r"'[^\x20\x09-\x0D]+'"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op3_substring_dedup"] = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts WHERE len(w) >= 50)
),
firsts AS (SELECT run, min(doc_id) AS first FROM places GROUP BY run),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM places JOIN firsts USING (run) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

ORACLE_SQL["op6_neardup"] = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_WORDS}) AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)
),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT w.b, r.root FROM reach r JOIN ways w ON w.a = r.node
)
SELECT node AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id, node = min(root) AS kept
FROM reach LEFT JOIN sizes ON doc_id = node GROUP BY node
"""

ORACLE_SQL["op7_warc"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""

#: Unsigned CRC-32 of a column's decimal form: eight shifts a byte.
_CRC32 = """xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
  lambda a, c: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, c)),
  4294967295::BIGINT), 4294967295)"""


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


_LEAF = " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op11_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, {_sql_field("source")} AS tree, source, sha256({_LEAF} || {_sql_field("text")}) AS leaf,
    CASE WHEN {_CRC32} % 5 = 0 THEN sha256({_LEAF} || {_sql_field(_LOWER)}) END AS other
  FROM documents
),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos FROM leaves),
up AS (
  SELECT tree, 0 AS level, pos, leaf AS node FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM up) WHERE m > 1 GROUP BY tree, pos // 16
),
heights AS (SELECT tree, max(level) AS height FROM up GROUP BY tree),
subroots AS (SELECT tree, node AS subroot FROM up JOIN heights USING (tree) WHERE level = height),
sources AS (
  SELECT tree, subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos
  FROM subroots JOIN (SELECT DISTINCT tree, source FROM leaves) USING (tree)
),
top AS (
  SELECT 0 AS level, pos, subroot AS node FROM sources
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS m FROM top) WHERE m > 1 GROUP BY pos // 16
),
root AS (SELECT node AS root, level AS height FROM top ORDER BY level DESC LIMIT 1),
-- every level's node above a document, and its run's other nodes
own AS (
  SELECT p.doc_id, l.level, p.pos // (16 ** l.level)::BIGINT AS at, false AS in_top, p.tree
  FROM placed p JOIN heights h USING (tree) JOIN (SELECT DISTINCT level FROM up) l ON l.level < h.height
  UNION ALL
  SELECT p.doc_id, h.height + l.level, s.pos // (16 ** l.level)::BIGINT, true, p.tree
  FROM placed p JOIN heights h USING (tree) JOIN sources s USING (tree)
  JOIN (SELECT DISTINCT level FROM top) l ON l.level < (SELECT height FROM root)
),
nodes AS (
  SELECT tree, level, pos, node FROM up
  UNION ALL SELECT s.tree, h.height + 1000 + t.level, t.pos, t.node FROM top t, sources s JOIN heights h USING (tree)
),
steps AS (
  SELECT o.doc_id, o.level, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < o.at), '') AS before,
    coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > o.at), '') AS after
  FROM own o JOIN nodes n ON n.tree = o.tree AND n.level = o.level + CASE WHEN in_top THEN 1000 ELSE 0 END AND n.pos // 16 = o.at // 16
  GROUP BY o.doc_id, o.level, o.at
),
proofs AS (SELECT doc_id, string_agg(before || after, '' ORDER BY level) AS proof, count(*) AS n FROM steps GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0::BIGINT AS level, coalesce(other, leaf) AS node FROM leaves
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(before || node || after) FROM folds f JOIN steps s ON s.doc_id = f.doc_id AND s.level = f.level
),
folded AS (SELECT doc_id, arg_max(node, level) AS folded_root FROM folds GROUP BY doc_id)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves l JOIN subroots s USING (tree) LEFT JOIN proofs p USING (doc_id) JOIN folded USING (doc_id), root
"""

#: Runs hold six words in a row that stand again one period on, since they have 12 words and two periods at least.
ORACLE_SQL["op13_periodic_runs"] = f"""
WITH plain AS (SELECT doc_id, {_CRC32} AS h, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
places AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN h // 10 % len(w) END AS a, h // 10 AS g FROM plain),
texts AS (
  SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i:
      CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) END AS w
  FROM places
),
sixes AS (
  SELECT doc_id, i, w[i + 1:i + 6] AS six FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS i FROM texts WHERE n >= 6)
),
pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM sixes x JOIN sixes y ON x.doc_id = y.doc_id AND x.six = y.six AND x.i < y.i),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + 5 + q AS length FROM islands GROUP BY doc_id, q, island
  HAVING count(*) + 5 >= q AND count(*) + 5 + q >= 12
),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
longest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS rank FROM runs) WHERE rank = 1
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts t LEFT JOIN listed USING (doc_id) LEFT JOIN longest USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
