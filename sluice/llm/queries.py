"""The registered queries of the operators of this package, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import ann, divergence, extraction, importance, line_dedup, mixing, packing, quality
from sluice.llm import secret_scan, simhash, substring, token_files, warc
from sluice.llm.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@_query("op1_learned_partitions")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 100 = 0"))


@_query("op2_secret_scan")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    every = (*secret_scan.KINDS, "markov")
    return found.select(
        "doc_id",
        *(F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in every),
        F.sha2(secret_scan.listed(secret_scan.KINDS), 256).alias("base_sha256"),
        secret_scan.listed(every).alias("spans"),
    )


@_query("op3_template_removal")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


_WORD_LIST = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_OP4_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         {_WORD_LIST} AS w
  FROM documents
), v AS (
  SELECT r, i, list_slice(w, i, i + {quality.WINDOW - 1}) AS win
  FROM (SELECT r, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) AS i FROM t)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS k FROM v) WHERE k > 1
), cov AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + {quality.WINDOW})) AS p FROM rep) GROUP BY r
), ln AS (
  SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM t)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r
), c AS (
  SELECT t.doc_id, t.host, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN cov USING (r) LEFT JOIN ln USING (r)
), f AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c
), h AS (
  SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM f GROUP BY host
), g AS (
  SELECT sum(n) AS n, sum(k) / sum(n) AS m, count(*) AS hosts, sum(n * n) AS squares, sum(k * k / n) AS spread FROM h
), p AS (
  SELECT m, (spread - n * m * m - (hosts - 1) * m * (1 - m)) / nullif(greatest(n - squares / n, 0), 0) AS variance FROM g
), a AS (
  SELECT m, CASE WHEN variance > 0 THEN least(greatest(m * (1 - m) / variance - 1, 1.0), 1e6) ELSE 1e6 END AS weight FROM p
), bad AS (
  SELECT host FROM h, a WHERE (k + weight * m) / (n + weight) > {quality.MAX_HOST_RATE}
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host NOT IN (SELECT host FROM bad) AS kept
FROM f
"""


@_query("op4_host_quality", _OP4_SQL)
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).drop("host")


_OP5_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source,
         coalesce(source, '') || '|' || coalesce(doc_id::VARCHAR, '') AS k, length(coalesce(text, '')) AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::DOUBLE AS size, sqrt(sum(size)::DOUBLE) AS weight FROM d GROUP BY source
), r AS (
  SELECT source, CASE WHEN size > 0 THEN weight * (sum(size) OVER () / sum(weight) OVER ()) / size ELSE 1.0 END AS rate FROM s
), n AS (
  SELECT source, rate, greatest(1, ceil(rate / {mixing.STEP}))::INT AS draws FROM r
), pmf AS (
  SELECT source, draws, j,
         exp(-rate / draws + j * ln(rate / draws) - lgamma(j + 1)) AS p
  FROM n, range(0, 97) t(j)
), cdf AS (
  SELECT source, draws, list(c ORDER BY j) AS c
  FROM (SELECT source, draws, j, sum(p) OVER (PARTITION BY source ORDER BY j) AS c FROM pmf) GROUP BY source, draws
), u AS (
  SELECT doc_id, d.source, c, k,
         list_transform(range(1, draws + 1),
           lambda i: ('0x' || substr(md5('{mixing.SEED}|' || k || '|' || i::VARCHAR), 1, 13))::BIGINT / {mixing.UNIT}) AS us
  FROM d JOIN cdf USING (source)
), m AS (
  SELECT doc_id, source, list_sum(list_transform(us, lambda x: len(list_filter(c, lambda y: y <= x)))) AS copies FROM u
)
SELECT doc_id, source, unnest(range(1, copies::BIGINT + 1))::INT AS copy FROM m WHERE copies > 0
"""


@_query("op5_poisson_mixing", _OP5_SQL)
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", F.col("_m_copy").alias("copy"))


@_query("op6_rans_token_files")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), added_tokens=True)


_OP7_SQL = f"""
WITH t AS (
  SELECT doc_id, {_WORD_LIST} AS w FROM documents
), v AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {substring.WINDOW - 1}), ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring.WINDOW - 2})) AS i FROM t)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM v) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substring.WINDOW})) AS p FROM later
), g AS (
  SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
), word AS (
  SELECT t.doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM t
), kept AS (
  SELECT word.doc_id, string_agg(x, ' ' ORDER BY p) AS text, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id
)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""


@_query("op7_count_min_substrings", _OP7_SQL)
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op8_genetic_packing")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), added_tokens=True)


@_query("op9_warc_packages")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


@_query("op10_multi_index_simhash")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


_OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), o AS (
  SELECT r, lang, source, unnest(w) AS term FROM d
), k AS (
  SELECT lang, term, count(*)::HUGEINT AS n FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.MIN_DOCS}
), lt AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), gn AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source
), p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
         1 + {divergence.WHOLE}::HUGEINT * (coalesce(c.n, 0) + {divergence.ADDED}) // (gn.n + {divergence.ADDED} * lt.v) AS p,
         1 + {divergence.WHOLE}::HUGEINT * (k.n + {divergence.ADDED}) // (lt.n + {divergence.ADDED} * lt.v) AS q
  FROM gn JOIN lt USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked
WHERE part = 'pair' OR rank <= {divergence.TOP}
"""


@_query("op11_divergence_audit", _OP11_SQL)
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


# the checksum goes through a text byte by byte: each step is a join with the table of 256 remainders
_OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), b AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), df AS (
  SELECT r, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS f
  FROM d, range(1, {importance.ORDER + 1}) t(k) WHERE len(w) >= k
), bf AS (
  SELECT unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS f
  FROM b, range(1, {importance.ORDER + 1}) t(k) WHERE len(w) >= k
), x AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)
), m AS (
  SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)),
                        lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM range(256) t(i)
), step(f, h, pos, c) AS (
  SELECT f, h, 0, 4294967295::BIGINT FROM x
  UNION ALL
  SELECT f, h, pos + 1, xor(c >> 8, v)
  FROM step JOIN m ON m.i = xor(c & 255, ('0x' || substr(h, 2 * pos + 1, 2))::BIGINT)
  WHERE 2 * pos < length(h)
), bucket AS (
  SELECT f, (xor(c, 4294967295) % {importance.BUCKETS})::INT AS bucket FROM step WHERE 2 * pos = length(h)
), s AS (
  SELECT bucket, count(*) AS n FROM df JOIN bucket USING (f) GROUP BY bucket
), t AS (
  SELECT bucket, count(*) AS n FROM bf JOIN bucket USING (f) GROUP BY bucket
), gain AS (
  SELECT e.i AS bucket,
         floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM s), 0)::DOUBLE + {importance.BUCKETS})
           / ((coalesce(s.n, 0) + 1)::DOUBLE * (coalesce((SELECT sum(n) FROM t), 0)::DOUBLE + {importance.BUCKETS}))))::BIGINT AS gain
  FROM range({importance.BUCKETS}) e(i) LEFT JOIN s ON s.bucket = e.i LEFT JOIN t ON t.bucket = e.i
), w AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM df JOIN bucket USING (f) JOIN gain USING (bucket) GROUP BY r
), scored AS (
  SELECT doc_id, len(d.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
           / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN w USING (r)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {importance.MIN_WORDS} ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_words >= {importance.MIN_WORDS}) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {importance.MIN_WORDS} AND place <= {importance.DRAW} * n // {importance.OF} THEN place::BIGINT END AS rank
FROM placed
"""


@_query("op12_importance_resampling", _OP12_SQL)
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LINE_KEY = (
    "trim(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
)

_OP13_SQL = f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), x AS (
  SELECT r, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS p FROM t
), k AS (
  SELECT r, doc_id, l, p, {_LINE_KEY} AS key FROM x
), f AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}
), g AS (
  SELECT r, l, p, last IS NOT NULL AND last IS DISTINCT FROM doc_id AS gone FROM k LEFT JOIN f USING (key)
), s AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(l, chr(10) ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM g GROUP BY r
)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256
FROM t JOIN s USING (r)
"""


@_query("op13_perfect_hash_lines", _OP13_SQL)
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
