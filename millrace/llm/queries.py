"""Registered queries of the operators: ``QUERIES`` and, where SQL can say it, ``ORACLES``.

Each query applies one operator, with the parameters it would have in
production, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bisector_clusters,
    code_compression,
    inner_products,
    jaccard_join,
    language,
    line_dedup,
    packing,
    quality,
    substring_dedup,
    token_counts,
    toxicity,
    tree_bpe,
    vector_search,
)
from millrace.llm.frames import prepared

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under a name."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(prepared(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_toxicity")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumn("held_out", language.held_out())


@query("op2_language")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    return language.predict(docs, model).withColumn("held_out", language.held_out())


@query("op3_line_dedup")
def op3(spark, sf_dir):
    return line_dedup.classes(table(spark, sf_dir, "documents"))


@query("op4_packing")
def op4(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return tree_bpe.round_trip_digests(table(spark, sf_dir, "documents"), path)


OP6_SQL = r"""
WITH parts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, place, array_to_string(words[place : place + 49], ' ') AS run
  FROM parts, LATERAL (SELECT unnest(range(1, len(words) - 48)) AS place)
), firsts AS (
  SELECT run, min(doc_id) AS first FROM windows GROUP BY run HAVING min(doc_id) < max(doc_id)
), hits AS (
  SELECT doc_id, place FROM windows JOIN firsts USING (run) WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, place + step AS place FROM hits, LATERAL (SELECT unnest(range(50)) AS step)
), numbered AS (
  SELECT doc_id, words[place] AS word, place FROM parts, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS place)
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n
  FROM numbered ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM parts LEFT JOIN kept USING (doc_id)
"""


@query("op6_substring_dedup", OP6_SQL)
def op6(spark, sf_dir):
    return substring_dedup.digests_after(table(spark, sf_dir, "documents"))


@query("op7_vector_search")
def op7(spark, sf_dir):
    return vector_search.search(table(spark, sf_dir, "embeddings"))


OP8_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(words[place : place + 4], ' ') AS shingle
  FROM parts, LATERAL (SELECT unnest(range(1, greatest(len(words) - 3, 2))) AS place) WHERE len(words) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 80 * ((SELECT n FROM sizes s WHERE s.doc_id = a.doc_id)
                                + (SELECT n FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM parts
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


@query("op8_jaccard_join", OP8_SQL)
def op8(spark, sf_dir):
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


@query("op9_token_counts")
def op9(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_compression_bands")
def op10(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


def _whole_numbers(factor: int, condition: str = "TRUE", kept: str = "vec_id, label") -> str:
    """Usable vectors as lists of whole numbers, which DuckDB holds as exact doubles."""
    return f"""
  SELECT {kept}, list_transform(embedding, lambda x: floor({factor} * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND {condition}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""


OP11_SQL = f"""
WITH vectors AS ({_whole_numbers(256, "vec_id IS NOT NULL")}
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(max(list_dot_product(q.vec, c.vec)) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.vec) = len(c.vec)
  GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op11_inner_products", OP11_SQL)
def op11(spark, sf_dir):
    return inner_products.search(table(spark, sf_dir, "embeddings"))


def _nearest(name: str, vectors: str, entries: str) -> str:
    """A common table of the nearest entry of every vector of a group, ties to the smaller number."""
    square = "list_dot_product({0}.vec, {0}.vec)"
    far = f"{square.format('v')} - 2 * list_dot_product(v.vec, e.vec) + {square.format('e')}"
    return f"""
{name} AS MATERIALIZED (
  SELECT number, part, arg_min(entry, (far, entry)) AS entry, CAST(min(far) AS BIGINT) AS far
  FROM (SELECT v.number, v.part, e.entry, {far} AS far FROM {vectors} v JOIN {entries} e USING (part))
  GROUP BY number, part
)"""


def _rounds(rounds: int, vectors: str) -> str:
    """Entries of every round: floors of the means of their vectors; entries without vectors stay."""
    steps = []
    for n in range(rounds):
        steps.append(_nearest(f"near{n}", vectors, f"entries{n}"))
        steps.append(f"""
means{n} AS MATERIALIZED (
  SELECT part, entry, list(floor(CAST((total - ((total % n) + n) % n) AS DOUBLE) / n) ORDER BY place) AS vec
  FROM (
    SELECT part, entry, place, sum(CAST(value AS HUGEINT)) AS total, count(*) AS n
    FROM near{n} JOIN (
      SELECT number, part, unnest(vec) AS value, unnest(range(len(vec))) AS place FROM {vectors}
    ) USING (number, part) GROUP BY part, entry, place
  ) GROUP BY part, entry
)""")
        steps.append(f"""
entries{n + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.vec, e.vec) AS vec FROM entries{n} e LEFT JOIN means{n} m USING (part, entry)
)""")
    steps.append(_nearest("assigned", vectors, f"entries{rounds}"))
    return ",".join(steps)


OP12_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, vec) AS number, * FROM ({_whole_numbers(1024)})
), pieces AS MATERIALIZED (
  SELECT number, part, vec[part * len(vec) // 4 + 1 : (part + 1) * len(vec) // 4] AS vec FROM kept, range(4) AS t(part)
), entries0 AS MATERIALIZED (
  SELECT part, number - 1 AS entry, vec FROM pieces WHERE number <= 256
),{_rounds(4, "pieces")}
, codes AS (
  SELECT number, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM assigned GROUP BY number
), digest AS (
  SELECT sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(vec) AS value, unnest(range(len(vec))) AS place FROM entries4)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (number), digest
"""


@query("op12_code_compression", OP12_SQL)
def op12(spark, sf_dir):
    return code_compression.compress(table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec) AS number, 0 AS part, *
  FROM ({_whole_numbers(256, "len(embedding) = 64", "vec_id")})
), entries0 AS MATERIALIZED (
  SELECT part, number - 1 AS entry, vec FROM kept WHERE number <= 40
),{_rounds(5, "kept")}
, digests AS (
  SELECT entry, sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
  FROM (SELECT entry, unnest(vec) AS value, unnest(range(len(vec))) AS place FROM entries5) GROUP BY entry
)
SELECT vec_id, CAST(entry AS INTEGER) AS cluster, far AS distance,
  CAST(sum(far) OVER (PARTITION BY entry) AS BIGINT) AS cluster_inertia, CAST(sum(far) OVER () AS BIGINT) AS inertia,
  centroid_sha256
FROM kept JOIN assigned USING (number) JOIN digests USING (entry)
"""


@query("op13_bisector_clusters", OP13_SQL)
def op13(spark, sf_dir):
    return bisector_clusters.cluster(table(spark, sf_dir, "embeddings"))
