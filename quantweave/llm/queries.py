"""One query per operator, with its SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantweave.llm.attribution import attribute_tokens
from quantweave.llm.bpe import Vocabulary, decode, encode
from quantweave.llm import pii
from quantweave.llm.collocations import collocations
from quantweave.llm.common import materialise, table
from quantweave.llm.contamination import find_contamination
from quantweave.llm.jaccard import jaccard_groups
from quantweave.llm.neighbours import nearest
from quantweave.llm.passages import remove_repeats
from quantweave.llm.popcount import cluster, digest
from quantweave.llm.quality import select_documents
from quantweave.llm.sharding import group_hash, shard_records
from quantweave.llm.trie import score_texts
from quantweave.llm.warc import archive

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def keep(function: Callable) -> Callable:
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return keep


@query("op1_neighbours")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op2_contamination")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op3_jaccard")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents")).drop("node")


@query(
    "op4_warc",
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
m AS (SELECT b, max(page_id) AS top FROM p GROUP BY b),
j AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS x, top FROM p JOIN m USING (b)),
t AS (SELECT *, list_transform(range(8), lambda i: CAST(('0x' || substr(x, CAST(1 + 5 * i AS INT), 5)) AS BIGINT)) AS q FROM j)
SELECT page_id, n AS payload_bytes,
 array_to_string(list_transform(q, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (v >> 15) AS INT), 1)
  || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((v >> 10) & 31) AS INT), 1)
  || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((v >> 5) & 31) AS INT), 1)
  || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (v & 31) AS INT), 1)), '') AS payload_digest,
 CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> top THEN top END AS refers_to FROM t""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return archive(table(spark, folder, "pages")).select(*columns)


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return attribute_tokens(docs, Vocabulary.read(RANKS), public_tokenizers.PATTERN, ("source", "lang", "text"), ("text",))


@query("op6_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return select_documents(docs, table(spark, folder, "labels")).select("doc_id", "expected_grade", "tail")


@query("op7_trie")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


@query("op8_bpe")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = Vocabulary.read(RANKS)
    ids = encode(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)
    return decode(ids, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_repeats")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("kept")


@query("op10_pii")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = materialise(pii.candidates(docs).select("doc_id", "candidates"), "pii")
    rows = pii.accepted(found, pii.train(found))
    base = F.filter("pii", lambda span: span["base"])
    counts = [pii.number_of(kind, base).cast("long").alias(f"n_{kind}") for kind in pii.BASE]
    return rows.select(
        "doc_id", *counts, F.sha2(pii.digest_text(base), 256).alias("base_sha256"), pii.digest_text(F.col("pii")).alias("spans")
    )


#: Counts of all phrases of up to five words by position, their cuts and the longer phrases around them.
COLLOCATIONS_SQL = """WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
 translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (
 SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
 FROM w, range(1, 6) AS lengths(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
cut AS (SELECT f.lang, f.k, phrase, string_split(phrase, ' ') AS w, f AS a, unnest(range(1, k)) AS b FROM f WHERE k > 1),
scored AS (SELECT c.lang, c.k, c.phrase, c.w, c.a, c.b, x.f AS l, y.f AS r, n, CAST(1000::HUGEINT * c.a * n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
 FROM cut c JOIN total USING (lang) JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.b], ' ')
 JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.b + 1:c.k], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, b) = 1),
around AS (SELECT s.lang, s.phrase FROM weakest s JOIN weakest b ON s.lang = b.lang AND b.k > s.k AND b.a >= s.a
 AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM weakest ANTI JOIN around USING (lang, phrase) QUALIFY rank <= 2000"""


@query("op11_collocations", COLLOCATIONS_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _cluster_sql(rounds: int = 10, clusters: int = 8) -> str:
    """The rounds one after the other, on (vector, place, value) rows."""
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS v, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
 FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
x AS MATERIALIZED (SELECT v, unnest(range(64)) AS p, unnest(x) AS x FROM v)""",
        f"c0 AS MATERIALIZED (SELECT c - 1 AS c, unnest(range(64)) AS p, unnest(x) AS x FROM (SELECT x, row_number() OVER (ORDER BY sha256('3:' || vec_id)) AS c FROM v) WHERE c <= {clusters})",
    ]
    for n in range(rounds + 1):
        parts.append(f"d{n} AS (SELECT v, c, sum((x.x - k.x) * (x.x - k.x)) AS d FROM x JOIN c{n} k USING (p) GROUP BY v, c)")
        parts.append(f"a{n} AS MATERIALIZED (SELECT v, arg_min(c, (d, c)) AS c, min(d) AS d FROM d{n} GROUP BY v)")
        if n < rounds:
            parts.append(
                f"c{n + 1} AS MATERIALIZED (SELECT k.c, k.p, coalesce(m.x, k.x) AS x FROM c{n} k LEFT JOIN (SELECT c, p,"
                f" CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM x JOIN a{n} USING (v) GROUP BY c, p) m ON m.c = k.c AND m.p = k.p)"
            )
    return (
        "WITH " + ",\n".join(parts) + f""",
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS h FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
 CAST(sum(d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256 FROM a{rounds} JOIN v USING (v) JOIN h USING (c)"""
    )


@query("op12_popcount", _cluster_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    rows = cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return rows.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest(F.col("centroid")).alias("centroid_sha256"))


#: The order of all records, their place in all bytes, and CRC-32 byte by byte.
SPLITTERS_SQL = """WITH t AS MATERIALIZED (SELECT list(list_reduce(range(8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), n) ORDER BY n) AS t FROM range(256) AS r(n)),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS s FROM documents),
h AS (SELECT doc_id, octet_length(s) + 1 AS size, CAST('0x' || substr(sha256(s), 1, 15) AS BIGINT) AS g,
 list_transform(regexp_extract_all(hex(s), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS b FROM d),
o AS (SELECT doc_id, size, g, xor(coalesce(list_reduce(b, lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]), 4294967295), 4294967295), 4294967295) AS text_crc32,
 sum(size) OVER () AS total, sum(size) OVER (ORDER BY g, doc_id NULLS FIRST) AS upto, sum(size) OVER (PARTITION BY g) AS whole, sum(size) OVER (ORDER BY g) AS group_end FROM h, t),
s AS (SELECT *, CAST(CASE WHEN whole <= 0.01 * total / 16 THEN 2 * group_end - whole ELSE 2 * upto - size END * 16 // (2 * total) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY g, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""


@query("op13_splitters", SPLITTERS_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    whole = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(whole).cast("long") + 1).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        group_hash(whole).alias("group"),
    )
    rows = shard_records(docs, F.col("size"), F.col("group"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
