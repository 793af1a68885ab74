"""The operators' registered queries, on their whole tables, with production
parameters, and the SQL of those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchlab.llm.common import load

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
QUERIES, SQL = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op1_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded, as digests."""
    from matchlab.llm.bpe import encode_documents
    return encode_documents(load(spark, sf_dir), TOKENIZER, with_ids=False)


@query
def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 1024 ids."""
    from matchlab.llm.packing import pack
    return pack(load(spark, sf_dir), TOKENIZER)


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text."""
    from matchlab.llm.langid import identify
    return identify(load(spark, sf_dir))


@query
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a similarity of 0.85 or more."""
    from matchlab.llm.minhash import near_duplicates
    return near_duplicates(load(spark, sf_dir))


@query
def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    from pyspark.sql import functions as F

    from matchlab.llm.warc import read_archives, write_archives
    from matchlab.session import scratch_path
    pages, path = load(spark, sf_dir, "pages"), scratch_path(spark, "warc")
    write_archives(pages, path)
    kind = dict(pages.dtypes)["page_id"]
    return read_archives(spark, path).where(F.col("gap").isNull()).select(
        F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


SQL["op6_warc_salvage"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS h FROM p),
d AS (SELECT page_id, n, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1)), '') AS b
      FROM h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY b) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, b AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later copies of runs of two or more lines, and of lines of 200 or more characters, deleted, as digests."""
    from pyspark.sql import functions as F

    from matchlab.llm.linededup import dedup_lines
    return dedup_lines(load(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2("text", 256).alias("kept_sha256"))


SQL["op10_line_dedup"] = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l
      WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')),
w AS (SELECT doc_id, k, line AS a, lead(line) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM k),
r AS (SELECT doc_id, k, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, k) AS nth FROM w WHERE b IS NOT NULL),
s AS (SELECT doc_id, k, row_number() OVER (PARTITION BY line ORDER BY doc_id, k) AS nth FROM k WHERE length(line) >= 200),
g AS (SELECT doc_id, k FROM r WHERE nth > 1 UNION SELECT doc_id, k + 1 FROM r WHERE nth > 1
      UNION SELECT doc_id, k FROM s WHERE nth > 1),
m AS (SELECT k.doc_id, k.i, 1 AS gone, CASE WHEN p.k IS NULL THEN 1 ELSE 0 END AS begins
      FROM k JOIN g USING (doc_id, k) LEFT JOIN g p ON p.doc_id = g.doc_id AND p.k = g.k - 1)
SELECT l.doc_id, count(*) AS n_lines, CAST(sum(coalesce(gone, 0)) AS BIGINT) AS n_removed,
       CAST(sum(coalesce(begins, 0)) AS BIGINT) AS n_runs,
       sha256(coalesce(string_agg(CASE WHEN gone IS NULL THEN line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN m ON m.doc_id = l.doc_id AND m.i = l.i GROUP BY l.doc_id"""


@query
def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    from matchlab.llm.ordermin import fingerprint_edits
    return fingerprint_edits(load(spark, sf_dir))


@query
def op8_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The basic counts and the verdict of rules and perplexity bands."""
    from matchlab.llm.quality import judge
    return judge(load(spark, sf_dir))


@query
def op4_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's log-probability, next to that of a plain word model."""
    from matchlab.llm.suffixtree import lm_scores
    return lm_scores(load(spark, sf_dir))


@query
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in repeated strings of 200 bytes removed, as digests."""
    from matchlab.llm.suffixdedup import dedup_digests
    return dedup_digests(load(spark, sf_dir))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text (a tenth of them with a periodic tail), as digests."""
    from matchlab.llm.periodic import run_digests
    return run_digests(load(spark, sf_dir))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tokenizers' tokens aligned by their bytes, with corpus-wide counts of linked ids."""
    from matchlab.llm.align import alignments
    return alignments(load(spark, sf_dir), TOKENIZER, PIECES)


@query
def op13_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every query vector."""
    from matchlab.llm.pivots import top_k
    return top_k(load(spark, sf_dir, "embeddings"))


SQL["op13_pivot_top_k"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5"""
