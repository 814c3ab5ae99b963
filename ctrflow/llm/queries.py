"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ctrflow.llm import (
    bpe, collocations, decontaminate, jaccard, katz, language, merkle, mixing, nearest, substring, topk, toxicity, vectors, warc,
)
from ctrflow.llm.common import Scratch, ids_of_keys, row_keys
from ctrflow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The vocabulary file, at the same place on every machine.
VOCABULARY = os.environ.get("BPE_VOCABULARY") or public_tokenizers.path("byte_bpe_50k.json")


def find_package(spark: SparkSession) -> None:
    """Lets Python workers of this session import the package from where the driver has it, whatever folder they start in.

    On a cluster the package has to be installed, or sent with the job.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def query(name: str, oracle: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, by: int) -> Column:
    """crc32 of a number as text, modulo ``by``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


@query("op1_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where(remainder("doc_id", 3) != 1)
    model = toxicity.fit_toxicity(documents.join(labels, "doc_id"))
    scores = model.score(documents)
    return scores.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


@query("op2_maxscore", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""")
def maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.finite_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(rows, F.col("id") % 100 == 0, 10)


@query("op4_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)
    return done.select(
        "doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_nearest", """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]) AS n FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) / (sqrt(q.n) * sqrt(c.n)) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors.finite_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest.nearest(rows, F.col("id") % 50 == 0, 5)


@query("op8_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), o AS (SELECT h, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY h)
SELECT page_id, payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN o USING (h)
""")
def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.warc_records(warc.resolve_revisits(table(spark, sf_dir, "pages"))), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_substring")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; of rows that share an id the smaller hash of the text is the earlier one."""
    documents, names = row_keys(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", Scratch(spark, "op6"))
    left = substring.remove_repeats(documents, "row_key")
    return ids_of_keys(left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")), names, "doc_id")


@query("op3_jaccard")
def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents, also where rows share an id."""
    documents, names = row_keys(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", Scratch(spark, "op3"))
    return ids_of_keys(jaccard.jaccard_components(documents, "row_key", n=3, percent=90), names, "doc_id", "component_id")


@query("op7_katz")
def katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; those without an id are trained on as ``remainder`` says, and their id stays null."""
    documents, names = row_keys(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", Scratch(spark, "op7"), nameless=True)
    scores = ids_of_keys(katz.katz_scores(documents, remainder("doc_id", 7) != 2, "row_key"), names, "doc_id")
    return scores.select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


#: Wanted shares of tokens by domain.
TARGETS = {"good": 0.90, "low": 0.07, "toxic": 0.03}


def labelled_domains(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, domain) of labelled documents; of several labels the worst counts."""
    worst = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("good")
    return documents.select("doc_id", "text").join(worst.select("doc_id", domain.alias("domain")), "doc_id")


@query("op9_mixing")
def mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = mixing.fit_domains(labelled_domains(documents, table(spark, sf_dir, "labels")), list(TARGETS))
    return mixing.fit_rates(documents, model, TARGETS, anchor="good", highest=4.0)


@query("op10_language")
def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language.fit_languages(documents)
    return language.identify(documents, model, declared="lang", host="source")


@query("language_of_pages")
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of pages: text between tags, the html tag's declaration, suffix and host of the address."""
    model = language.fit_languages(table(spark, sf_dir, "documents"))
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^>]*>", " ")
    return language.identify(
        table(spark, sf_dir, "pages"), model, "page_id", text, language.markup_language(F.col("html")), language.host_of(F.col("url")))


@query("op13_merkle", """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
    -- crc32 of the decimal id, bit by bit: a number from 256 on brings in a byte, a zero shifts.
    list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [256 + ascii(c), 0, 0, 0, 0, 0, 0, 0, 0]))::BIGINT[],
      lambda r, x: CASE WHEN x > 255 THEN xor(r, x - 256) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END,
      4294967295::BIGINT) % 2 = 1 AS tampered
  FROM documents
), e AS (
  SELECT *, concat(CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id END,
      CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END,
      CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END,
      CASE WHEN n_chars IS NULL THEN '-' ELSE octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars END) AS head,
    replace(text, chr(10), '') AS without_lines
  FROM d
), f AS (
  SELECT row_number() OVER () AS row_id, doc_id, source,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
    CASE WHEN tampered THEN sha256(head || CASE WHEN text IS NULL THEN '-'
      ELSE octet_length(encode(without_lines)) || ':' || without_lines END) END AS other
  FROM e
), leaves AS (
  SELECT *, coalesce(other, leaf) AS start, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, row_id) - 1 AS i,
    count(*) OVER (PARTITION BY source) AS n FROM f
), inner_tree AS (
  SELECT source, 0 AS lvl, i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM inner_tree WHERE n > 1 GROUP BY source, lvl, i // 3, n
), subroots AS (
  SELECT source, h AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM inner_tree WHERE n = 1
), outer_tree AS (
  SELECT 0 AS lvl, i, n, subroot AS h FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM outer_tree WHERE n > 1 GROUP BY lvl, i // 3, n
), nodes AS (
  SELECT source, lvl, i, h, false AS upper FROM inner_tree UNION ALL SELECT NULL, lvl, i, h, true FROM outer_tree
), climb AS (
  SELECT l.row_id, l.doc_id, l.leaf, l.start AS folded, '' AS proof, l.i, l.n, false AS upper, l.source, 0 AS lvl, s.subroot, s.i AS si, s.n AS sn
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT row_id, doc_id, leaf,
    CASE WHEN n > 1 THEN sha256(a || folded || b) ELSE folded END, CASE WHEN n > 1 THEN proof || a || b ELSE proof END,
    CASE WHEN n > 1 THEN i // 3 ELSE si END, CASE WHEN n > 1 THEN (n + 2) // 3 ELSE sn END, n = 1 OR upper, source,
    CASE WHEN n > 1 THEN lvl + 1 ELSE 0 END, subroot, si, sn
  FROM (
    SELECT c.*,
      coalesce((SELECT string_agg(t.h, '' ORDER BY t.i) FROM nodes t
        WHERE t.upper = c.upper AND (c.upper OR t.source IS NOT DISTINCT FROM c.source) AND t.lvl = c.lvl AND t.i // 3 = c.i // 3 AND t.i < c.i), '') AS a,
      coalesce((SELECT string_agg(t.h, '' ORDER BY t.i) FROM nodes t
        WHERE t.upper = c.upper AND (c.upper OR t.source IS NOT DISTINCT FROM c.source) AND t.lvl = c.lvl AND t.i // 3 = c.i // 3 AND t.i > c.i), '') AS b
    FROM climb c WHERE NOT (c.upper AND c.n = 1)
  )
)
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM climb, (SELECT h FROM outer_tree WHERE n = 1) r WHERE upper AND climb.n = 1
""")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an id come first in their source and are left as they are, since there is no number to divide."""
    documents = table(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = merkle.leaf_hash(*head, F.translate("text", "\n", ""))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, changed)
    rows = merkle.merkle_manifest(
        documents, "doc_id", "source", merkle.leaf_hash(*head, F.col("text")), Scratch(spark, "op13"), {"tampered": tampered}).rows
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op11_collocations", r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece
), f AS (
  SELECT lang, w, len(w) AS m, count(*) AS f FROM (
    SELECT lang, w[i:i + m - 1] AS w FROM (
      SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS m)))
  GROUP BY lang, w
), n AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (SELECT lang, w, m, f AS a FROM f WHERE m > 1 AND f >= 30
), cut AS (
  SELECT c.lang, c.w, c.a, k, x.f AS l, y.f AS r, 2000000 * c.a::HUGEINT // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN f x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN f y ON y.lang = c.lang AND y.w = c.w[c.k + 1:c.m]
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), inside AS (
  SELECT lang, w[i:i + k - 1] AS w, max(a) AS longest FROM (
    SELECT lang, w, a, k, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM c))
  GROUP BY ALL
), ranked AS (
  SELECT b.*, array_to_string(b.w, ' ') AS phrase FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.w = b.w
  WHERE longest IS NULL OR 100 * longest::HUGEINT < 80 * a::HUGEINT
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INTEGER AS rank FROM ranked) JOIN n USING (lang)
WHERE rank <= 2000
""")
def frequent_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


@query("op12_decontaminate", r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(len(w), 10) AS k FROM b WHERE len(w) > 0))
), runs AS (
  SELECT row_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win))
), hit AS (SELECT row_id, i, k, item_id FROM runs JOIN win USING (k, run)
), words AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM (SELECT row_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY row_id
), items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row_id, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row_id) LEFT JOIN items USING (row_id)
""")
def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op12"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
