"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (best_fit_packing, divergence_audit, extendible_dedup, hilbert_ann,
                           importance_lines, jaccard_join, language_centroid, mixing,
                           pii_boost, pseudo_likelihood, secret_ledger, simhash_trie, url_templates)
from clientele.llm.common import prepare, table
from clientele.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(name: str):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return run
    return register


@_query("op1_url_templates")
def op1(spark, sf_dir):
    """Host, path, rule and verdict of every page url."""
    return url_templates.judge(table(spark, sf_dir, "pages"))


@_query("op7_secret_ledger")
def op7(spark, sf_dir):
    """Secrets in every document, out of a ledger of its own: every blob is
    scanned once, and all rows come from what the ledger keeps."""
    history = secret_ledger.versions(table(spark, sf_dir, "documents"))
    ledger = secret_ledger.Ledger(spark, f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}")
    ledger.update(history)
    return secret_ledger.digest(secret_ledger.findings(history, ledger.findings()))


@_query("op8_exact_dedup")
def op8(spark, sf_dir):
    """The row that stays for every document's normalised text."""
    return extendible_dedup.dedup(table(spark, sf_dir, "documents")).drop("bucket", "chain")


@_query("op9_mixing")
def op9(spark, sf_dir):
    """Words that the mix takes of every document."""
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.transform("passes", lambda p: p["shard"]).alias("shards"))


@_query("op3_language_centroid")
def op3(spark, sf_dir):
    """Language of every document."""
    return language_centroid.language_id(table(spark, sf_dir, "documents"))


@_query("op5_best_fit_packing")
def op5(spark, sf_dir):
    """Every document's pieces and their place in sequences of 2048 tokens."""
    return best_fit_packing.pack(table(spark, sf_dir, "documents"))


@_query("op2_pii_boost")
def op2(spark, sf_dir):
    """Personal data in every document."""
    return pii_boost.personal_data(table(spark, sf_dir, "documents"))


@_query("op10_pseudo_likelihood")
def op10(spark, sf_dir):
    """Masked pseudo-likelihood of every document."""
    return pseudo_likelihood.score_documents(table(spark, sf_dir, "documents"))


@_query("op6_hilbert_ann")
def op6(spark, sf_dir):
    """The 20 nearest found of every query vector."""
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"))


@_query("op4_jaccard_join")
def op4(spark, sf_dir):
    """Set size and component of every document under Jaccard >= 0.8."""
    return jaccard_join.cluster(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op11_importance_lines")
def op11(spark, sf_dir):
    """Weight and draw of every document towards the benchmark's texts."""
    return importance_lines.resample(table(spark, sf_dir, "documents"), _benchmark(spark, sf_dir))


def _benchmark(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("long").alias("doc_id"), "text")


@_query("op12_divergence_audit")
def op12(spark, sf_dir):
    """Divergence of every source from the others of its language, and its terms."""
    return divergence_audit.audit(table(spark, sf_dir, "documents"))


@_query("op13_simhash_trie")
def op13(spark, sf_dir):
    """Fingerprint and component of every document at 3 or fewer differing bits."""
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


# DuckDB SQL of the queries that SQL can express over whole tables.
ORACLE: dict[str, str] = {
    "op8_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
                   FROM documents),
             g AS (SELECT norm, count(*) AS group_size, (list(doc_id ORDER BY n DESC, doc_id))[1] AS keep_id
                   FROM d GROUP BY norm)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(norm) AS text_sha256
        FROM d JOIN g USING (norm)""",
    "op4_jaccard_join": r"""
        WITH RECURSIVE
        w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                     lambda x: x <> '') AS ws
              FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN []
                     WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(ws) - 3),
                                                       lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
              FROM w),
        t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS tok FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
              FROM t a JOIN t b ON a.tok = b.tok AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT doc_id AS doc, doc_id AS reach FROM documents
              UNION SELECT r.doc, e.b FROM r JOIN e ON r.reach = e.a)
        SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, m.component_id
        FROM s JOIN (SELECT doc, min(reach) AS component_id FROM r GROUP BY doc) m ON m.doc = s.doc_id""",
    "op12_divergence_audit": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
                   FROM documents),
        t AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
        k AS (SELECT lang, term FROM (SELECT DISTINCT row, lang, term FROM t) GROUP BY ALL HAVING count(*) >= 10),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY lang),
        n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                     (1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 2) // (coalesce(n.n, 0) + 2 * v.v))::BIGINT AS p
              FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n USING (lang, source)
              LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        q AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(c) + 2) // (any_value(s.n) + 2 * any_value(v.v)))::BIGINT AS q
              FROM c JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS n FROM n GROUP BY lang) s USING (lang) GROUP BY lang, term),
        pv AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
               FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pv.value, 0) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
        terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
                  FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
        r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
              FROM pairs
              UNION ALL
              SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)
              FROM terms)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
        FROM r WHERE part = 'pair' OR rank <= 10""",
}
