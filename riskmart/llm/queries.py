"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmart.llm import (bpe, decontaminate, html_extract, iblt, importance, jaccard_join, ordinal, packing, ring, runs,
                          suffix_dedup, suffix_tree, toxicity)
from riskmart.llm.common import prepared

QUERIES = {}


def query(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(prepared(spark), sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark, sf_dir):
    """Toxicity score per document; the lexicon is learnt outside the held-out fourth."""
    docs = table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, false) held_out"
    return toxicity.score(docs, lexicon, keep=["doc_id"]).selectExpr("doc_id", held_out, "score", "predicted", "n_matches")


@query
def op2_fingerprints(spark, sf_dir):
    """Sketches of each document, of its edited text and of the next document, and their likeness."""
    return iblt.edited_versions(table(spark, sf_dir, "documents"))


@query
def op3_quality_grades(spark, sf_dir):
    """Expected grade and tail probabilities per document."""
    docs = table(spark, sf_dir, "documents")
    model = ordinal.fit(docs, ordinal.graded(table(spark, sf_dir, "labels")))
    return ordinal.grade(docs, model, keep=["doc_id"]).selectExpr(
        "doc_id", "expected_grade", "tails[0] p_at_least_1", "tails[1] p_at_least_2", "selected")


@query
def op4_ring_sharding(spark, sf_dir):
    """All documents on 24 shards by the law `rows`."""
    return ring.shard(table(spark, sf_dir, "documents"), 24)


@query
def op5_suffix_dedup(spark, sf_dir):
    """Bytes under 50-byte strings that a smaller document has, removed."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op6_main_text(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    found = html_extract.extract(pages, html_extract.fit(pages), keep=["page_id", "url"])
    return found.select("page_id", "url", "text", "n_chars")


@query
def op7_decontamination(spark, sf_dir):
    """Words of each document inside benchmark windows, and the items they come from."""
    found = decontaminate.marks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        F.expr(f"({decontaminate.contaminated()})").alias("contaminated"))


@query
def op8_jaccard_join(spark, sf_dir):
    """Components of documents whose 5-word shingles are 0.75 alike."""
    return jaccard_join.labelled(table(spark, sf_dir, "documents"))


@query
def op9_suffix_tree(spark, sf_dir):
    """Words under 13-word windows that a smaller document has, removed."""
    return suffix_tree.digests(table(spark, sf_dir, "documents"))


@query
def op10_byte_bpe(spark, sf_dir):
    """Token counts and digests of ids and decoded bytes, per document."""
    import public_tokenizers

    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                              public_tokenizers.PATTERN)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """In one document of ten (by the checksum of its id) the words from some place on repeat with some period."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    return np.r_[0:a, a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))]


@query
def op11_periodic_runs(spark, sf_dir):
    """Runs of words that repeat four times or more, and each document without the repeats."""
    return runs.digests(table(spark, sf_dir, "documents"), edit=planted)


@query
def op12_importance(spark, sf_dir):
    """Documents drawn by how much likelier the benchmark has their words, with Gumbel noise."""
    found = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_packing(spark, sf_dir):
    """All documents as pieces in sequences of 4096 tokens."""
    import public_tokenizers

    return packing.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
