"""One thin query per operator over its whole table, and the DuckDB twins of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import common

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


from daypanel.llm import mixing  # noqa: E402


@query("op1_mix_sources", mixing.MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a mix of 150 % of all words takes, by Sainte-Lague block quotas."""
    docs = common.table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", common.word_count(F.col("text")).alias("size"))
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken")


from daypanel.llm import rotated_bits  # noqa: E402


@query("op3_rotated_bits_ann")
def op3_rotated_bits_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all other vectors for every vector whose id is divisible by 20."""
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rotated_bits.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


from daypanel.llm import bpe_tree  # noqa: E402


def tokenizer_path() -> str:
    """The byte-level BPE vocabulary that op8 and the pipeline use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op8_bpe_tree")
def op8_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and hashes of the ids and of the decoded text of every document."""
    return bpe_tree.encode_decode(common.table(spark, sf_dir, "documents"), "text", tokenizer_path(), ["doc_id"])


from daypanel.llm import trie_join  # noqa: E402


@query("op5_trie_jaccard")
def op5_trie_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more."""
    return trie_join.classes(common.table(spark, sf_dir, "documents"), n=3, num=90, den=100)


from daypanel.llm import brown  # noqa: E402


@query("op2_brown_classes")
def op2_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and class-bigram scores of every document, learnt from those whose crc32 mod 7 is not 2."""
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 7) == 2
    model = brown.fit(docs.filter(~held).select("text"))
    return brown.score(docs, model, held)


from daypanel.llm import crf_language  # noqa: E402


@query("op9_crf_language")
def op9_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those whose crc32 mod 3 is not 1."""
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 3) == 1
    crf = crf_language.fit(docs.filter(~held))
    return crf_language.predict(docs.withColumn("held_out", held), crf, ["doc_id", "held_out"])


from daypanel.llm import pii_bootstrap  # noqa: E402


@query("op10_pii_bootstrap")
def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base entities and those found by their context."""
    return pii_bootstrap.digest(pii_bootstrap.find(common.table(spark, sf_dir, "documents")))


from daypanel.llm import imatch  # noqa: E402


@query("op4_imatch")
def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of its edited text, with likenesses."""
    return imatch.compare(common.table(spark, sf_dir, "documents"))


from daypanel.llm import knn_quality  # noqa: E402


@query("op6_knn_quality")
def op6_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by votes of labelled ones whose crc32 mod 5 is not 0."""
    docs = common.table(spark, sf_dir, "documents")
    held = common.remainder("doc_id", 5) == 0
    labels = common.table(spark, sf_dir, "labels").filter(~held).select("doc_id", "quality")
    space = knn_quality.fit(docs.select("doc_id", "text"), labels)
    scored = knn_quality.score(docs.withColumn("held_out", held), space, ["doc_id", "held_out"])
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int"))


from daypanel.llm import license_zstd  # noqa: E402


@query("op7_license_zstd")
def op7_license_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document."""
    return license_zstd.scan(common.table(spark, sf_dir, "documents"), ["doc_id"])


from daypanel.llm import merkle  # noqa: E402


@query("op13_merkle_manifest", merkle.MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proofs of every document, and where proofs of documents with a changed length lead."""
    docs = common.table(spark, sf_dir, "documents")
    changed = F.col("n_chars") + F.when(common.remainder("doc_id", 7) == 0, 1).otherwise(0)
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.col("text")]
    found = merkle.manifest(docs, F.col("lang"), fields, [F.col("doc_id")],
                            {"doc_id": F.col("doc_id"), "tried": merkle.leaf_hash([*fields[:3], changed, fields[4]])})
    return merkle.verify(found, F.col("tried")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


from daypanel.llm import collocations  # noqa: E402


@query("op11_collocations", collocations.COLLOCATIONS_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of every language, of those used 100 times or more."""
    docs = common.table(spark, sf_dir, "documents")
    return collocations.collocations(docs, F.col("lang"), F.col("text"))


from daypanel.llm import dom_trees  # noqa: E402


@query("op12_dom_trees")
def op12_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = common.table(spark, sf_dir, "pages")
    model = dom_trees.fit(pages, F.col("html"), [F.col("page_id"), F.col("url")])
    return dom_trees.extract(pages, model, ["page_id", "url"])
