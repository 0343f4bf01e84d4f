"""A pipeline from raw documents to token ids: language, near copies, personal data, mix, tokens.

Every stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but
the last return the columns of ``docs``.  ``run`` applies them to the documents table, each
stage's result written as Parquet in the shared folder and read again.

Columns beyond doc_id, text, lang, source and n_chars, whatever their names, are carried along.
A null text is kept until the mix, which takes no words of it; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import bpe_tree, crf_language, mixing, pii_bootstrap, trie_join
from daypanel.llm.common import WORD, marked, materialise, table, word_count
from daypanel.llm.queries import tokenizer_path
from daypanel.session import shared_dir

CORE = ["doc_id", "text", "lang", "source", "n_chars"]

#: Not expressible in SQL (trained models, tokenizer); tests compare with a plain version.
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """The core columns, and all others as one struct, so that no name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in CORE]
    return docs.select(*CORE, (F.struct(*rest) if rest else F.struct(F.lit(True).alias("none"))).alias("_rest"))


def _unpacked(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) if c in CORE else F.col("_rest").getField(c).alias(c) for c in like.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.0) -> DataFrame:
    """Keep documents with a language, and note the language that most of their words have.

    A document that is ``und`` (no letter) goes, and so does one whose language has a smaller
    share of it than ``least``; by default text in several languages stays.  The model learns
    from the given languages of all documents that have one.
    """
    model = crf_language.fit(docs)
    kept = crf_language.predict(_packed(docs), model, [*CORE, "_rest"]).filter(
        (F.col("lang_pred") != crf_language.UNKNOWN) & (F.col("score") >= least))
    return _unpacked(kept.withColumn("lang", F.col("lang_pred")), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the one with the smallest id, of each class of near copies.

    Classes come from sets of five-word shingles with a Jaccard similarity of 0.8 or more.
    Repeated rows are copies; documents without words stay, one of each id.
    """
    keyed = _packed(docs).withColumn("_key", pii_bootstrap.row_key(F.col("doc_id"), F.coalesce("text", F.lit(""))))
    classes = trie_join.classes(keyed.select(F.struct("doc_id", "_key").alias("row"), "text"), id_col="row", n=5, num=80, den=100)
    # rows of a key that stands alone and first in its class stay as they are, the others meet by key
    others = materialise(classes.groupBy(F.col("row._key").alias("_key"))
                         .agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("component_id._key") == F.col("row._key")).alias("first"))
                         .filter("n > 1 OR NOT first").select("_key", "first"))
    seen = marked(keyed, "_key", others.select("_key"), "_meet")
    met = (seen.filter("_meet").join(others.filter("NOT first").select("_key"), "_key", "left_anti")
           .dropDuplicates(["_key"]))
    kept = seen.filter("NOT _meet").unionByName(met)
    return _unpacked(kept, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; every document stays."""
    clean = pii_bootstrap.mask(_packed(docs))
    return _unpacked(clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and parts of documents that the mix of sources takes, a row for every time."""
    mixed = mixing.mix(_packed(docs), size=word_count(F.col("text")))
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("z")), F.col("passes").cast("int"))
    ranges = F.array(F.struct(F.col("from1").alias("a"), F.col("to1").alias("z")),
                     F.struct(F.col("from2").alias("a"), F.col("to2").alias("z")))
    taken = mixed.withColumn("_part", F.explode(F.filter(F.concat(whole, ranges), lambda r: r["z"] > r["a"])))
    a, z = F.col("_part.a").cast("int"), F.col("_part.z").cast("int")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    part = F.regexp_replace(F.array_join(F.slice(words, a + 1, z - a), ""), r"^[\x20\x09-\x0D]+", "")
    cut = taken.withColumn("text", F.when((a == 0) & (z == F.col("size")), F.col("text")).otherwise(part))
    return _unpacked(cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row; the decoded text is kept as its hash."""
    rows = docs.select("doc_id", "lang", "source", "text")
    return bpe_tree.encode_decode(rows, "text", tokenizer_path(), ["doc_id", "lang", "source"], want_ids=True, want_text=False)


STAGES = [("language_id", language), ("ngram_jaccard_join", near_copies), ("pii", personal_data),
          ("mixing", mixture), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
