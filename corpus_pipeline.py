"""The corpus pipeline: five stages from ``documents`` to encoded text.

Toxic documents go, repeated lines go from the texts, one document of each
group of near copies stays, sources are mixed to target weights, and what is
left is encoded.  Each stage takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of ``documents``.  Every stage
decides on all rows that its predecessor kept, null and empty texts included,
as the docstrings of the operators say.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, line_dedup, minhash_dedup, mixing, toxicity
from tidemark.llm.common import cut, table
from tidemark.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHARE = 0.9  # of the tokens that the mixing stage keeps


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic text; the grades are learnt from ``labels`` and the documents given.

    Null and empty texts have no telling words and stay, rows with a null id
    are graded and never learnt from, repeated rows are graded each, very long
    texts are read whole; other columns are dropped; without labels or
    documents nothing is toxic.
    """
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.drop_toxic(docs.select(*COLUMNS), model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of 40 or more characters that 5 or more documents hold (the largest id keeps them).

    A null text becomes an empty one, and ``n_chars`` counts what is left; rows
    that repeat an id are one document and all keep the line if that id is the
    largest; rows with a null id stay; very long texts stream line by line;
    other columns are dropped; an empty table stays empty.
    """
    kept = line_dedup.drop_repeated_lines(docs.select(*COLUMNS), min_chars=40, min_docs=5)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a similarity of 0.8 on shingles of five words.

    Texts without words and rows with a null id stay; rows that repeat a kept
    id all stay; a group may have any size; very long texts are hashed whole;
    other columns are dropped; an empty table stays empty.
    """
    return minhash_dedup.drop_near_copies(docs.select(*COLUMNS), width=5)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen so that the sources get tokens by their target weights, each document once at most.

    Null languages and sources are leaves of their own, null and empty texts
    count as one token, equal rows stay together (as soon as one is chosen),
    ties go by id and hash, very long texts are counted whole; other columns
    are dropped; an empty table stays empty.
    """
    return mixing.keep_mixed(docs.select(*COLUMNS), mixing.default_weights(docs), SHARE)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document left.

    Null and empty texts have no tokens, null ids stay null, repeated rows are
    encoded each, very long texts whole; an empty table gives no rows.
    """
    return bpe.encode_digests(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("minhash_near_dedup", near_copy_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

# The grades and the encoding have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what passes between two of them is written to the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
    return docs
