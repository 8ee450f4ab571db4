"""From raw documents to token ids: quality, near-duplicates, secrets, mix, tokens.

Each stage takes what the one before it kept, from the table that was written of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import bpe, minhash_dedup, quality_cnn, secret_scan, simhash_dedup, source_mix
from ledgerspark.session import stored, table

#: Words of a shingle in the near-duplicate stage.
WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; trained from the labels of ``sf_dir``.

    Null and empty texts have a score like any other. Other columns stay as they are.
    """
    return quality_cnn.kept(docs, quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id: texts reachable over pairs
    whose five-word shingles have a Jaccard similarity of 0.8 or more.

    SimHash fingerprints within four bits, found by vantage-point trees, propose pairs, and so do lists of MinHash
    coordinates, as most such texts differ in more bits; the whole sets of shingles confirm a pair. Texts without words
    are one group. Rows with a null id stay only where no row with an id shares their group.
    """
    return minhash_dedup.one_of_each(docs, words=WORDS, propose=simhash_dedup.proposed_pairs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with confirmed secrets masked; ``n_chars`` follows where a text has a mask.

    Repeated rows are masked alike, null and empty texts stay as they are, an empty table gives no rows; a text of any
    length is scanned whole.
    """
    masked = secret_scan.masked(docs, secret_scan.fitted(docs))
    if "n_chars" not in docs.columns:
        return masked
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.coalesce(F.col("text").contains(secret_scan.MASK), F.lit(False))
    return masked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the sources' target weights takes them, up to three times.

    Documents without words, null texts included, are in no mix; a null source is a source of its own. Repeated rows share
    what they take together, a text of any length is taken whole, an empty table gives no rows.
    """
    return source_mix.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text, and the ids, for every row of the mix.

    A null or empty text has no tokens and the digests of nothing; repeated rows stay; an empty table gives no rows.
    """
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# no SQL has a trained network, a forest or a vocabulary: tests/llm checks the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
