"""A training corpus from documents in five stages; each reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import decontam, langid, neardup, pieces, pii
from blockloom.llm.common import ship, staged, table
from blockloom.llm.queries import SURROGATE_KEY, tokenizer_file


def _apart(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with all columns but doc_id and text under names that no operator uses, and these names in order."""
    names = [c if c in ("doc_id", "text") else f"__{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters stay; lang becomes the predicted language. Learns from the labelled documents.

    With no labelled document nothing is learned: the documents stay all the same, with the language `und`.
    """
    ship(spark)
    columns, trees = docs.columns, langid.train(docs)
    named, names = _apart(docs.where(F.col("text").rlike(r"\p{L}")))
    found = langid.predict(named, trees, names)
    return found.select(*[F.col("lang_pred" if c == "lang" else n).alias(c) for c, n in zip(columns, names, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the document with the least doc_id stays.

    Each row is decided by itself, also where rows repeat a doc_id: of several with the least one any one stays. Rows
    with a null doc_id are linked with nothing and stay.
    """
    ship(spark)
    # numbered once and written, so that a row has the same number wherever it is read
    rows = staged(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    named = rows.where("doc_id is not null")
    groups = neardup.near_duplicates(named.select("__row", "text"), k=5, percent=80, key="__row").select("__row", "component_id")
    least = groups.join(named.select("__row", "doc_id"), "__row").groupBy("component_id").agg(F.min(F.struct("doc_id", "__row")).alias("first"))
    kept = rows.join(least.select(F.col("first.__row").alias("__row")), "__row", "left_semi")
    return kept.unionByName(rows.where("doc_id is null")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule doesn't hold for stay: those without words too, rows with a null key, and each of
    rows that repeat. With no items, or no documents, the table stays as it is. Columns may have any names.
    """
    named, names = _apart(docs)
    found = decontam.contamination(named, table(spark, sf_dir, "benchmark"), keep=[n for n in names if n != "doc_id"])
    return found.where(~F.col("contaminated")).select(*names).toDF(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced; n_chars follows the text, null with a null one.

    All rows stay, in any order, whatever their keys; a text without entities stays as it is, an empty table empty.
    """
    named, names = _apart(docs)
    done = pii.replace_entities(named, SURROGATE_KEY)
    return done.select(*[(F.length("text").cast("long") if c == "n_chars" else F.col(n)).alias(c) for c, n in zip(docs.columns, names, strict=True)])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text: counts, scores of the best segmentations, checksum of the ids and the round trip.

    One row for each row: null and empty texts have no pieces, keys may be null or repeat; an empty table gives no rows.
    """
    ship(spark)
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("language ID", language), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontaminate), ("PII", private), ("SentencePiece", encode)]

#: SQL can't express the language model, the surrogates and the piece lattice; tests hold its operators against brute force, a round trip or held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{i}")
    return docs
