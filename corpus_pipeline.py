"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage takes the session, the documents that the stage before it kept, and the folder of the tables. All but the
last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import language_id, line_dedup, mixing, packing, queries, simhash
from tallyhouse.llm.common import free_name, read_table
from tallyhouse.session import written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in learned languages, one or several. The model is learned from the labelled ones that are not held out.

    A null or empty text, or one without a letter, is in no language and goes. Rows are judged by their text alone, so repeated ones
    stay or go alike. Rows without an id are not held out. An empty table gives an empty one. All columns stay, whatever their names.
    """
    model = language_id.learn(docs.where(f"not coalesce({queries.HELD_OUT}, false)"))
    found = free_name(docs, "found")
    judged = docs.withColumn(found, language_id.predict(model)(F.col("text")))
    return judged.where(F.col(f"{found}.learned")).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; ``n_chars`` follows the text.

    No document goes: null and empty texts stay as they are, and rows without an id lose nothing. Rows with one id count as one document.
    A shared line stays in the document with the largest id. An empty table gives an empty one. All columns stay, whatever their names.
    """
    kept = line_dedup.dedup_lines(docs, least=20, min_docs=3)
    if "n_chars" in docs.columns:
        changed = kept[line_dedup.added_names(docs)[1]] > 0
        kept = kept.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the smallest id; of rows with one id that with the smallest hash of the whole row.

    Rows with one id and different texts are documents of their own. Rows without an id are grouped with the others, and one
    of them stays in each group beside the one with an id, as nothing can name it. Rows equal in all columns are one.
    """
    row = free_name(docs, "row__")
    # A null leaves the hash as it is, so whether a column is null is hashed too.
    keyed = docs.withColumn(row, F.xxhash64(*[part for c in docs.columns for part in (docs[c], docs[c].isNull())]))
    groups = simhash.near_duplicates(keyed, shingle=3, distance=3, doc_id=row).select(F.col("doc_id").alias("of__"), "component_id").distinct()
    named = keyed.select(F.col(row).alias("row__"), F.col("doc_id").cast("long").alias("id__")).distinct()
    first = groups.join(named, F.col("of__") == F.col("row__")).groupBy("component_id", F.col("id__").isNull().alias("unnamed__"))
    heads = written(first.agg(F.min(F.struct("id__", "row__")).alias("first__")).select(F.col("first__.row__").alias("head__")), "heads")
    return keyed.join(heads, keyed[row] == heads["head__"], "left_semi").dropDuplicates([row]).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources call for.

    A null or empty text has no words and is taken at its source's rate; a source without words is not taken at all. Null is a source of
    its own, named last. Rows alike in id are taken alike, rows without an id by their text. An empty table gives an empty one.
    All columns stay, whatever their names.
    """
    mixed, new = mixing.mix_sources(docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_CAP)
    return mixing.emit_copies(mixed, new["copies"], docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.

    A null or empty text is one piece with the closing id alone; a text longer than a window is cut into full windows and a rest. Each copy
    of a repeated row is packed. An empty table gives no pieces. Of the documents only the id and the text are read.
    """
    return packing.pack_documents(docs, window=2048, with_ids=False)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL cannot express the language stage; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
