"""Corpus pipeline: toxic documents go, near duplicates go, repeated passages go, personal data
is replaced, and what remains is packed into training sequences.

Every stage takes ``(spark, docs, sf_dir)``; its rows are written as Parquet and read again as
the ``docs`` of the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.llm import packing, surrogates, toxicity
from hazardlake.llm.common import maybe_in, small_batches, stored
from hazardlake.llm.near_dedup import near_groups
from hazardlake.llm.queries import SURROGATE_KEY, toxicity_model
from hazardlake.llm.span_dedup import without_repeats


def _as_documents(rows: DataFrame, text: str | None = None) -> DataFrame:
    """The columns that ``row`` holds, with another text and its length."""
    names = rows.schema["row"].dataType.fieldNames()
    columns = []
    for name in names:
        if text is not None and name == "text":
            columns.append(F.col(text).alias(name))
        elif text is not None and name == "n_chars":
            kind = rows.schema["row"].dataType[name].dataType
            columns.append(F.length(text).cast(kind).alias(name))
        else:
            columns.append(F.col(f"row.`{name}`").alias(name))
    return rows.select(columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Null and empty texts are scored without evidence and stay; repeated rows are scored each, ties at the
    threshold go. No documents give none, whatever their columns are called.
    """
    small_batches(spark)
    scored = toxicity.score_documents(docs, toxicity_model(spark, sf_dir))
    return _as_documents(scored.filter(F.col("score") < toxicity.THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of least ``doc_id``.

    Null, empty and blank texts are linked with nothing and stay. Rows that repeat a ``doc_id`` and its
    text stay or go together, other rows of that id by their own text; a group without any id stays.
    No documents give none. Columns keep their names and values.
    """
    dropped = near_groups(docs).filter("not kept").select("doc_id", "text_hash").distinct()
    dropped = stored(dropped, "dropped")
    same = docs["doc_id"].eqNullSafe(dropped["doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == dropped["text_hash"])
    some = maybe_in(dropped.select("doc_id"))(docs["doc_id"])
    return docs.filter(~some).unionByName(docs.filter(some).join(dropped, same, "left_anti"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has; those that consist of nothing else go.

    Null and empty texts stay, as do texts shorter than a span. Of equal passages the least ``doc_id``
    has the first, a null id comes last; rows of one id count as one document. No documents give none.
    """
    cut = without_repeats(docs)
    emptied = (F.col("removed") > 0) & (F.trim("kept_text") == "")
    return _as_documents(cut.filter(F.col("kept_text").isNull() | ~emptied), "kept_text")


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data.

    Every row stays. Null stays null, texts without personal data stay as they are, copies are changed
    alike, ``n_chars`` follows the text. No documents give none.
    """
    return _as_documents(surrogates.with_surrogates(docs, SURROGATE_KEY), "masked")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the words of each document stand in the training sequences.

    Null, empty and blank texts take no room and have no row; texts longer than a sequence have several.
    Repeated rows are packed each. No documents give no sequences.
    """
    return packing.packed(docs, packing.word_count(F.col("text")))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: Trained models and keyed hashes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
