"""Corpus pipeline: stages applied one after the other to ``documents``; each result is written as Parquet and
read again as the next stage's input. Every stage works on all rows that the one before has kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fernwick.llm.common import store
from fernwick.llm.importance import resample
from fernwick.llm.ngram_join import ngram_classes
from fernwick.llm.packing import pack_by_length, token_lengths
from fernwick.llm.queries import vocabulary
from fernwick.llm.toxicity import fit_noisy_or, score_toxicity
from fernwick.session import load_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Rows of one Arrow batch: texts are long, and a batch exists several times on its way to Python and back.
BATCH_ROWS = 1_000


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and ``row``, the place of the row in the stored table: its file and its number there. It
    tells rows apart whatever their ids are, and stays the same when a task runs again or splits change."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    try:
        place = docs.select(*COLUMNS, "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:  # no stored table yet
        return _keyed(store(docs.select(*COLUMNS), "documents"))
    return place.select(*COLUMNS, F.struct(F.xxhash64("file_path").alias("file"), F.col("row_index").alias("number")).alias("row"))


def _drop(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the rows of these places."""
    return docs.join(rows.select("row"), "row", "left_anti").select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose toxicity is 0.5 or more. Each row is judged by its text: null ids and repeated ids do not matter."""
    docs = _keyed(docs)
    model = fit_noisy_or(docs, load_table(spark, sf_dir, "labels"), "toxic", held_out=5)
    return _drop(docs, score_toxicity(docs, model, id_col="row").filter("score >= 0.5"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that importance resampling towards the texts labelled good does not draw. Rows are drawn one by one."""
    docs = _keyed(docs)
    return _drop(docs, resample(docs, load_table(spark, sf_dir, "labels"), "quality", row_key="row").filter("not kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id (null after all others), of these the
    first of the stored table. Rows without words are no copies and stay."""
    docs = _keyed(docs)
    marked = store(ngram_classes(docs, size=5, threshold=(80, 100), row_key="row").filter("component is not null"), "marked")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row.file", "row.number")
    first = marked.groupBy("component").agg(F.min_by("row", order).alias("row"))
    return _drop(docs, marked.select("row").join(first.select("row"), "row", "left_anti"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in batches of a token budget, by length buckets of least padding. Null texts have length 0; each
    row is packed on its own."""
    return pack_by_length(token_lengths(docs, vocabulary("byte_bpe_50k.json")), buckets=16, budget=65_536)


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates), ("packing", packing)]

# The stages learn from labels and settle links by iteration, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. An empty table gives an empty result."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
