"""The corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns the columns of ``documents``, but for the last, which returns each
row's shard.  ``run`` writes every stage's rows as Parquet in the shared folder
and reads them again, so a lost executor costs one stage at most.

Cases, for every stage: a null or empty text is a row like any other (not
toxic, no item in it; all empty texts are near copies of one another); rows are
judged one by one, so null and shared doc_ids do no harm; of equal rows one
stays; very long texts are read whole; where rows tie, doc_id and then the
text's hash decide; columns besides those of ``documents`` are left behind, and
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spotgrain.llm.common import materialize, table
from spotgrain.llm.decontaminate import decontaminate
from spotgrain.llm.mixing import mix
from spotgrain.llm.sharding import shard_result
from spotgrain.llm.simhash import near_dedup
from spotgrain.llm.toxicity import toxicity_score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the model calls toxic go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(spark, model)(F.col("text")) < 0.5).select(*COLUMNS)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word Jaccard of 0.8 and more) the first row stays."""
    return near_dedup(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a benchmark item, or a long passage of one, go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their tempered weights: rows of small ones come again."""
    return mix(docs, columns=COLUMNS, slots=False).select(*COLUMNS)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_result(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash", simhash),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The model, fingerprints and alignments have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
