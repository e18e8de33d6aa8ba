"""The corpus pipeline: filter, deduplicate, decontaminate and mix the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to
the shared checkpoint folder and reads it back as the next stage's documents.  All stages but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baton.llm import toxicity
from baton.llm.decontaminate import decontaminate
from baton.llm.jaccard_join import keep_representatives
from baton.llm.mixing import mix_sources
from baton.llm.suffix_array_dedup import dedup_bytes
from baton.llm.wire import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not more likely toxic than not (operator 7)."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), toxicity.severity_grade(), keep_toxic=True)
    return toxicity.severity(docs, model, keep=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 (operator 10)."""
    return keep_representatives(docs, shingle=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that an earlier document holds (operator 4).

    All documents stay, also those that become empty; ``n_chars`` follows the text.
    """
    cut = dedup_bytes(docs, with_text=True)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cols = {c: F.col(f"rest.c{i}") for i, c in enumerate(others)} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in cols:
        cols["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[cols[c].alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (operator 9)."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often (operator 8).

    ``copies`` whole copies, ``taken`` words in all, of ``size`` words; rows that share an id
    share their sums.  A new column whose name the documents have already is called ``mix_...``.
    """
    plan = mix_sources(docs).groupBy("doc_id").agg(F.max("size").alias("size"), F.first("target").alias("target"), F.sum("taken").alias("taken"), F.sum("copies").alias("copies"))
    new = [F.col(c).alias(f"mix_{c}" if c in docs.columns else c) for c in plan.columns[1:]]
    plan = plan.where("taken > 0").select(F.col("doc_id").alias("__mixed"), *new)
    return docs.join(plan, docs["doc_id"].eqNullSafe(plan["__mixed"])).drop("__mixed")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix),
]

#: SQL cannot express the classifier or the mix; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
