"""A training-corpus pipeline over ``documents``: five stages, each written as Parquet and reread by the next.

``STAGES`` holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``. Tables named by ``sf_dir`` besides (labels, benchmark) are read where needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontaminate, jaccard, mixing, token_files, toxicity
from tallyhouse.llm.common import shared_folder, table


def _bound_batches(spark: SparkSession) -> None:
    """Batches to Python workers of about 2 MB for the whole session: the caller writes a stage after it has returned.

    10,000 whole texts, the default, stand in the executor and once more in its worker.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the toxicity model does not reject."""
    _bound_batches(spark)
    names = docs.columns
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    # The text goes to the workers once: the struct keeps the other columns, whatever their names, out of the way.
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names if n != "text"]).alias("_doc"), "text")
    kept = toxicity.score_toxicity(packed, model).where("predicted = 0")
    return kept.select(*["text" if n == "text" else F.col(f"_doc.`{n}`").alias(n) for n in names])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (word 5-grams, similarity 0.8)."""
    _bound_batches(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no or few words of benchmark items."""
    _bound_batches(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as many times as the balanced sample takes them."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mixed corpus, as read back from the files."""
    import public_tokenizers
    path = token_files.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("source", "lang"))
    return token_files.read_tokens(spark, path)


STAGES = [("toxicity", drop_toxic), ("jaccard_join", keep_one_of_each_group), ("decontamination", drop_contaminated),
          ("source_mix", mix_sources), ("token_output", write_token_files)]

#: Training, random draws and tokenization have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{place}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
