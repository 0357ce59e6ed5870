"""From raw documents to packed sequences: five stages, each written and read again.

language ID -> SimHash near-duplicates -> secret scans -> mixing -> packing
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanelux.llm import langid, langtrain, mixing, packing, secrets, simhash
from lanelux.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text is rejected if no language has this share of its words' probability.
LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with ``LEAST_SCORE`` or more; ``lang`` is filled where it is null.

    The score is a share among the learned languages, so a text that fits none of them goes by a measure of
    its own (its limit is set by ``langtrain.fit_all``). Learned from all documents that have a label, whole texts. Null, empty and letterless texts go. Without any label
    no language is known, so the stage decides nothing and keeps what has a letter.
    """
    docs = docs.select(*COLUMNS)
    model = langtrain.fit_all(docs, calibrated=True)
    if model is None:
        return docs.where(F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)))
    rows = langid.predict(docs, model)
    known = rows.where((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_lang_score") >= LEAST_SCORE) & F.col("_lang_fits"))
    return known.withColumn("lang", F.coalesce("lang", "_lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Rows that share that id and its fingerprint stay one row, the smallest text. Of a group of null
    ids alone, one row stays.
    """
    docs = docs.select(*COLUMNS)
    kept = simhash.kept(docs)
    return kept.select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in them replaced by a mark."""
    return secrets.redact(docs.select(*COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs, mixing.plan_mix(docs, refill=True))
    copies = F.sequence(F.lit(1), F.col("_mix.copies").cast("int"))
    return mixed.where(F.col("_mix.copies") > 0).withColumn("_copy", F.explode(copies)).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    return packing.pack(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing", source_mix),
    ("packing", packed),
]

#: The first stage is a trained model, so no SQL gives the rows; tests hold them against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what each keeps is stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
