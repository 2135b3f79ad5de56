"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rtdw.llm import (
    blob_ledger,
    bpe,
    decision_list,
    disclosure,
    divergence,
    html_text,
    langid,
    packing,
    repeats,
    simhash,
    toxicity,
    vector_codes,
    vectors,
)
from rtdw.llm.oracles import ORACLES  # noqa: F401
from rtdw.session import run_dir

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(spark: SparkSession) -> bpe.Vocabulary:
    return bpe.Vocabulary(spark, public_tokenizers.path(TOKENIZER))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(spark), with_ids=False)


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.disclosure_table(table(spark, sf_dir, "documents"))


def op4_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blob_ledger.secrets_table(table(spark, sf_dir, "documents"), run_dir(spark, "blob-ledger"), first_time=True)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_table(table(spark, sf_dir, "documents"))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what the operator's encoder and decoder give, made where they run: ids stay with the workers."""
    words = vocabulary(spark)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = words.load(), words.load(bpe.Decoder)
        for texts in batches:
            rows = []
            for text in texts:
                ids = encoder.encode(text)
                plain = decoder.decode(ids).encode()
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(plain).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    digests = F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return table(spark, sf_dir, "documents").select("doc_id", digests("text").alias("d")).select("doc_id", "d.*")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(table(spark, sf_dir, "documents"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.pages_table(table(spark, sf_dir, "pages"))


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vectors_table(table(spark, sf_dir, "embeddings"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_table(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes_table(table(spark, sf_dir, "embeddings"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_table(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_packing,
        op3_disclosure,
        op4_blob_ledger,
        op5_simhash,
        op6_decision_list,
        op7_bpe,
        op8_language,
        op9_main_text,
        op10_vectors,
        op11_divergence,
        op12_vector_codes,
        op13_repeats,
    )
}
