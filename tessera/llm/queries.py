"""The registered queries of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import divergence, editprint, html_text, huffman, mixing, packing, perspectives, pivots, secrets, secrets_sql, simhash, toxicity, url_filter, whitening
from tessera.llm.common import shared_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


@query
def op3_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.near(_read(spark, sf_dir, "documents"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@query
def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"
    huffman.write(_read(spark, sf_dir, "documents"), out)
    return huffman.read(spark, out)


@query
def op9_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.query(_read(spark, sf_dir, "documents"))


ORACLES["op9_curriculum_mix"] = mixing.SQL


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.learn(docs, _read(spark, sf_dir, "labels")))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents"))


ORACLES["op2_secret_scan"] = secrets_sql.SQL


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


@query
def op5_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.top_k(_read(spark, sf_dir, "embeddings"))


ORACLES["op5_pivot_top_k"] = pivots.SQL


@query
def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(_read(spark, sf_dir, "conversations"))


ORACLES["op8_perspectives"] = perspectives.SQL


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.query(_read(spark, sf_dir, "pages"))


ORACLES["op11_url_filter"] = url_filter.SQL


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.query(_read(spark, sf_dir, "documents"))


ORACLES["op13_divergence"] = divergence.SQL
