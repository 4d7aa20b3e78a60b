"""One query per operator, over the whole of its table, and SQL where SQL can state the result."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from changeloom.llm.bestfit import op13_best_fit
from changeloom.llm.hamming import OP3_SQL, op3_hamming_topk
from changeloom.llm.hilbert import OP12_SQL, op12_curve_clusters
from changeloom.llm.languages import op4_language_mixture
from changeloom.llm.packing import op7_pack
from changeloom.llm.partcodes import OP11_SQL, op11_part_codes
from changeloom.llm.quality import op2_quality_divergence
from changeloom.llm.repeats import op9_repeats
from changeloom.llm.scoring import op8_attention_scores
from changeloom.llm.secrets import op6_secret_scan
from changeloom.llm.shards import op10_shard
from changeloom.llm.simhash import op5_simhash
from changeloom.llm.tokens import op1_byte_bpe

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it."""
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *filter(None, paths)])


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


OPERATORS = (
    op1_byte_bpe,
    op2_quality_divergence,
    op3_hamming_topk,
    op4_language_mixture,
    op5_simhash,
    op6_secret_scan,
    op7_pack,
    op8_attention_scores,
    op9_repeats,
    op10_shard,
    op11_part_codes,
    op12_curve_clusters,
    op13_best_fit,
)
QUERIES = {query.__name__: _ready(query) for query in OPERATORS}

ORACLE: dict[str, str] = {
    "op3_hamming_topk": OP3_SQL,
    "op11_part_codes": OP11_SQL,
    "op12_curve_clusters": OP12_SQL,
}
