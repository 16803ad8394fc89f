"""Queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import bpe, jaccard, kdtree, langid, nndescent, packing, phrases, quality, rtree, secrets, sharding, signs, surrogates
from riskloom.session import prepare

Job = Callable[[SparkSession, str], DataFrame]

_JOBS = {
    "op1_best_fit_packing": packing.query,
    "op2_kdtree_topk": kdtree.query,
    "op3_byte_bpe": bpe.query,
    "op4_secret_scan": secrets.query,
    "op5_surrogates": surrogates.query,
    "op6_histogram_sharding": sharding.query,
    "op7_importance_resampling": quality.query,
    "op8_nn_descent": nndescent.query,
    "op9_jaccard_join": jaccard.query,
    "op10_language_id": langid.query,
    "op11_rtree_negatives": rtree.query,
    "op12_sign_near_dedup": signs.query,
    "op13_phrase_collocations": phrases.query,
}
_SQL: dict[str, str] = {
    "op2_kdtree_topk": kdtree.SQL,
    "op9_jaccard_join": jaccard.SQL,
    "op11_rtree_negatives": rtree.SQL,
    "op12_sign_near_dedup": signs.SQL,
    "op13_phrase_collocations": phrases.SQL,
}


def _prepared(job: Job) -> Job:
    @wraps(job)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(prepare(spark), sf_dir)

    return run


def jobs() -> dict[str, Job]:
    return {name: _prepared(job) for name, job in _JOBS.items()}


def oracles() -> dict[str, str]:
    return dict(_SQL)
