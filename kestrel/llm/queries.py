"""One query per operator over the whole ``documents`` table, and the pipeline."""

from __future__ import annotations

import functools

import corpus_pipeline
from kestrel.llm import (alignment, bpe, decontaminate, langid, neardup, periodic, quality, secrets, sharding, suffixes,
                         syncmers, toxicity, wordtrees)
from kestrel.llm.common import documents
from kestrel.session import ship_package
from kestrel.sources.tables import table


def op1_closed_syncmers(spark, sf_dir):
    return syncmers.query(documents(spark, sf_dir))


def op2_randomness_secrets(spark, sf_dir):
    return secrets.query(documents(spark, sf_dir))


def op3_ftrl_language(spark, sf_dir):
    return langid.query(documents(spark, sf_dir))


def op4_compression_toxicity(spark, sf_dir):
    return toxicity.query(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_weighted_near_duplicates(spark, sf_dir):
    return neardup.query(documents(spark, sf_dir))


def op6_prefix_decontamination(spark, sf_dir):
    return decontaminate.query(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_suffix_repeats(spark, sf_dir):
    return suffixes.query(documents(spark, sf_dir))


def op8_histogram_sort_shards(spark, sf_dir):
    return sharding.query(documents(spark, sf_dir))


def op9_boosted_tree_quality(spark, sf_dir):
    return quality.query(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark, sf_dir):
    return bpe.query(documents(spark, sf_dir))


def op11_recompression_runs(spark, sf_dir):
    return periodic.query(documents(spark, sf_dir))


def op12_tokenizer_alignment(spark, sf_dir):
    return alignment.query(documents(spark, sf_dir))


def op13_prefix_suffix_trees(spark, sf_dir):
    return wordtrees.query(documents(spark, sf_dir))


def _query(run):
    @functools.wraps(run)
    def query(spark, sf_dir):
        ship_package(spark)
        return run(spark, sf_dir)

    return query


def queries() -> dict:
    own = {k: _query(v) for k, v in globals().items() if k.startswith("op")}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    sql = {"op6_prefix_decontamination": decontaminate.SQL}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
