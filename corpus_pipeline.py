"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, tokens.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all its predecessor
kept; all but the last return the columns of ``documents``.

1. ``language``: documents without letters, or of no language with some confidence, go.
2. ``near_duplicates``: one document of each class stays, the one of the smallest id.
3. ``decontamination``: contaminated documents go.
4. ``secrets``: every document stays, each secret replaced by a mark.
5. ``tokens``: the number of tokens of each document and digests of its ids and of the
   text they decode to.

Null and empty texts leave at the first stage; a null doc_id stays a value like any
other; an empty table passes through all stages; columns beyond those of ``documents``
are carried along until the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.llm import bpe, decontaminate, langid, neardup, secrets
from kestrel.llm.common import documents, written
from kestrel.session import few_rows_at_once, ship_package


def _stage(operator):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        few_rows_at_once(spark)
        return operator(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _stage(langid.stage)),
    ("near_duplicates", _stage(neardup.stage)),
    ("decontamination", _stage(decontaminate.stage)),
    ("secrets", _stage(secrets.stage)),
    ("tokens", _stage(bpe.stage)),
]

#: Trained models and hashes: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
