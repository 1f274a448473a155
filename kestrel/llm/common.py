"""Helpers the text operators share: word splitting, row keys, written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir
from kestrel.sources.tables import table

# Everything of ASCII that is neither a letter nor a digit separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole(text: Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null and empty texts have none."""
    text = whole(text)
    # ``translate`` looks up every character; of an ASCII text, ``lower`` gives the same.
    lower = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(lower, SEPARATORS), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row.

    Catalyst inlines an expression into the lambdas that use it, where it would
    be computed again for every element; a lambda's own variable is not.
    """
    return F.transform(F.array(value), body)[0]


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return (F.crc32(doc_id.cast("string").cast("binary")) % folds).cast("int")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(fold_of(doc_id, folds) == fold, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back.

    Cuts the lineage: tasks that a lost executor takes with it read the files
    again.  The files stay until the checkpoint folder is cleared.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(texts, limit: int):
    """Bounds of consecutive texts that hold about ``limit`` bytes together; a longer text
    is alone."""
    start = size = 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > limit:
            yield start, k
            start, size = k, 0
        size += len(text)
    if len(texts) > start:
        yield start, len(texts)
