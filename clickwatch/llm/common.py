"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixed by the contract of the text operators: a word is a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
#: rows of these remainders of crc32(doc_id as text) mod 4 may be learnt from, HELD_OUT may not
FOLDS, HELD_OUT = 4, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for documents kept for testing; a null id counts as the empty text, whose fold is 0."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not use yet, in any case."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def text_key(text: Column) -> Column:
    """A 128-bit text fingerprint as text, for telling rows of one id apart; null stays null."""
    return F.md5(text.cast("binary"))
