"""Distinct counts that roll up: exact bitmaps of ids, united for coarser groups.

Counts of distinct ids can't be added up, sets of ids can be united. A set is kept as one bitmap of 32,768 ids (4 kB)
per group and bucket of ids that occurs. That suits ids that lie dense, as running numbers do; scattered ids take a
bitmap each at worst, so give those running numbers first.

Groups that hold few of the ids that lie side by side, as months and categories of running numbers do, are better kept as
words: a row for 64 ids of which one occurs, its bits in one long. A row is small whatever the ids are, and is united
by hashing, while bitmaps of 4 kB, nearly empty, are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "id_bucket", "id_bits"
WORD, MASK = "id_word", "id_mask"


def distinct_bits(df: DataFrame, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """The integers of a column per group, as bitmaps per bucket; negative ones too.

    Combined map-side, so a hot group moves a bitmap per bucket and task. Null ids count for nothing; a group
    that has only such keeps a row.
    """
    bucket = F.bitmap_bucket_number(id_col).alias(BUCKET)
    return df.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS))


def distinct_counts(bits: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Distinct ids per group of any coarseness over kept bitmaps; 0 for no rows and no keys."""
    united = bits.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))
    names = united.columns[: len(keys)]
    return united.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(name))


def distinct_words(df: DataFrame, keys: Sequence[str | Column], id_col: str) -> DataFrame:
    """The integers of a column per group, 64 to a word; negative ones too. Nulls as in `distinct_bits`."""
    id_ = F.col(id_col).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), id_.bitwiseAND(F.lit(63)).cast("int"))
    return df.groupBy(*keys, F.shiftright(id_, 6).alias(WORD)).agg(F.bit_or(bit).alias(MASK))


def word_counts(words: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """Distinct ids per group of any coarseness over kept words; 0 for no rows and no keys."""
    united = words.groupBy(*keys, WORD).agg(F.bit_or(MASK).alias(MASK))
    names = united.columns[: len(keys)]
    return united.groupBy(*names).agg(F.coalesce(F.sum(F.bit_count(MASK)), F.lit(0)).alias(name))
