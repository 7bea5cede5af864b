"""Filters of fixed size that let through all rows of some keys, and few others.

The keys' 64-bit hashes set bits of an array of numbers, which enters a plan as a scalar subquery.
Rows without their bit go ahead of any shuffle. The array's size does not depend on the keys; with
very many of them it lets more rows through, so whoever uses it decides on the rows that pass.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _place(hashed: Column, words: int) -> tuple[Column, Column]:
    """A hash's word in the array and bit in the word."""
    word = F.shiftright(hashed, 6).bitwiseAND(F.lit(words - 1))
    return word.cast("int"), hashed.bitwiseAND(F.lit(63)).cast("int")


def bit_filter(hashes: DataFrame, hashed: Column, words: int) -> Column:
    """The array, of so many words (a power of two) of 64 bits."""
    word, bit = _place(hashed, words)
    bits = hashes.select(word.cast("bigint").alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bits"))
    every = hashes.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bits"))
    each = bits.unionByName(every).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    in_order = each.agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("_all"))
    return in_order.select(F.col("_all._bits")).scalar()


def passes(bits: Column, hashed: Column, words: int) -> Column:
    """Whether a hash may be one of the keys'. For use in ``where``: as a column the array would be copied."""
    word, bit = _place(hashed, words)
    return F.getbit(F.get(bits, word), bit) == 1
