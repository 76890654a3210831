"""Draws without replacement from ranges of whole numbers that are never written out: a keyed permutation, evaluated where it is asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the permutation.
ROUNDS = 4
#: Steps outside the range that a draw may take. A square of side a has less than a numbers outside; ranges up to 4,096 need at most 64, larger ones leave a draw outside so often with a chance below 1 in 64 ** 64.
STEPS = 64


def _noise(seed: Column, turn: int, value: Column) -> Column:
    """32 bits of MD5; the same in any SQL that has it."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", seed, F.lit(str(turn)), value.cast("string"))), 1, 8), 16, 10).cast("long")


def image(number: Column, span: Column, seed: Column) -> Column:
    """A permutation of 0 .. span - 1, keyed by seed (a text): Feistel rounds on the two digits of number, to the base a = ceil(sqrt(span)) and beyond it, again while the image is outside.

    Each round adds to one digit what a hash makes of the other, modulo the digit's base, which can be taken back; so
    no two numbers have one image. span is at most 2 ** 62.
    """
    a = F.ceil(F.sqrt(span.cast("double"))).cast("long")
    b = F.call_function("div", span + a - 1, a)

    def once(x: Column) -> Column:
        high, low = F.call_function("div", x, b), F.pmod(x, b)
        for turn in range(ROUNDS):
            if turn % 2 == 0:
                high = F.pmod(high + _noise(seed, turn, low), a)
            else:
                low = F.pmod(low + _noise(seed, turn, high), b)
        return high * b + low

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), once(number.cast("long")), lambda x, _: F.when(x < span, x).otherwise(once(x)))
    return F.when(walk < span, walk).otherwise(F.raise_error(F.lit("a draw left its range")).cast("long"))


def drawn(rows: DataFrame, least: str, most: str, n: str, *keys: str, seed: int = 0) -> DataFrame:
    """rows with rk and drawn, exploded: of each row n different whole numbers from least to most, all of them where there are fewer.

    They follow from seed and the row's keys. Each is computed by itself: nothing is shuffled, and no range is written out.
    A range that ends before it begins, or n below 1, gives no rows; so do nulls.
    """
    span = F.col(most).cast("long") - F.col(least).cast("long") + 1
    count = F.when(span.isNotNull() & F.col(n).isNotNull(), F.least(span, F.col(n).cast("long")))
    each = rows.where(F.coalesce(count, F.lit(0).cast("long")) > 0).withColumn("rk", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    return each.withColumn("drawn", F.col(least).cast("long") + image(F.col("rk"), span, F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))))
