"""Anti-join behind a Bloom filter (J6): rows that surely have no match skip the shuffle.

The filter is built by Spark's bitmap aggregate: each key sets ``HASHES`` bits
of a map that is sized by the number of keys, kept as rows of 32,768 bits.  Rows
whose bits aren't all set have no match for sure and pass at once; the others,
all matches and a few per cent more, are joined exactly, so the result doesn't
depend on the filter.  The filter is broadcast only within
``max_filter_bytes``; beyond, all rows take the exact join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.star import HOT_FRACTION, HOT_ROWS, missing_keys

HASHES = 2
PART_BITS = 32_768
PIECE_BITS = 2_048                # a test copies a piece of the map for its row


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(n)), F.lit(bits)) for n in range(HASHES)]


def key_filter(existing: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """(part, bitmap): the bits of all keys, a row per 32,768 of them that has one set; a partial aggregate."""
    place = existing.select(F.explode(F.array(*_places(keys, bits))).alias("place"))
    return place.groupBy(F.floor(F.col("place") / PART_BITS).alias("part")).agg(
        F.bitmap_construct_agg(F.col("place") % PART_BITS).alias("bitmap"))


def maybe_in(df: DataFrame, found: DataFrame, keys: Sequence[str], bits: int, flag: str, part_bits: int = PART_BITS) -> DataFrame:
    """``df`` with ``flag``: false where no key of the filter is equal, for sure.  No shuffle: the filter is broadcast."""
    out = df
    tests = []
    for n, place in enumerate(_places(keys, bits)):
        part, bitmap, at = f"__part{n}", f"__bitmap{n}", f"__at{n}"
        out = out.withColumn(at, place).withColumn(part, F.floor(F.col(at) / part_bits))
        out = out.join(F.broadcast(found.select(F.col("part").alias(part), F.col("bitmap").alias(bitmap))), part, "left")
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(F.col(at) % part_bits / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        tests.append(F.coalesce(F.call_function("shiftright", byte.cast("int"), (F.col(at) % 8).cast("int")).bitwiseAND(1) == 1, F.lit(False)))
    both = tests[0]
    for t in tests[1:]:
        both = both & t
    return out.select(*[F.col(f"`{c}`") for c in df.columns], both.alias(flag))


def flagged(df: DataFrame, existing: DataFrame, on: str | Sequence[str], flag: str, bits_per_key: int = 10,
            max_filter_bytes: int = 32 << 20) -> DataFrame:
    """``df`` with ``flag``: false where ``existing`` has no equal key, for sure; equal keys are of one type on both sides.

    The filter grows with the keys up to ``max_filter_bytes``; with more keys, more rows are flagged than need be.
    ``existing`` is read three times.
    """
    keys = [on] if isinstance(on, str) else list(on)
    n = existing.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    parts = min(-(-max(1, n * bits_per_key) // PART_BITS), max(1, max_filter_bytes * 8 // PART_BITS))
    piece = F.explode(F.sequence(F.lit(0), F.lit(PART_BITS // PIECE_BITS - 1))).alias("piece")
    pieces = key_filter(existing, keys, parts * PART_BITS).select("part", "bitmap", piece).select(
        (F.col("part") * (PART_BITS // PIECE_BITS) + F.col("piece")).alias("part"),
        F.substring(F.col("bitmap"), F.col("piece") * (PIECE_BITS // 8) + 1, F.lit(PIECE_BITS // 8)).alias("bitmap"))
    return maybe_in(df, pieces, keys, parts * PART_BITS, flag, PIECE_BITS)


def missing_keys_filtered(required: DataFrame, existing: DataFrame, on: str | Sequence[str], bits_per_key: int = 10,
                          max_filter_bytes: int = 64 << 20, hot_fraction: float = HOT_FRACTION,
                          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``required`` without a match in ``existing`` (J6), as ``missing_keys`` gives them.

    Worth it where most rows have no match.  ``required`` is read twice, ``existing`` three times: write what is
    expensive to derive to a table before.
    """
    keys = [on] if isinstance(on, str) else list(on)
    n = existing.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    bits = -(-max(1, n * bits_per_key) // PART_BITS) * PART_BITS
    if bits // 8 > max_filter_bytes:
        return missing_keys(required, existing, keys, hot_fraction, hot_rows)
    flag = "__strata_maybe"
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    flagged = maybe_in(required, key_filter(existing, keys, bits), keys, bits, flag)
    flagged = flagged.withColumn(flag, F.col(flag) & ~some_null)
    rest = missing_keys(flagged.filter(flag).drop(flag), existing, keys, hot_fraction, hot_rows)
    return flagged.filter(~F.col(flag)).drop(flag).unionByName(rest)
