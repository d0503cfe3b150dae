"""Whether a key may be in a large set, decided where the row lies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.scratch import materialize

#: words of 64 bits; 16 MB however many keys there are
MOST_WORDS = 1 << 21
_PROBES = 4


def mark_members(rows: DataFrame, keys: DataFrame, on: str, n_keys: int, name: str, most_words: int = MOST_WORDS) -> DataFrame:
    """Add ``name``: false where ``on`` is surely none of ``keys`` (a column called ``on``), NULL keys included.

    A key sets four bits of one 64-bit word.  There is a word for every four keys, up to
    ``most_words``; beyond that more strangers pass, but the broadcast does not grow.
    """
    words = max(1, min(most_words, n_keys // 4 + 1))
    place = F.pmod(F.xxhash64(F.lit(1), on), F.lit(words))
    second, bits = F.xxhash64(F.lit(2), on), F.lit(0).cast("long")
    for i in range(_PROBES):
        at = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    table = keys.select(place.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_set"))
    table = materialize(table, "membership")
    probed = rows.withColumns({"_word": place, "_bits": bits}).join(F.broadcast(table), "_word", "left")
    hit = F.col(on).isNotNull() & (F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return probed.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_word", "_bits", "_set")
