"""From a record's key to its partition, as the default partitioner of keyed producers does it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the 32-bit hash: seed, factor, and the distances its words and its result are shifted by.
SEED = 0x9747B28C
FACTOR = 0x5BD1E995
WORD_SHIFT = 24
LAST_SHIFTS = (13, 15)
MASK = 0xFFFFFFFF


def _times(c: Column) -> Column:
    """``c`` x FACTOR in 32 bits. The product is taken in halves, since 64 bits could overflow."""
    high = F.shiftleft((F.shiftrightunsigned(c, 16) * FACTOR).bitwiseAND(0xFFFF), 16)
    return (c.bitwiseAND(0xFFFF) * FACTOR + high).bitwiseAND(MASK)


def _mixed(c: Column, shift: int) -> Column:
    return c.bitwiseXOR(F.shiftrightunsigned(c, shift))


def _word(digits: Column, start: Column, size: int) -> Column:
    """Number of ``size`` bytes from byte ``start`` on, the first byte being the lowest."""
    pairs = [F.substring(digits, start * 2 + (2 * i + 1), F.lit(2)) for i in reversed(range(size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def murmur2(key: Column) -> Column:
    """The 32-bit hash of a text's UTF-8 bytes (or of binary bytes) as a number from 0 to 2^32 - 1; null for null.

    Every step is a pass over an array of its own: inside one expression, each use of a value would compute it anew.
    """
    return F.when(key.isNotNull(), F.get(F.transform(F.array(F.hex(F.encode(key, "UTF-8"))), _hash_of), F.lit(0)))


def _hash_of(digits: Column) -> Column:
    size = F.shiftright(F.length(digits), 1).cast("bigint")
    whole = F.shiftright(size, 2)
    starts = F.when(whole > 0, F.sequence(F.lit(0).cast("bigint"), whole - 1)).otherwise(F.array().cast("array<bigint>"))
    words = F.transform(starts, lambda i: _word(digits, i * 4, 4))
    scaled = F.transform(F.transform(words, _times), lambda x: _mixed(x, WORD_SHIFT))
    keyed = F.transform(scaled, _times)
    h = F.aggregate(keyed, F.lit(SEED).cast("bigint").bitwiseXOR(size), lambda h, k: _times(h).bitwiseXOR(k))
    rest = size % 4
    tail = F.when(rest == 1, _word(digits, whole * 4, 1)).when(rest == 2, _word(digits, whole * 4, 2)).when(rest == 3, _word(digits, whole * 4, 3))
    ended = F.transform(F.array(F.struct(h.alias("h"), tail.alias("tail"))), lambda s: F.when(s["tail"].isNull(), s["h"]).otherwise(_times(s["h"].bitwiseXOR(s["tail"]))))
    mixed = F.transform(F.transform(ended, lambda x: _mixed(x, LAST_SHIFTS[0])), _times)
    return F.get(F.transform(mixed, lambda x: _mixed(x, LAST_SHIFTS[1])), F.lit(0))


def key_partition(key: Column, partitions: int | Column) -> Column:
    """Partition of a key: the hash without its sign bit, modulo the partitions; null for a null key."""
    count = partitions if isinstance(partitions, Column) else F.lit(partitions)
    return F.pmod(murmur2(key).bitwiseAND(0x7FFFFFFF), count).cast("int")
