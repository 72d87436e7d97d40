"""Shards by jump consistent hashing.

A document's shard is decided by its key (doc_id) and the number of shards alone: the key seeds
a 64-bit linear congruential generator, and the generator's jumps name the bucket at which the key
would move next. Adding a shard moves rows only into the new shard. A null id counts as key 0.

`slot` numbers the rows of a shard from 0 without gaps. Rows are cut into blocks by a hash
of (id, text), so no task holds a shard; a block's rows are ranked on their own and shifted
by the sizes of the blocks before it, of which there are `blocks` per shard at most. Rows that are
equal in id and text get different slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

# Fixed values of the published generator: multiplier and increment, modulo 2^64.
MULTIPLIER = 2862933555777941757
INCREMENT = 1
_LIMB = (1 << 22) - 1
_TOP = (1 << 20) - 1
_M = (MULTIPLIER & _LIMB, (MULTIPLIER >> 22) & _LIMB, MULTIPLIER >> 44)


def _next(s: Column) -> tuple[Column, Column, Column]:
    """One step of the generator on limbs of 22, 22 and 20 bits, which cannot overflow a long."""
    low = s["k0"] * _M[0] + INCREMENT
    mid = s["k0"] * _M[1] + s["k1"] * _M[0] + F.shiftright(low, 22)
    high = s["k0"] * _M[2] + s["k1"] * _M[1] + s["k2"] * _M[0] + F.shiftright(mid, 22)
    return low.bitwiseAND(_LIMB), mid.bitwiseAND(_LIMB), high.bitwiseAND(_TOP)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard (int, 0 to shards - 1) of a long key. Every jump goes up, so `shards` steps suffice."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    long = lambda c: c.cast("bigint")
    start = F.struct(
        long(F.lit(0)).alias("at"), long(F.lit(0)).alias("jump"), key.bitwiseAND(_LIMB).alias("k0"),
        F.shiftrightunsigned(key, 22).bitwiseAND(_LIMB).alias("k1"),
        F.shiftrightunsigned(key, 44).alias("k2"))

    def drawn(s: Column) -> Column:
        k0, k1, k2 = _next(s)
        return F.struct(s["jump"].alias("at"), s["jump"].alias("jump"), k0.alias("k0"),
                        k1.alias("k1"), k2.alias("k2"))

    def jumped(s: Column) -> Column:
        top = F.shiftleft(s["k2"], 11).bitwiseOR(F.shiftright(s["k1"], 11)) + 1
        return F.struct(
            s["at"].alias("at"), long(F.floor((s["at"] + 1) * (F.lit(float(1 << 31)) / top))).alias("jump"),
            s["k0"].alias("k0"), s["k1"].alias("k1"), s["k2"].alias("k2"))

    # Each step appears as draw, then jump, so that no expression is evaluated twice.
    steps = F.sequence(F.lit(1), F.lit(2 * shards))
    end = F.aggregate(steps, start, lambda s, i: F.when(s["jump"] >= shards, s).otherwise(
        F.when(i % 2 == 1, drawn(s)).otherwise(jumped(s))))
    return end["at"].cast("int")


def numbered(docs: DataFrame, shard: str, key: list[Column], blocks: int, name: str = "slot") -> DataFrame:
    """Add gapless numbers from 0 within each shard."""
    work = docs.withColumn("_block", F.pmod(F.xxhash64(*key), F.lit(blocks)))
    totals = work.groupBy(shard, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards x blocks rows.
    offsets = totals.select(shard, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(shard, "_block").orderBy(*key))
    ranked = work.withColumn("_rank", rank)
    joined = ranked.join(offsets, [shard, "_block"])
    return joined.select(*docs.columns, (F.col("_before") + F.col("_rank") - 1).cast("bigint").alias(name))


def shard_documents(docs: DataFrame, shards: int = 8, blocks: int = 1024, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size (UTF-8 bytes + 1), text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).cast("bigint").alias("text_crc32"), F.lit("key").alias("law"),
        jump_hash(F.col(id_col), shards).alias("shard"), jump_hash(F.col(id_col), shards + 1).alias("grown_shard"))
    placed = numbered(written(rows, "shards"), "shard",
                      [F.col("doc_id"), F.col("text_crc32"), F.col("size")], blocks)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def placed_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id") -> DataFrame:
    """The documents with all their columns, and the shard as `shard_id`; `write_shards` stores them by it.

    A column of that name is replaced."""
    return docs.withColumn("shard_id", jump_hash(F.col(id_col), shards))


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder `shard_id=N` for each shard. Every task writes to the folders of its own rows, without a shuffle."""
    placed.write.partitionBy("shard_id").parquet(path)
