"""Sharding by jump consistent hashing.

The published function is evaluated with SQL expressions: a 64-bit linear congruential
generator, seeded with the key, names the next bucket count at which the key jumps.  The walk
along those jumps gives the shard for n and for n + 1 shards at once; no ring table exists,
and a shard that is appended takes rows only into itself.

Slots number the rows of a shard without gaps.  A shard is divided into buckets by a hash of
key, checksum and size, so that different rows of one key spread as well; bucket sizes (at
most shards x buckets rows, which is the bound of the broadcast) give the offsets, and rows
are numbered inside a bucket.

Defined results
  null text     16 bytes and the checksum of the empty text
  null key      handled like key 0
  text key      its 64-bit hash is the key
  repeated rows get different slots
  empty table   empty result
  extra columns are ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

SHARDS = 40
BUCKETS = 512
OVERHEAD = 16

# Fixed value of the published function: the multiplier of its generator.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_MASK32, _MASK16 = 0xFFFFFFFF, 0xFFFF


def _advance(high: Column, low: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 modulo 2**64, on two unsigned halves; no step overflows a long."""
    low0, low1 = low.bitwiseAND(F.lit(_MASK16)), F.shiftright(low, 16)
    high0, high1 = high.bitwiseAND(F.lit(_MASK16)), F.shiftright(high, 16)
    upper = low1 * F.lit(_LOW)
    total = low0 * F.lit(_LOW) + F.shiftleft(upper.bitwiseAND(F.lit(_MASK16)), 16) + F.lit(1)
    carry = F.shiftright(total, 32) + F.shiftright(upper, 16)
    cross = high0 * F.lit(_LOW) + F.shiftleft((high1 * F.lit(_LOW)).bitwiseAND(F.lit(_MASK16)), 16)
    next_high = (carry + (low * F.lit(_HIGH)).bitwiseAND(F.lit(_MASK32)) + cross).bitwiseAND(F.lit(_MASK32))
    return next_high, total.bitwiseAND(F.lit(_MASK32))


def jumps(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the buckets of a long key for ``shards`` and ``shards + 1``."""

    def named(high: Column, low: Column, next_: Column, shard: Column, grown: Column) -> Column:
        return F.struct(high.alias("high"), low.alias("low"), next_.alias("next"), shard.alias("shard"), grown.alias("grown"))

    def step(state: Column, _: Column) -> Column:
        high, low = _advance(state["high"], state["low"])
        here = state["next"]
        # The next jump lies at (here + 1) * 2**31 / (top 31 bits + 1), rounded down.
        draw = F.shiftright(high, 1) + 1
        after = F.floor((here + 1) * (F.lit(float(2**31)) / draw.cast("double"))).cast("long")
        moved = named(high, low, after, F.when(here < shards, here).otherwise(state["shard"]), here)
        return F.when(here <= shards, moved).otherwise(state)

    zero = F.lit(0).cast("long")
    high = F.shiftright(key, 32).bitwiseAND(F.lit(_MASK32))
    start = named(high, key.bitwiseAND(F.lit(_MASK32)), zero, zero, zero)
    # Every jump moves at least one bucket on, so shards + 1 steps always suffice.
    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step)


def shards(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", n: int = SHARDS, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    integral = isinstance(docs.schema[id_column].dataType, T.IntegralType)
    key = F.col(id_column).cast("long") if integral else F.xxhash64(F.col(id_column))
    key = F.coalesce(key, F.lit(0).cast("long"))
    found = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        key.alias("key"),
    )
    draw = F.substring(F.md5(F.concat_ws(":", "key", "text_crc32", "size")), 1, 8)
    placed = found.select(
        "doc_id",
        "size",
        "text_crc32",
        jumps(F.col("key"), n).alias("walk"),
        F.pmod(F.conv(draw, 16, 10).cast("long"), F.lit(buckets)).cast("int").alias("bucket"),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("walk.shard").cast("int").alias("shard"),
        F.col("walk.grown").cast("int").alias("grown_shard"),
        "bucket",
    )
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        placed.withColumn("place", inside)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("offset") + F.col("place") - 1).alias("slot"),
            "grown_shard",
        )
    )


def oracle(n: int = SHARDS, buckets: int = BUCKETS) -> str:
    """The same rows: the walk as a recursion on wide integers, the checksum byte by byte from its table."""
    # Fixed value: the reflected polynomial of CRC-32.
    halved = "CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END"
    wide = "CAST(18446744073709551616 AS HUGEINT)"
    return f"""
    WITH RECURSIVE c AS (
      SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda a, k: {halved}, CAST(n AS BIGINT))) AS crc),
    x AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
    y AS (
      SELECT doc_id, octet_length(raw) + {OVERHEAD} AS size, list_transform(
               range(octet_length(raw)), lambda i: CAST('0x' || hex(raw)[2 * i + 1:2 * i + 2] AS BIGINT)) AS bytes FROM x),
    d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, size, coalesce(doc_id, 0) AS key, xor(4294967295, list_reduce(
               bytes, lambda a, b: xor(a // 256, crc[xor(a, b) % 256 + 1]), CAST(4294967295 AS BIGINT))) AS text_crc32
      FROM y, c),
    w AS (
      SELECT r, ((CAST(key AS HUGEINT) % {wide}) + {wide}) % {wide} AS k, CAST(0 AS BIGINT) AS here, CAST(0 AS BIGINT) AS shard,
             CAST(0 AS BIGINT) AS grown FROM d
      UNION ALL
      SELECT r, z, CAST(floor((here + 1) * (2147483648.0::DOUBLE / CAST((z >> 33) + 1 AS DOUBLE))) AS BIGINT),
             CASE WHEN here < {n} THEN here ELSE shard END, here
      FROM (SELECT *, (k * {MULTIPLIER} + 1) % {wide} AS z FROM w WHERE here <= {n})),
    l AS (SELECT r, max(shard) AS shard, max(grown) AS grown FROM w GROUP BY r),
    p AS (
      SELECT d.*, shard, grown, CAST('0x' || substr(md5(concat_ws(':', key, text_crc32, size)), 1, 8) AS BIGINT) % {buckets} AS bucket
      FROM d JOIN l USING (r))
    SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
           row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
           CAST(grown AS INTEGER) AS grown_shard
    FROM p"""
