"""Sharding by jump consistent hashing, in DataFrame functions only.

Lamping and Veach's jump hash walks a pseudo-random sequence seeded by the key:
the bucket number "jumps" ahead until it passes the number of shards. There is
no ring table, and when a shard is appended the only keys that move are the
1/(n+1) that jump into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.common import gapless_rank, slice_key

_M32 = 0xFFFFFFFF
# The generator's multiplier is 2862933555777941757, here in two 32-bit halves.
_C_HI, _C_LO = 2862933555777941757 >> 32, 2862933555777941757 & _M32
#: Steps that every key takes; a key still short of its shard walks on, the rest don't.
_FIRST_STEPS = 24


def _advance(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * multiplier + 1 modulo 2**64, without leaving signed 64-bit longs."""
    l0, l1 = lo.bitwiseAND(0xFFFF), F.shiftright(lo, 16)
    a0, a1 = l0 * F.lit(_C_LO), l1 * F.lit(_C_LO)
    low = a0 + F.shiftleft(a1.bitwiseAND(0xFFFF), 16) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(a1, 16)
    h0, h1 = hi.bitwiseAND(0xFFFF), F.shiftright(hi, 16)
    high = h0 * F.lit(_C_LO) + F.shiftleft((h1 * F.lit(_C_LO)).bitwiseAND(0xFFFF), 16)
    m0, m1 = lo.bitwiseAND(0xFFFF), F.shiftright(lo, 16)
    cross = m0 * F.lit(_C_HI) + F.shiftleft((m1 * F.lit(_C_HI)).bitwiseAND(0xFFFF), 16)
    new_hi = (carry + high.bitwiseAND(_M32) + cross.bitwiseAND(_M32)).bitwiseAND(_M32)
    return new_hi, low.bitwiseAND(_M32)


def jump_hash(key: Column, n_shards: int) -> Column:
    """The shard (0 to ``n_shards`` - 1) of a 64-bit integer key; a null key counts as 0."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    state = F.struct(
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("jump"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(_M32).alias("lo"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = _advance(s["hi"], s["lo"])
        going = s["jump"] < n_shards
        ahead = F.floor((s["jump"] + 1) * (F.lit(2147483648.0) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.struct(
            F.when(going, s["jump"]).otherwise(s["shard"]).alias("shard"),
            F.when(going, ahead).otherwise(s["jump"]).alias("jump"),
            hi.alias("hi"),
            lo.alias("lo"),
        )

    # A jump advances by one shard at least, so n_shards steps always suffice; some ln(n) are the rule.
    first = min(n_shards, _FIRST_STEPS)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(first)), state, step)
    if n_shards > first:
        walked = F.aggregate(
            F.array(walked),
            state,
            lambda _, s: F.when(s["jump"] >= n_shards, s).otherwise(
                F.aggregate(F.sequence(F.lit(first + 1), F.lit(n_shards)), s, step)
            ),
        )
    return walked["shard"].cast("int")


def assign_shards(docs: DataFrame, n_shards: int, key: str = "doc_id") -> DataFrame:
    """Add shard, slot (the row's place in its shard, gapless from 0) and grown_shard, in place of columns so named.

    ``grown_shard`` is the shard with one more shard: it is ``shard`` or
    ``n_shards``. Rows keep all their columns. Rows of one key share a shard,
    null keys that of key 0. Within a shard rows are ordered by the md5 slice of
    the key and then the key, so slots are stable and neighbours are unrelated;
    rows of equal key take successive slots in any order. An empty table gives
    an empty table. ``docs`` is read twice and must give the same rows, as files do.
    """
    out = docs.drop("shard", "slot", "grown_shard").withColumns({"shard": jump_hash(F.col(key), n_shards), "grown_shard": jump_hash(F.col(key), n_shards + 1)})
    return gapless_rank(out, ["shard"], slice_key(F.col(key)), [key], "slot")


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder a shard, rows in slot order in each of its files."""
    (
        sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def op3_jump_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, by doc_id and the shard count alone."""
    from readloom.llm.common import table

    docs = table(spark, sf_dir, "documents")
    body = F.encode(F.col("text"), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0).cast("long")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return assign_shards(rows, 16)


#: Bytewise crc32 and the walk of jump hash; both are recursive in SQL.
OP3_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))
), texts AS (
  SELECT DISTINCT coalesce(text, '') AS text FROM documents
), crcs AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      string_split(regexp_replace(hex(encode(text)), '(..)', '\\1,', 'g'), ',')[:-2],
      lambda b: ('0x' || b)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM texts, crc_table
), walk AS (
  SELECT DISTINCT n, coalesce(doc_id, 0) AS id, 0::BIGINT AS b, 0::BIGINT AS j,
         ((coalesce(doc_id, 0)::HUGEINT + 18446744073709551616) % 18446744073709551616)::UHUGEINT AS k
  FROM documents, (VALUES (16), (17)) AS s(n)
  UNION ALL
  SELECT n, id, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1)))::BIGINT, k2
  FROM (SELECT *, ((k * 2862933555777941757::UHUGEINT) + 1) % 18446744073709551616::UHUGEINT AS k2 FROM walk WHERE j < n)
), shards AS (
  SELECT id, max(b) FILTER (n = 16)::INTEGER AS shard, max(b) FILTER (n = 17)::INTEGER AS grown_shard
  FROM walk WHERE j >= n GROUP BY id
)
SELECT d.doc_id, strlen(coalesce(d.text, '')) + 1 AS size, c.crc AS text_crc32, 'key' AS law, s.shard, s.grown_shard,
       row_number() OVER (PARTITION BY s.shard ORDER BY md5(coalesce(d.doc_id::VARCHAR, ''))[1:3], d.doc_id) - 1 AS slot
FROM documents d JOIN crcs c ON c.text = coalesce(d.text, '') JOIN shards s ON s.id = coalesce(d.doc_id, 0)
"""
