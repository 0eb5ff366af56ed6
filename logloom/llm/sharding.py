"""Shuffled shards by a two-pass external shuffle.

Pass one scatters the records uniformly over buckets that fit in memory, by a
seeded hash. Pass two reads one bucket at a time, puts it into random order
with a Fisher-Yates shuffle (`shuffle` of an array) and writes it. The buckets
one after another are the shuffled corpus; shards are equal cuts of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from logloom.scratch import Scratch

LAW = "rows"


def write_shuffled(
    records: DataFrame,
    work: Scratch,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 42,
    bucket_bytes: int = 16 << 20,
    least_buckets: int = 64,
) -> DataFrame:
    """The records, shuffled and written: columns `bucket`, `place` (from 0 in its bucket) and `record`, a struct of all columns.

    The hash takes in the row's number in its input file split, so that rows
    repeated any number of times, or without id, spread like others. A bucket
    holds about `bucket_bytes` of text, or the share of one of `least_buckets`;
    only a single text above that makes a larger one. An empty table gives an
    empty one.
    """
    size = F.coalesce(F.octet_length(text_column), F.lit(0)) + 1
    total = records.agg(F.sum(size)).first()[0] or 0
    buckets = max(least_buckets, -(-total // bucket_bytes))
    chance = F.xxhash64(F.lit(seed), F.col(id_column), F.xxhash64(text_column), F.monotonically_increasing_id())
    scattered = records.select(
        F.pmod(chance, F.lit(buckets)).cast("int").alias("bucket"),
        F.struct(chance.alias("chance"), F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")).alias("item"),
    )
    scattered = scattered.repartition(buckets, "bucket")
    # sorted first: the order in which shuffled rows arrive must not matter
    dealt = scattered.groupBy("bucket").agg(F.shuffle(F.array_sort(F.collect_list("item")), seed).alias("items"))
    placed = dealt.select("bucket", F.posexplode("items").alias("place", "item"))
    return work.keep(placed.select("bucket", "place", "item.record"), "shuffled", compression="zstd")


def shards(shuffled: DataFrame, work: Scratch, shard_count: int = 16) -> DataFrame:
    """Shuffled records with `shard` (from 0) and `slot` (from 0 in its shard); counts of shards differ by one at most."""
    counts = shuffled.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket, not per record
    offsets = counts.select(
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    position = F.col("offset") + F.col("place")
    placed = shuffled.join(work.keep(offsets, "offsets"), "bucket")
    placed = placed.withColumn("position", position).withColumn("shard", F.expr(f"(position * {shard_count}) div total"))
    first = F.expr(f"(shard * total + {shard_count - 1}) div {shard_count}")
    return placed.select(F.col("shard").cast("int").alias("shard"), (F.col("position") - first).alias("slot"), "record")


def shard_rows(
    docs: DataFrame, work: Scratch, *, id_column: str = "doc_id", text_column: str = "text", shard_count: int = 16, **options
) -> DataFrame:
    """One row per document, read from the written shards: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1; a null text counts 0 bytes and has
    the checksum of an empty one, 0. Repeated rows each have a place.
    """
    shuffled = write_shuffled(
        docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")),
        work, id_column="id", text_column="text", **options,
    )
    text = F.col("record.text")
    return shards(shuffled, work, shard_count).select(
        F.col("record.id").alias(id_column),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
