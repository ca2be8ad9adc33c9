"""Shuffled shards by a two-pass external shuffle.

Pass one scatters the rows over buckets that fit in memory, by a seeded hash of the id and the text. Pass two
Fisher-Yates shuffles each bucket (the built-in `shuffle` of an array) and deals the rows out: the buckets in order
are one random order of the whole corpus, the row at position p of it goes to slot p div n of shard p mod n. So the
sizes of shards differ by one row at most, and each task holds one bucket. A bucket of more than WIDE times the wanted
size has many rows equal in id and text, or very long texts; its rows are numbered and dealt again by these numbers too.

A null text counts as empty; rows without an id are spread by their text. Rows equal in id and text are dealt like any
others, but which of them gets which slot is not fixed. An empty table gives no rows. Input columns named like an
output column (shard, slot, in any case) are replaced; other columns may have any names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselore.llm.columns import numbered, without
from caselore.llm.prefix import running_totals
from caselore.session import shared_dir

#: Up to so many buckets their offsets, two numbers each, are sent to all tasks (16 MB).
BROADCAST_BUCKETS = 1_000_000
#: Buckets of more than so many times the wanted bytes are dealt again.
WIDE = 2


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shard(docs: DataFrame, n_shards: int = 8, seed: int = 17, bucket_bytes: int = 16 << 20, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """All columns of docs with shard (int, from 0) and slot (long, gapless from 0 in each shard)."""
    shared_dir(docs.sparkSession)
    plain, place = numbered(docs)
    kept = without(docs, "shard", "slot")
    key, text = F.col(place(id_col)), F.col(place(text_col))
    total = plain.agg(F.sum(row_bytes(text))).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))

    def bucket(*salt: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), key, text, *salt), F.lit(n_buckets)).cast("int").alias("bucket")

    light = plain.groupBy(bucket()).agg(F.count("*").alias("n"), F.sum(row_bytes(text)).alias("bytes")).checkpoint()
    rows = plain.select(bucket(), F.xxhash64(F.lit(seed + 1), key, text).alias("ord"),
                        F.struct(*[f"c{i}" for i in kept]).alias("row"))
    counts = light.select("bucket", "n")
    wide = light.filter(F.col("bytes") > WIDE * bucket_bytes).select("bucket")
    if not wide.isEmpty():
        # Rows equal in id and text are in one bucket: number the rows of wide buckets, store the numbers, deal them again.
        salted = (plain.withColumn("bucket", bucket()).join(F.broadcast(wide), "bucket").drop("bucket")
                  .withColumn("salt", F.monotonically_increasing_id()).checkpoint())
        dealt = salted.select(bucket(F.col("salt")), F.xxhash64(F.lit(seed + 1), key, text, "salt").alias("ord"),
                              F.struct(*[f"c{i}" for i in kept]).alias("row"))
        rows = rows.join(F.broadcast(wide), "bucket", "left_anti").unionByName(dealt)
        counts = (counts.join(F.broadcast(wide), "bucket", "left_anti")
                  .unionByName(dealt.groupBy("bucket").agg(F.count("*").alias("n")))
                  .groupBy("bucket").agg(F.sum("n").alias("n"))).checkpoint()
    offsets = running_totals(counts, "bucket", "n").select("bucket", F.col("before").alias("first_position"))
    if n_buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    scattered = rows.repartitionById(n_buckets, F.col("bucket")).sortWithinPartitions("bucket", "ord")
    shuffled = (scattered.groupBy("bucket").agg(F.collect_list("row").alias("rows"))
                .join(offsets, "bucket")
                .select("first_position", F.shuffle("rows", F.lit(seed)).alias("rows"))
                .select("first_position", F.posexplode("rows").alias("pos", "row"))
                .select("row", (F.col("first_position") + F.col("pos")).alias("p")))
    return shuffled.select(*[F.col("row")[f"c{i}"] for i in kept],
                           (F.col("p") % n_shards).cast("int").alias("shard"),
                           F.floor(F.col("p") / n_shards).cast("long").alias("slot")
                           ).toDF(*[docs.columns[i] for i in kept], "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write one folder per shard; every file of a shard holds consecutive parts of its order, by slot."""
    shard(docs, **options).write.partitionBy("shard").parquet(path)
