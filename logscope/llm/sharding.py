"""Sharding (operator 5): two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters the rows uniformly into buckets small enough for memory, by a seeded hash of
the row.  Pass 2 shuffles each bucket by a Fisher-Yates permutation (Spark's ``shuffle`` of the
bucket's positions) and writes it.  Buckets follow each other in one global order, so a row's
place is its bucket's start plus its place in the bucket; shard ``k`` of ``n`` holds the places
from ``ceil(k * rows / n)``, so the shards' row counts differ by at most one (law ``rows``) and a
bucket is written to one or two shards without another shuffle of the texts.

Only two small frames are made besides: the bucket sizes (one narrow aggregate) and one array
of positions per bucket.  The number of buckets grows with the input's bytes.

Defined cases: a null text stays null and has size 8 and the CRC of no bytes; rows that repeat an id
are placed like any other; rows equal in id and text share a bucket; an empty table gives
empty shards.  Columns of the input are kept; temporary names never clash with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logscope.session import checkpoint_dir

from .common import cut, fresh, total_bytes

BUCKET_BYTES = 32 << 20
SEED = 1


def row_size(text: str) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8 for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def text_crc32(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def shuffle_into_shards(docs: DataFrame, shards: int, seed: int = SEED, doc_id: str = "doc_id",
                        text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards-1) and ``slot`` (place in the shard, gapless from 0),
    each bucket's rows sorted by both within one task, ready to be written."""
    bucket, start, n, order, rank, place = fresh(docs, "_bucket", "_start", "_n", "_order", "_rank", "_place")
    rows, size = total_bytes(docs, text)
    count = max(1, -(-(size + 8 * rows) // bucket_bytes))
    salt = F.xxhash64(F.lit(seed), F.col(doc_id), F.coalesce(F.octet_length(text), F.lit(-1)), text_crc32(text))
    scattered = docs.withColumn(bucket, F.pmod(salt, F.lit(count)))

    # bucket sizes and starts: one row per bucket
    sizes = cut(scattered.groupBy(bucket).agg(F.count(F.lit(1)).alias(n)))
    starts = sizes.withColumn(start, F.sum(n).over(Window.orderBy(bucket)) - F.col(n))
    # Fisher-Yates over the positions of each bucket; stored, so that a task run again reads
    # the same permutation
    perms = cut(starts.repartition(bucket).sortWithinPartitions(bucket).select(
        bucket, start, F.shuffle(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")), seed).alias(order)))

    by_key = Window.partitionBy(bucket).orderBy(F.xxhash64(F.lit(seed + 1), F.col(doc_id)), doc_id, text_crc32(text))
    ranked = scattered.withColumn(rank, F.row_number().over(by_key))
    placed = ranked.join(perms.hint("shuffle_merge"), bucket).withColumn(
        place, F.col(start) + F.element_at(order, F.col(rank)).cast("long"))
    # exact integer arithmetic: shard k starts at ceil(k * rows / shards)
    shard = F.expr(f"cast(`{place}` * {shards} div {max(rows, 1)} as int)")
    first = F.expr(f"((`{place}` * {shards} div {max(rows, 1)}) * {rows} + {shards - 1}) div {shards}")
    return (placed.withColumns({"shard": shard, "slot": F.col(place) - first})
            .select(*[docs[c] for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
            .sortWithinPartitions("shard", "slot"))


def write_shards(docs: DataFrame, shards: int, path: str | None = None, seed: int = SEED, doc_id: str = "doc_id",
                 text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` below ``path`` (default: a new folder in the shared checkpoint folder), one
    folder ``shard=k`` per shard, and read the shards back."""
    spark = docs.sparkSession
    out = shuffle_into_shards(docs, shards, seed, doc_id, text, bucket_bytes)
    if path is None:
        root = checkpoint_dir(spark)
        if not root:
            raise RuntimeError("name a path or set spark.checkpoint.dir")
        path = f"{root.rstrip('/')}/shards-{uuid.uuid4().hex}"
    out.write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)
