"""Even shards by histogram sort.

The rows are ordered by a key: the digest of the text, then the digest of the id. Each round counts
the exact bytes below candidate keys over all partitions and refines the probes around each of the
splitters until a probe is within the tolerance. Each shard is split in as many ranges as the cluster
has tasks for, and the rows are exchanged once, each to the partition whose number is its range's.
Equal texts lie side by side, so a splitter parts a group of them only if no key outside the group
is near enough to the even split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapdelta.llm.frames import kept, text_of
from snapdelta.llm.histogram import find_cuts

#: How far from the even split a splitter may lie, as a share of a shard.
TOLERANCE = 0.01
#: Bytes that a row counts besides its text.
ROW_BYTES = 8
TEXT_DIGITS = 32


def key_of(row_id: Column, text: Column) -> Column:
    return F.concat(F.md5(text), F.md5(F.coalesce(row_id.cast("string"), F.lit("null"))))


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[str]:
    """The least key of each shard but the first. ``keys`` is stored and has ``key`` and ``size``."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    targets = [(0, total * at // shards) for at in range(1, shards)]
    weighed = keys.select(F.lit(0).alias("group"), "key", F.col("size").alias("weight"))
    cuts = find_cuts(weighed, targets, tolerance=int(tolerance * total / shards), whole_prefix=TEXT_DIGITS)
    found = []
    for target in targets:
        cut = cuts[target]
        after = cut.within and cut.below + cut.within - target[1] < target[1] - cut.below
        found.append(cut.key + "g" if after else cut.key)  # "g" follows all digits
    return sorted(found)


def ranges_of(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[list[str]]:
    """For each shard the least key of each of its ranges; the first shard's first is the empty text."""
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = max(1, -(-parts // shards))
    # a shard's edge is as near to the even split as without ranges, unless a range is small against the tolerance
    found = ["", *splitters(keys, shards * per, min(tolerance * per, 0.25))]
    return [found[at : at + per] for at in range(0, shards * per, per)]


def _below(key: Column, least: Column) -> Column:
    return F.size(F.filter(least, lambda split: split <= key)).cast("int")


def _placed(rows: DataFrame, ranges: list[list[str]]) -> DataFrame:
    """``rows`` with the shard and range of their ``key``, each range in a partition of its own, in the order of the key."""
    edges = F.array(*[F.lit(least[0]) for least in ranges])
    inner = F.array(*[F.array(*[F.lit(split) for split in least]) for least in ranges])
    shard = (_below(F.col("key"), edges) - 1).alias("shard")
    placed = rows.select("*", shard)
    per = len(ranges[0])
    placed = placed.withColumn("range", (F.col("shard") * per + _below(F.col("key"), F.get(inner, F.col("shard"))) - 1).cast("int"))
    return placed.repartitionById(len(ranges) * per, "range").sortWithinPartitions("key")


def assign_shards(
    docs: DataFrame, shards: int = 24, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, size (UTF-8 bytes of the text and 8), text_crc32, law, shard, slot.

    The law is ``bytes``: shards hold nearly the same bytes, whatever the copies. Slots number the rows
    of a shard from 0 without a gap, in the order of the key. A null text is the empty one; rows equal
    in id and text lie side by side and may be parted; an empty table gives an empty one.
    """
    text = text_of(text_col)
    keys = kept(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
            key_of(F.col(id_col), text).alias("key"),
        )
    )
    ordered = kept(_placed(keys, ranges_of(keys, shards, tolerance)).select("id", "size", "text_crc32", "shard", "range"))
    nth = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("nth")  # a partition holds one range
    numbered = ordered.select("*", nth)
    starts, shard_now, so_far = [], None, 0
    for shard, at, n in sorted(numbered.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n")).collect()):  # a row per range
        so_far = so_far if shard == shard_now else 0
        starts.append((at, so_far))
        shard_now, so_far = shard, so_far + n
    found = numbered.join(F.broadcast(docs.sparkSession.createDataFrame(starts, "range int, start long")), "range")  # a row per range
    return found.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("nth") + F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def exchanged(docs: DataFrame, ranges: list[list[str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, shard): the rows themselves, moved once by ``ranges_of`` and in the order of their key, ready to be written by shard.

    A null text is the empty one; repeated rows lie side by side; an empty table gives an empty one; the row is one
    value, so that none of its columns clashes with ours.
    """
    key = key_of(F.col(id_col), text_of(text_col))
    return _placed(docs.select(F.struct("*").alias("row"), key.alias("key")), ranges).select("row", "shard")
