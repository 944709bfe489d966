"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points on a ring of hashes; a row belongs to the
arc that ends at the next point clockwise.  A shard takes rows up to its
capacity; the rest of an arc's rows continue clockwise to the next point of a
shard with room.  With ``slack`` 0 the capacities add up to the number of
rows, so counts are at most one apart; with more slack fewer rows move when
rows or shards are added.

The ring is walked over counts, not rows: the number of rows per arc (at most
shards x virtual of them) goes to the driver, which cuts each arc's rows into
ranges of rank and gives every range a shard and a first slot.  There are at
most 2 x arcs + shards ranges, since a step of the walk either ends an arc or
fills a shard.  Rows are ranked inside their arc by a distributed sort and
look up their range, so neither an arc nor a shard is ever in one task.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import ranked_within

VIRTUAL = 128


def ring_points(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(position, shard), clockwise; positions are signed 64-bit hashes."""
    points = []
    for shard in range(shards):
        for k in range(virtual):
            raw = hashlib.blake2b(f"shard {shard} point {k}".encode(), digest_size=8).digest()
            points.append((int.from_bytes(raw, "big", signed=True), shard))
    return sorted(points)


def capacities(total: int, shards: int, slack: float) -> list[int]:
    if slack <= 0:
        return [total // shards + (s < total % shards) for s in range(shards)]
    most = int(-(-total * (1 + slack) // shards))
    return [most] * shards


def walk(points: list[tuple[int, int]], counts: list[int], room: list[int]
         ) -> list[tuple[int, int, int, int, int]]:
    """(arc, from rank, to rank, shard, first slot) for every range of rows.
    First every arc fills its own shard, then what is left goes clockwise."""
    room, used, taken, ranges = list(room), [0] * len(room), [0] * len(points), []

    def place(arc: int, shard: int) -> None:
        n = min(counts[arc] - taken[arc], room[shard])
        if n > 0:
            ranges.append((arc, taken[arc], taken[arc] + n, shard, used[shard]))
            taken[arc] += n
            used[shard] += n
            room[shard] -= n

    for arc, (_, shard) in enumerate(points):
        place(arc, shard)
    for arc in range(len(points)):
        at = arc
        while taken[arc] < counts[arc]:
            at = (at + 1) % len(points)
            place(arc, points[at][1])
    return ranges


def ring_shards(rows: DataFrame, key: str, shards: int, virtual: int = VIRTUAL,
                slack: float = 0.0) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to ``rows``.

    ``key`` decides the place on the ring; rows with equal or null keys share
    an arc and are still spread when it overflows.  Columns named like the
    added ones are replaced.  An empty table gives an empty result.
    """
    spark = rows.sparkSession
    points = ring_points(shards, virtual)
    edges = [p for p, _ in points]
    # the arc is found among the sorted edges by binary search: a lookup by
    # the hash's top bits gives the few arcs that can match
    bits = max(1, (len(points) - 1).bit_length() + 2)
    lookup = []
    for cell in range(1 << bits):
        low = (cell << (64 - bits)) - (1 << 63)
        high = low + (1 << (64 - bits)) - 1
        first, last = bisect.bisect_left(edges, low), bisect.bisect_left(edges, high)
        for arc in range(first, last + 1):
            start = edges[arc - 1] + 1 if arc > 0 else -(1 << 63)
            end = edges[arc] if arc < len(edges) else (1 << 63) - 1
            lookup.append((cell, max(start, low), min(end, high), arc % len(edges)))
    cells = spark.createDataFrame(lookup, "_cell int, _low long, _high long, _arc int")
    rows = rows.drop("shard", "slot")
    names = rows.columns
    hashed = rows.withColumn("_hash", F.xxhash64(F.col(key)))
    hashed = hashed.withColumn("_cell", F.shiftrightunsigned("_hash", 64 - bits)
                               .bitwiseXOR(F.lit(1 << (bits - 1))).cast("int"))
    placed = hashed.join(F.broadcast(cells), "_cell").where(
        F.col("_hash").between(F.col("_low"), F.col("_high")))
    placed = placed.select(*names, "_hash", "_arc")
    ranked = ranked_within(placed, ["_arc"], ["_hash", key], "_rank", "ring")

    counts = [0] * len(points)
    for r in ranked.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["_arc"]] = r["n"]
    ranges = walk(points, counts, capacities(sum(counts), shards, slack))
    cuts = spark.createDataFrame(ranges, "_a int, _from long, _to long, shard int, _slot long")
    found = ranked.join(F.broadcast(cuts), (F.col("_arc") == F.col("_a"))
                        & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    return found.select(*names, "shard",
                        (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, overhead: int = 16,
                    virtual: int = VIRTUAL, slack: float = 0.0) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row.

    Size is the text's UTF-8 bytes plus ``overhead``; null text counts as
    empty.  Rows with a null id are placed like any other.  The law is
    ``rows`` (counts at most one apart); ``grown_shard`` is null under it.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"))
    return ring_shards(rows, "doc_id", shards, virtual, slack).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
