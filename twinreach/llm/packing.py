"""Packing into token sequences by cutting-stock column generation.

Every document is encoded once, in the task that reads it, and cut into full
sequences and one remainder; checksums of the pieces are taken there, so no
ids are ever moved.  The remainders are packed:

1. their lengths are counted in classes of ``grain`` tokens, and the
   histogram (a fixed number of counts) goes to the driver;
2. a linear program over patterns (how many pieces of each class share a
   sequence) is solved by column generation: a knapsack dynamic program
   prices the next pattern until none improves;
3. pattern counts are rounded down, and what is left is filled by further
   patterns, largest classes first;
4. remainders are ranked inside their class by a distributed sort; a pattern
   owns ranges of ranks, so every piece finds its sequence by a lookup in
   the pattern table, whose size depends on the number of classes alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.llm.common import numbered, ranked_within, tidy
from twinreach.llm.token_counts import PieceEncoder, vocabulary

CAPACITY = 2048
GRAIN = 8
END_ID = 1

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PIECES_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                           ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])


def cut_pieces(raw: bytes, capacity: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PieceEncoder(raw, keep_ids=True)
        step = 4 * capacity
        for batch in batches:
            docs = iter(batch.column("doc_id").to_pylist())
            out = [], [], [], [], []
            for texts, words, sizes, begins in encode(batch.column("body")):
                before = np.cumsum(sizes) - sizes
                places = np.repeat(begins - before, sizes) + np.arange(int(sizes.sum()))
                ids = encode.ids[places].astype("<u4")
                per_text = np.bincount(words.text, sizes, texts).astype(np.int64) * 4
                raw_ids, begin = ids.tobytes(), 0
                for n in per_text.tolist():
                    own = raw_ids[begin:begin + n] + end
                    begin += n
                    doc = next(docs)
                    for at in range(0, len(own), step):
                        piece = own[at:at + step]
                        for c, v in zip(out, (doc, at // 4, len(piece) // 4, zlib.crc32(piece),
                                              len(own) // 4)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                             schema=_PIECES_ARROW)

    return run


def knapsack(sizes: np.ndarray, values: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Most valuable multiset of sizes that fits: (value, count per size)."""
    best = np.zeros(room + 1)
    last = np.full(room + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes, values = sizes[order], values[order]
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        k = int(np.searchsorted(sizes, w, side="right"))
        if k:
            total = best[w - sizes[:k]] + values[:k]
            j = int(total.argmax())
            if total[j] > best[w] + 1e-12:
                best[w], last[w] = total[j], j
    counts, w = np.zeros(len(sizes), np.int64), room
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            counts[order[last[w]]] += 1
            w -= sizes[last[w]]
    return float(best[room]), counts


def patterns(sizes: np.ndarray, demand: np.ndarray, room: int, tolerance: float = 1e-3,
             most: int = 5000) -> list[tuple[np.ndarray, int]]:
    """(pieces per class, copies): whole patterns that use up the demand."""
    m = len(sizes)
    if m == 0:
        return []
    # a basis of one pattern per class; columns enter by the knapsack's price
    basis = np.diag(room // sizes).astype(float)
    inverse = np.diag(1.0 / (room // sizes))
    x = inverse @ demand
    least = float(sizes @ demand) / room
    for _ in range(most):
        value, column = knapsack(sizes, inverse.sum(axis=0), room)
        used = float(x.sum())
        # no set of patterns needs fewer sequences than used / value, or than
        # the tokens fill; what is left to gain is below one in a thousand
        if used - max(used / value, least) <= 0.5 + used * tolerance or value <= 1 + 1e-9:
            break
        direction = inverse @ column
        up = direction > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        out = int(ratio.argmin())
        x = x - ratio[out] * direction
        x[out] = ratio[out]
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(direction[others], inverse[out])
        basis[:, out] = column
    left = demand.astype(np.int64).copy()
    found: list[tuple[np.ndarray, int]] = []

    def use(column: np.ndarray, copies: int) -> None:
        some = column > 0
        copies = min(copies, int((left[some] // column[some]).min()))
        if copies > 0:
            left[some] -= copies * column[some]
            found.append((column.copy(), copies))

    for i in np.argsort(-x):
        use(basis[:, i].astype(np.int64), int(np.floor(x[i] + 1e-9)))
    order = np.argsort(-sizes)
    while left.any():
        column, w = np.zeros(m, np.int64), room
        for i in order:
            column[i] = min(left[i], w // sizes[i])
            w -= column[i] * sizes[i]
        use(column, int(left.max()))
    return found


def packed(pieces: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (with ``length``, at
    most ``capacity``).  Pieces of a sequence lie gapless from 0, longest
    first.  An empty table gives an empty result."""
    if capacity % grain:
        raise ValueError("the grain must divide the capacity")
    columns = pieces.columns
    known = numbered(pieces, "_piece", "pack-pieces")
    rest = known.where(F.col("length") < capacity).withColumn(
        "_class", F.ceil(F.col("length") / grain).cast("int"))
    ranked = ranked_within(rest, ["_class"], ["length", "_piece"], "_rank", "pack-ranks")
    counts = {r["_class"]: r["n"] for r in
              ranked.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = np.array(sorted(counts), np.int64)
    plan = patterns(sizes, np.array([counts[c] for c in sizes.tolist()], np.int64),
                    capacity // grain)
    cuts, used, sequences = [], dict.fromkeys(sizes.tolist(), 0), 0
    for column, copies in plan:
        for c, a in zip(sizes.tolist(), column.tolist()):
            if a:
                cuts.append((c, used[c], used[c] + a * copies, sequences, copies))
                used[c] += a * copies
        sequences += copies
    table = pieces.sparkSession.createDataFrame(
        cuts, "_c int, _from long, _to long, _first long, _copies long")
    # the table has a row per pattern and class, whatever the number of pieces
    placed = ranked.join(F.broadcast(table), (F.col("_class") == F.col("_c"))
                         & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    placed = placed.withColumn("sequence_id", F.col("_first")
                               + (F.col("_rank") - F.col("_from")) % F.col("_copies"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_piece").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    full = known.where(F.col("length") >= capacity).select(
        *columns, (F.col("_piece") + F.lit(sequences)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return full.unionByName(placed.select(*columns, "sequence_id", "offset"))


def pack_documents(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY,
                   grain: int = GRAIN, end_id: int = END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``
    per piece.

    A document's ids end with ``end_id``; a null or empty text has only that
    one.  Each id lies in exactly one piece.  Repeated rows are packed as
    often as they occur; a null id stays null.  Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    pieces = rows.mapInArrow(tidy(cut_pieces(vocabulary(vocabulary_path), capacity, end_id)), _PIECES)
    return packed(pieces, capacity, grain)
