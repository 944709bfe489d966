"""Hard negatives by a vertical scan of embeddings (branch and bound on
decomposed data).

Rows are cut into blocks that are stored by dimension, with the least and
largest value of each dimension.  An anchor reads the dimensions of a block in
the order of its own magnitudes, largest first.  After some dimensions the
score of a row lies between its sum so far plus the least, and plus the
largest, that the dimensions not read can add.  Rows whose bounds rule them
out leave the candidate bitmap; the scan of a block ends when none is left or
all dimensions are read, and then the sums are the exact scores.

Two scans of all blocks are made:

1. *positives*: the best rows with the anchor's label;
2. *negatives*: for every positive of an anchor, the best rows of other labels
   whose scores lie in the positive's window.

Each task merges its blocks, so it sends at most k rows per anchor (or anchor
and positive) into the shuffle, where they are ranked.  Anchors are a stated
query set; they are taken in groups of a fixed number, which bounds what is
sent to the tasks, and each group scans the stored blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.llm.common import stored
from twinreach.session import scratch_path

BLOCK_ROWS = 8192
ANCHORS = 4096  # anchors of a group
STEP = 8  # dimensions read between two looks at the bounds
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # window of a negative's score, per cent of the positive's
# scaled components below this keep the scores of up to 2,048 of them in a long
MOST = 1 << 26

_PACKED = ("cells", "ids", "rows", "labels", "asked", "low", "high")
_KINDS = ("<i4", "<i8", "<i8", "<i8", "u1", "<i4", "<i4")
_READ = ("width", *_PACKED)
_BLOCK = "width int, " + ", ".join(f"{c} binary" for c in _PACKED)
_BLOCK_ARROW = pa.schema([("width", pa.int32()), *((c, pa.binary()) for c in _PACKED)])


def _block(cells: np.ndarray, ids, rows, labels, asked) -> pa.RecordBatch:
    """``cells`` is rows x width; it is stored by dimension."""
    raw = [cells.T, ids, rows, labels, asked, cells.min(axis=0), cells.max(axis=0)]
    return pa.RecordBatch.from_arrays(
        [pa.array([cells.shape[1]], pa.int32()),
         *(pa.array([np.ascontiguousarray(c).astype(k).tobytes()], pa.binary())
           for c, k in zip(raw, _KINDS))], schema=_BLOCK_ARROW)


def blocks_of(size: int):
    """Blocks of up to ``size`` rows of one width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            vec = batch.column("vec")
            flat = vec.flatten()
            real = flat.is_valid().to_numpy(zero_copy_only=False)
            value = np.floor(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
                             * SCALE)
            fits = real & (np.abs(value) < MOST)  # false for NaN and infinities
            widths = vec.value_lengths().to_numpy()
            begins = np.cumsum(widths) - widths
            bad = np.concatenate(([0], np.cumsum(~fits)))
            good = bad[begins + widths] == bad[begins]
            value = np.where(fits, value, 0).astype(np.int64)
            own = [batch.column(c).to_numpy() for c in ("vec_id", "row", "label", "asked")]
            for width in np.unique(widths[good]).tolist():
                some = np.flatnonzero(good & (widths == width))
                cells = value[begins[some][:, None] + np.arange(width)]
                parts = held.setdefault(width, [[], [], [], [], []])
                for part, new in zip(parts, (cells, *(c[some] for c in own))):
                    part.append(new)
                while sum(map(len, parts[1])) >= size:
                    whole = [np.concatenate(p) for p in parts]
                    yield _block(*(w[:size] for w in whole))
                    held[width] = parts = [[w[size:]] for w in whole]
        for width, parts in held.items():
            whole = [np.concatenate(p) for p in parts]
            if len(whole[1]):
                yield _block(*whole)

    return run


@dataclass
class Block:
    cells: np.ndarray  # width x rows
    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    asked: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, packed) -> Block:
        cells, ids, rows, labels, asked, low, high = (
            np.frombuffer(packed[c], k) for c, k in zip(_PACKED, _KINDS))
        return cls(cells.reshape(packed["width"], len(ids)), ids, rows, labels, asked,
                   low.astype(np.int64), high.astype(np.int64))

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int) -> Block:
        return cls.of({c: batch.column(c)[i].as_py() for c in _READ})


@dataclass
class Anchor:
    row: int
    vec_id: int
    label: int
    vector: np.ndarray
    positives: list  # (score, vec_id, row) of its positives, best first


def scanned(block: Block, vector: np.ndarray, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the rows of ``alive`` that stay.  ``keep(least,
    most)`` tells which rows stay, given the bounds of their scores; it must
    never refuse a row that is wanted.  A vector of another width counts as
    continued by zeros."""
    width = min(len(vector), len(block.cells))
    q = vector[:width]
    order = np.argsort(-np.abs(q), kind="stable")
    small, large = q * block.low[:width], q * block.high[:width]
    least, most = np.minimum(small, large)[order], np.maximum(small, large)[order]
    rest_least = np.concatenate((np.cumsum(least[::-1])[::-1], [0]))
    rest_most = np.concatenate((np.cumsum(most[::-1])[::-1], [0]))
    places = np.flatnonzero(alive)
    sums = np.zeros(len(places), np.int64)
    read = 0
    while len(places):
        stay = keep(sums + rest_least[read], sums + rest_most[read])
        if not stay.all():
            places, sums = places[stay], sums[stay]
        if read == width:
            break
        until = min(read + STEP, width)
        for d in order[read:until].tolist():
            cells = block.cells[d]
            sums = sums + q[d] * (cells if len(places) == len(cells) else cells[places])
        read = until
    return places, sums


class Best:
    """The best k rows seen so far, by score, then smaller id, then row."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.ids = self.rows = np.empty(0, np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score, ids, rows = (np.concatenate(c) for c in ((self.score, score), (self.ids, ids),
                                                        (self.rows, rows)))
        order = np.lexsort((rows, ids, -score))[:self.k]
        self.score, self.ids, self.rows = score[order], ids[order], rows[order]

    def floor(self) -> int | None:
        """A row with a smaller score is not among the best."""
        return int(self.score[-1]) if len(self.score) == self.k else None


def _kth(values: np.ndarray, k: int) -> int | None:
    return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else None


_LOWEST = np.iinfo(np.int64).min


def _floor(*known) -> int:
    return max((f for f in known if f is not None), default=_LOWEST)


def best_positives(block: Block, anchor: Anchor, best: Best) -> None:
    alive = (block.labels == anchor.label) & (block.rows != anchor.row)

    def keep(least, most):
        # k rows of the block surely reach ``need``
        need = _floor(best.floor(), _kth(least, best.k))
        return most >= need

    places, score = scanned(block, anchor.vector, alive, keep)
    if len(places):
        best.add(score, block.ids[places], block.rows[places])


def windows(anchor: Anchor, low: int, high: int) -> list[tuple[int, int]]:
    """Least and largest score that a negative of each positive may have."""
    return [(-(-low * p // 100), high * p // 100) for p, _, _ in anchor.positives]


def best_negatives(block: Block, anchor: Anchor, bests: list[Best], low: int, high: int) -> None:
    bounds = windows(anchor, low, high)
    alive = block.labels != anchor.label

    def keep(least, most):
        wanted = np.zeros(len(least), bool)
        for (a, b), best in zip(bounds, bests):
            surely = least[(least >= a) & (most <= b)]
            need = max(a, _floor(best.floor(), _kth(surely, best.k)))
            wanted |= (most >= need) & (least <= b)
        return wanted

    if all(a > b for a, b in bounds):
        return
    places, score = scanned(block, anchor.vector, alive, keep)
    for (a, b), best in zip(bounds, bests):
        inside = (score >= a) & (score <= b)
        floor = best.floor()
        if floor is not None:
            inside &= score >= floor
        if inside.any():
            best.add(score[inside], block.ids[places[inside]], block.rows[places[inside]])


_FOUND = ("anchor_row long, place int, anchor_id long, positive_id long, positive_score long, "
          "score long, vec_id long, row long")
_NAMES = [c.split()[0] for c in _FOUND.split(", ")]


def _found(anchor: Anchor, place: int, best: Best) -> pa.RecordBatch:
    score, positive, _ = anchor.positives[place] if anchor.positives else (0, 0, 0)
    n = len(best.score)
    same = [pa.array(np.full(n, v)) for v in (anchor.vec_id, positive, score)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, anchor.row)), pa.array(np.full(n, place, np.int32)), *same,
         pa.array(best.score), pa.array(best.ids), pa.array(best.rows)], _NAMES)


def searched(anchors: list[Anchor], k: int, window: tuple[int, int] | None):
    """Best rows of the task's blocks, per anchor (or anchor and positive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bests = [[Best(k) for _ in (a.positives if window else [None])] for a in anchors]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block.read(batch, i)
                for anchor, own in zip(anchors, bests):
                    if window:
                        best_negatives(block, anchor, own, *window)
                    else:
                        best_positives(block, anchor, own[0])
        for anchor, own in zip(anchors, bests):
            for place, best in enumerate(own):
                if len(best.score):
                    yield _found(anchor, place, best)

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of all tasks, ``rank`` from 1."""
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def only_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each block, as a block."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = Block.read(batch, i)
            some = np.flatnonzero(block.asked)
            if len(some):
                yield _block(block.cells.T[some], block.ids[some], block.rows[some],
                             block.labels[some], block.asked[some])


def _groups(asked: DataFrame, size: int) -> Iterator[list[Anchor]]:
    """The anchors, ``size`` at a time; the driver holds one group."""
    held: list[Anchor] = []
    for packed in asked.toLocalIterator(prefetchPartitions=False):
        block = Block.of(packed)
        held += [Anchor(int(block.rows[i]), int(block.ids[i]), int(block.labels[i]),
                        block.cells[:, i].astype(np.int64), []) for i in range(len(block.ids))]
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held:
        yield held


_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")


def hard_negatives(vectors: DataFrame, is_anchor, label=None, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, window: tuple[int, int] = (LOW, HIGH),
                   block_rows: int = BLOCK_ROWS, group: int = ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` from ``vectors`` (vec_id, embedding, label).

    ``is_anchor`` is a condition on the columns of ``vectors``, ``label`` the
    label to use (by default the column).  A row takes no part when its id,
    label or vector is null or a component is null, not finite, or 2^18 and
    more in magnitude (a score might not fit a long).  Vectors of different
    widths are compared as if the shorter one went on with zeros.  Repeated
    rows, and rows that share an id, are rows of their own: each is an anchor,
    a positive and a negative.  An anchor without another row of its label, or
    a positive without a row in its window, gives no row.  Other columns are
    not read.
    """
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col("embedding").alias("vec"),
        F.coalesce(is_anchor, F.lit(False)).cast("int").alias("asked"),
        F.monotonically_increasing_id().alias("row"))
    rows = rows.where("vec_id is not null and label is not null and vec is not null")
    blocks = stored(rows.mapInArrow(blocks_of(block_rows), _BLOCK), "bond-blocks")
    asked = stored(blocks.mapInArrow(only_anchors, _BLOCK), "bond-anchors")
    path = scratch_path(spark, "bond-found")
    for anchors in _groups(asked, group):
        by_row = {a.row: a for a in anchors}
        best = blocks.select(*_READ).mapInArrow(searched(anchors, positives, None), _FOUND)
        # at most ``group`` times ``positives`` rows
        for r in _ranked(best, positives).orderBy("anchor_row", "rank").collect():
            by_row[r["anchor_row"]].positives.append((r["score"], r["vec_id"], r["row"]))
        some = [a for a in anchors if a.positives]
        best = blocks.select(*_READ).mapInArrow(searched(some, negatives, window), _FOUND)
        (_ranked(best, negatives)
         .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score"))
         .write.mode("append").parquet(path))
    try:
        return spark.read.schema(_RESULT).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # no anchors at all
            raise
        return spark.createDataFrame([], _RESULT)


def mined(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth id; each seventh id has its label
    moved on by one of ten first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(embeddings, F.col("vec_id") % 100 == 0, moved)
