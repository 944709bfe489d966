"""Line de-duplication that returns bit maps instead of text.

Each document gives one row per distinct line key: a 128-bit hash, the
document and the key's positions.  These rows are range-partitioned by hash
with a secondary sort by document.  The sort key includes the document, so
the rows of one very frequent line spread over many partitions.  A sorted
partition is streamed: the first occurrences of a hash per document are
counted, and once a hash is in enough documents its rows go out as drops;
fewer than that many rows are ever held.  A hash at the edge of a partition
may go on in the next one: its rows, if undecided, and its count go out as
open, and are settled by adding up the counts (at most two per partition).

Drops are gathered per document into a compressed bit map of the lines that
stay.  Texts are read again only to apply the bit maps, without Python.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import stored, tidy

STRIP = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_DOCS = 10
MIN_CHARS = 1

_KEYS = "h1 long, h2 long, id long, text_hash long, lines binary, total int"
_KEYS_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()),
                         ("text_hash", pa.int64()), ("lines", pa.binary()), ("total", pa.int32())])


def keyed(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [], [], [], [], []
            ids, hashes = batch.column("id").to_pylist(), batch.column("text_hash").to_pylist()
            for doc, th, body in zip(ids, hashes, batch.column("body")):
                lines = body.as_py().split(b"\n")
                places: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    key = line.strip(STRIP).lower()
                    if len(key) >= min_chars and (
                            min_chars < 2 or len(key.decode("utf-8")) >= min_chars):
                        places.setdefault(key, []).append(i)
                for key, at in places.items():
                    out[0].append(hashlib.blake2b(key, digest_size=16).digest())
                    out[1].append(doc)
                    out[2].append(th)
                    out[3].append(np.array(at, "<u4").tobytes())
                    out[4].append(len(lines))
                if len(out[0]) >= 50_000:
                    yield _key_batch(out)
                    out = [], [], [], [], []
            if out[0]:
                yield _key_batch(out)

    return run


def _key_batch(out) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(out[0]), "<i8").reshape(-1, 2)
    return pa.RecordBatch.from_arrays(
        [pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
         pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
         pa.array(out[3], pa.binary()), pa.array(out[4], pa.int32())], schema=_KEYS_ARROW)


_MARKED = "kind int, n long, " + _KEYS
_MARKED_ARROW = pa.schema([("kind", pa.int32()), ("n", pa.int64()), *_KEYS_ARROW])
DROP, OPEN, COUNT = 0, 1, 2


def _marked(kind: int, rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows:
        yield from pa.Table.from_arrays(
            [pa.array(np.full(rows.num_rows, kind, np.int32)), pa.nulls(rows.num_rows, pa.int64()),
             *rows.columns], schema=_MARKED_ARROW).to_batches()


def _edge(h: tuple[int, int], held: pa.Table, seen: int) -> Iterator[pa.RecordBatch]:
    yield from _marked(OPEN, held)
    row = dict.fromkeys(_MARKED_ARROW.names) | {"kind": COUNT, "n": seen, "h1": h[0], "h2": h[1]}
    yield pa.RecordBatch.from_pylist([row], schema=_MARKED_ARROW)


def streamed(min_docs: int):
    """Over one sorted partition: drops, open rows and counts at its edges."""
    none = _KEYS_ARROW.empty_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # sort key of the last row
        held, seen = none, 0  # its hash's undecided rows and documents so far
        opening = True  # whether its hash is the partition's first
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]).cast(_KEYS_ARROW)
            keys = np.stack([rows.column(c).fill_null(0).to_numpy()
                             for c in ("h1", "h2", "id", "text_hash")]
                            + [rows.column("id").is_null().to_numpy().astype(np.int64)], axis=1)
            before = keys[:1] + 1 if last is None else last
            once = (keys != np.concatenate((before, keys[:-1]))).any(axis=1)
            if not once.any():
                continue  # repeated rows of one document
            goes_on = last is not None and (last[0, :2] == keys[once][0, :2]).all()
            if last is not None and not goes_on:
                if opening:
                    yield from _edge(tuple(last[0, :2].tolist()), held, seen)
                opening, held, seen = False, none, 0
            last = keys[-1:]
            keys = keys[once][:, :2]
            rows = pa.concat_tables([held, rows.filter(pa.array(once))])
            heads = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
            counts = np.diff(np.concatenate((heads, [len(keys)])))
            sizes = counts.copy()  # in rows: with those held
            sizes[0] += held.num_rows
            counts[0] += seen
            tail = int(sizes[:-1].sum())
            if len(heads) > 1:
                frequent = np.repeat(counts >= min_docs, sizes)[:tail]
                yield from _marked(DROP, rows.slice(0, tail).filter(pa.array(frequent)))
                if opening:
                    undecided = int(sizes[0]) if counts[0] < min_docs else 0
                    yield from _edge(tuple(keys[0].tolist()), rows.slice(0, undecided),
                                     int(counts[0]))
                    opening = False
            held, seen = rows.slice(tail), int(counts[-1])
            if seen >= min_docs:
                yield from _marked(DROP, held)
                held = none
        if last is not None:
            yield from _edge(tuple(last[0, :2].tolist()), held, seen)

    return run


_MAPS = "id long, text_hash long, n_lines long, n_dropped long, keep binary"
_WORDS = "id long, text_hash long, n_lines long, n_dropped long, keep array<long>"


def _mapped(pack, kind: pa.DataType):
    """A row per document from its lists of dropped lines; ``pack`` makes the
    column ``keep`` from an array with 1 for each line that stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dropped, keeps = [], []
            totals = batch.column("total").to_pylist()
            for total, lists in zip(totals, batch.column("lists")):
                stay = np.ones(total, np.uint8)
                stay[np.frombuffer(b"".join(lists.as_py()), "<u4")] = 0
                dropped.append(total - int(stay.sum()))
                keeps.append(pack(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(totals, pa.int64()),
                 pa.array(dropped, pa.int64()), pa.array(keeps, kind)],
                ["id", "text_hash", "n_lines", "n_dropped", "keep"])

    return run


def _compressed(stay: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(stay).tobytes(), 6)


def _longs(stay: np.ndarray) -> list[int]:
    """64 lines a number, for Spark's ``getbit``."""
    bits = np.zeros(-(-len(stay) // 64) * 64, np.uint8)
    bits[:len(stay)] = stay
    return np.packbits(bits, bitorder="little").view("<i8").tolist()


def stays(keep: bytes, total: int) -> np.ndarray:
    """The bit map as an array of 0 and 1 per line."""
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[:total]


def _text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
                 ) -> DataFrame:
    """``id, text_hash, n_lines, n_dropped, keep`` of the documents that lose
    a line; ``keep`` is a compressed bit per line.  A document is a pair of
    id and text, so an exactly repeated row is the same document."""
    return _dropped(docs, min_docs, min_chars).mapInArrow(_mapped(_compressed, pa.binary()), _MAPS)


def _dropped(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """``id, text_hash, total, lists`` (of dropped lines) per document."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").alias("id"), _text_hash(text).alias("text_hash"),
                       F.coalesce(text, F.lit("")).cast("binary").alias("body"))
    keys = rows.mapInArrow(tidy(keyed(min_chars)), _KEYS)
    order = ["h1", "h2", "id", "text_hash"]
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    marks = stored(placed.mapInArrow(tidy(streamed(min_docs)), _MARKED), "line-marks")
    settled = (marks.where(F.col("kind") == COUNT).groupBy("h1", "h2").agg(F.sum("n").alias("docs"))
               .where(F.col("docs") >= min_docs).select("h1", "h2"))
    late = marks.where(F.col("kind") == OPEN).join(settled, ["h1", "h2"], "left_semi")
    columns = ["id", "text_hash", "lines", "total"]
    drops = marks.where(F.col("kind") == DROP).select(columns).unionByName(late.select(columns))
    return drops.groupBy("id", "text_hash").agg(
        F.max("total").alias("total"), F.collect_list("lines").alias("lists"))


def _kept(text: Column, words: Column) -> Column:
    """The lines of ``text`` whose bit is set, joined again."""
    def stays_in(_, i):
        word = F.element_at(words, F.floor(i / 64).cast("int") + 1)
        return F.getbit(word, i % 64) == 1

    return F.array_join(F.filter(F.split(text, "\n"), stays_in), "\n")


def without_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS,
                           min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines removed from ``text``, and ``n_lines`` (before)
    and ``n_dropped`` added.

    A line's key is the line stripped of ASCII white-space, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines everywhere.  Null and empty texts are one
    empty line and stay as they are; every row comes back, with its other
    columns; columns named like the added ones are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    maps = stored(_dropped(docs, min_docs, min_chars).mapInArrow(
        tidy(_mapped(_longs, pa.list_(pa.int64()))), _WORDS), "line-maps")
    maps = maps.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"),
                       F.col("n_dropped").alias("_dropped"), F.col("keep").alias("_words"))
    # maps have no size bound, so they are not broadcast at any size
    joined = docs.join(maps.hint("merge"), docs["doc_id"].eqNullSafe(maps["_id"])
                       & (_text_hash(docs["text"]) == maps["_hash"]), "left")
    text = docs["text"]
    new = F.when(maps["_words"].isNotNull(), _kept(text, maps["_words"]))
    lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"))) + 1
    columns = [F.coalesce(new, text).alias(c) if c == "text" else docs[c] for c in docs.columns]
    return joined.select(*columns, F.coalesce(lines, F.lit(1)).cast("long").alias("n_lines"),
                         F.coalesce(maps["_dropped"], F.lit(0)).cast("long").alias("n_dropped"))


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` per row of ``docs``."""
    out = without_repeated_lines(docs.select("doc_id", "text"), min_docs, min_chars)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
