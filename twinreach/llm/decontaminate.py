"""Benchmark decontamination by winnowing.

The fingerprint of a run of ``span`` words is the smallest hash among its
k-grams.  Every span that a document shares with an item has the same
smallest k-gram in both, so joining the two sides' fingerprints finds every
shared span; joined hits are then extended to their spans and compared word
by word.  Items shorter than the span are one span of their own length, and
are fingerprinted at that length.

What moves: the items' fingerprints become a bit map of a fixed size, sent
to the tasks that read the documents; a fingerprint outside of it is in no
item.  Only fingerprints inside are shuffled, with the few words around
them, so documents themselves are never shuffled.  A larger benchmark fills
the bit map and lets more rows through; the joins that follow stay exact.
Words are those runs of bytes that the contract's pattern names; hashing is
vectorised over the bytes of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.llm.common import numbered, stored, tidy
from twinreach.llm.words import ALNUM, Words, slices

SPAN = 10
BITMAP_BITS = 1 << 23
CHUNK = 32768  # bits of one piece of Spark's bitmap functions

def smallest(words: Words, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every run of ``span`` words in one text: its first word, the word
    where its smallest k-gram begins, and that k-gram's hash."""
    n = len(words.hash) - span + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    k = (span + 1) // 2
    h = words.grams(k)
    least, at = h[:n].copy(), np.arange(n)
    for j in range(1, span - k + 1):
        less = h[j:j + n] < least
        least[less] = h[j:j + n][less]
        at[less] = np.flatnonzero(less) + j
    whole = words.text[:n] == words.text[span - 1:span - 1 + n]
    return np.flatnonzero(whole), at[whole], least[whole]


OUT = "row long, id long, n_words long, fp long, span int, first long, runs int, words string"
_ARROW = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_words", pa.int64()),
                    ("fp", pa.int64()), ("span", pa.int32()), ("first", pa.int64()),
                    ("runs", pa.int32()), ("words", pa.string())])


def fingerprinted(lengths: list[int], bitmap: bytes | None, own_most: int | None = None):
    """Rows of OUT: one per text with its number of words, and one per run of
    spans with the same smallest k-gram, if the bit map has its hash.  With
    ``own_most`` (items) only spans of that length, or a shorter text's own."""
    bits = None if bitmap is None else np.frombuffer(bitmap, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            id_list = batch.column("id")
            for base, data, bounds in slices(batch.column("body")):
                words = Words(data, bounds, ALNUM)
                texts = len(bounds) - 1
                counts = np.bincount(words.text, minlength=texts)
                starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
                part = id_list.slice(base, texts)
                nothing = pa.nulls(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[base:base + texts]), part, pa.array(counts.astype(np.int64)),
                     *(nothing.cast(f.type) for f in list(_ARROW)[3:])], schema=_ARROW)
                found = {name: [] for name in _ARROW.names}
                for span in lengths:
                    first, at, fp = smallest(words, span)
                    keep = np.ones(len(fp), bool)
                    if own_most is not None:
                        keep &= np.minimum(counts[words.text[first]], own_most) == span
                    if bits is not None:
                        b = fp % np.uint64(BITMAP_BITS)
                        keep &= (bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    first, at, fp = first[keep], at[keep], fp[keep]
                    if not len(first):
                        continue
                    new = np.concatenate(([True], (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)))
                    heads = np.flatnonzero(new)
                    runs = np.diff(np.concatenate((heads, [len(first)])))
                    for f, r, v in zip(first[heads].tolist(), runs.tolist(),
                                       fp[heads].view(np.int64).tolist()):
                        t = int(words.text[f])
                        found["row"].append(int(rows[base + t]))
                        found["fp"].append(v)
                        found["span"].append(span)
                        found["first"].append(f - int(starts[t]))
                        found["runs"].append(r)
                        found["words"].append(words.joined(f, f + r - 1 + span))
                if found["row"]:
                    n = len(found["row"])
                    found["id"] = found["n_words"] = [None] * n
                    yield pa.RecordBatch.from_pydict(found, schema=_ARROW)

    return run


def _prepared(df: DataFrame, id_col: str, row: str | None = None) -> DataFrame:
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    return df.select(number.alias("row"), F.col(id_col).alias("id"),
                     F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))


def _spans(found: DataFrame) -> DataFrame:
    """Every span of the runs: row, first (word), span, words."""
    one = found.select("row", "span", F.col("first").alias("_first"),
                       F.split("words", " ").alias("_words"),
                       F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("_i"))
    return one.select("row", "span", (F.col("_first") + F.col("_i")).alias("first"),
                      F.array_join(F.slice("_words", F.col("_i") + 1, F.col("span")), " ")
                      .alias("words"))


def hits(docs: DataFrame, items: DataFrame, span: int = SPAN, row: str | None = None
         ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three stored tables: documents (row, id, n_words), verified spans (row,
    first, span, window) and the items of each window (window, item_id).
    ``row`` names a column of ``docs`` with unique longs to use as its row."""
    lengths = list(range(1, span + 1))
    bench = stored(_prepared(items, "item_id").mapInArrow(
        tidy(fingerprinted(lengths, None, span)), OUT), "items-fingerprints")
    item_ids = bench.where("fp is null").select("row", F.col("id").alias("item_id"))
    prints = bench.where("fp is not null")
    windows = _spans(prints)
    texts = numbered(windows.select("words").distinct(), "window", "item-windows")
    members = stored(windows.join(texts, "words").select("row", "window").distinct()
                     .join(item_ids, "row").select("window", "item_id"), "window-items")
    used = sorted(r["span"] for r in prints.select("span").distinct().collect())

    bit = F.expr(f"pmod(fp, {BITMAP_BITS})")  # the low bits, as in the tasks
    pieces = (prints.select("fp").distinct()
              .groupBy(F.floor(bit / CHUNK).cast("int").alias("piece"))
              .agg(F.bitmap_construct_agg((bit % CHUNK).cast("long")).alias("bits")))
    bitmap = bytearray(BITMAP_BITS // 8)  # at most 256 pieces of 4 KB
    for r in pieces.collect():
        bitmap[r["piece"] * (CHUNK // 8):(r["piece"] + 1) * (CHUNK // 8)] = r["bits"]

    found = stored(_prepared(docs, "doc_id", row).mapInArrow(
        tidy(fingerprinted(used, bytes(bitmap))), OUT), "document-fingerprints")
    documents = found.where("fp is null").select("row", "id", "n_words")
    joined = found.where("fp is not null").join(prints.select("fp").distinct(), "fp", "left_semi")
    verified = stored(_spans(joined).join(texts, "words")
                      .select("row", "first", "span", "window").distinct(), "document-hits")
    return documents, verified, members


def contaminated_rows(docs: DataFrame, items: DataFrame, row: str, span: int = SPAN) -> DataFrame:
    """The numbers, in column ``row`` of ``docs``, of its contaminated rows."""
    _, verified, _ = hits(docs, items, span, row)
    return verified.select(F.col("row").alias(row)).distinct()


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row
    of ``docs``.

    Null and empty texts have no words and no hits.  Repeated rows each get
    their own row.  An item counts once, by id; a null item id makes hits but
    is not listed.  Empty tables: no items means no hits, no documents no
    rows.  Other columns are not read.
    """
    documents, verified, members = hits(docs, items, span)
    before = Window.partitionBy("row").orderBy("first", "span").rowsBetween(
        Window.unboundedPreceding, -1)
    spans = verified.select("row", "first", "span").distinct()
    end = F.col("first") + F.col("span")
    covered = (spans.withColumn("_done", F.coalesce(F.max(end).over(before), F.lit(0)))
               .groupBy("row").agg(F.sum(F.greatest(
                   F.lit(0), end - F.greatest("first", "_done"))).alias("n_hit")))
    listed = (verified.select("row", "window").distinct().join(members, "window")
              .groupBy("row").agg(F.collect_set(F.col("item_id").cast("string")).alias("_items")))
    none = F.array().cast("array<string>")
    out = documents.join(covered, "row", "left").join(listed, "row", "left")
    ids = F.sort_array(F.coalesce("_items", none))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
