"""Similarity join of documents on their sets of word n-grams.

Two documents link when the Jaccard similarity of their sets reaches the
threshold; the result is the connected components of the links.

1. *Sets.*  Per document: size and a 128-bit digest of the set, and counts of
   all n-grams in a fixed number of hash buckets.  Documents with equal sets
   become one node, so a group of copies makes no pairs.
2. *Rare-first prefix.*  n-grams are ordered by (count of the bucket, hash),
   after them those that stand in many sets, by their own counts: each task
   names the most frequent of what it read, and the names' counts are added
   up.  A set of n needs one of its first n - ceil(t n) + 1 n-grams in common
   with any set it links to.  These prefixes are shuffled by n-gram, as packed
   arrays; postings that can belong to a candidate pair are written out.
3. *Pairs.*  Two nodes that share a prefix n-gram are a candidate pair if their
   sizes allow the threshold (length filter), so many n-grams can follow
   the shared one in both (positional filter) and 256 parities of their
   n-grams do not differ too often.  Pairs are not listed per
   group: in a star round the nodes of an n-gram are paired with its hubs,
   the smallest node at first, then some drawn by each n-gram; links found join components; and nodes already in one component
   need no pair.  After the star rounds a last
   round takes every candidate pair between different components, so no link
   between components is missed.
4. *Verification*, once per pair.  A suffix filter compares how many n-grams
   the two sets have in ranges of hashes, more of them for a larger set; only
   pairs it cannot rule out bring their texts together, whose sets are made
   again for the exact intersection.  Texts are
   shuffled for the nodes of such pairs only: a bit map of fixed size
   keeps most of the others back.

Components are found with large-star and small-star steps over the links.
Only counts (of buckets and of frequent n-grams, fixed numbers) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import has_rows, stored, tidy
from twinreach.llm.words import NONBLANK, STEP, Words, mix, slices

NGRAM = 5
THRESHOLD = 75  # per cent
BUCKET_BITS = 16
POSTINGS_PER_PART = 250_000
STAR_ROUNDS = 3
HUBS = (1, 8, 16)  # of an n-gram, by round
# frequent n-grams: read at once, named of these at most, and kept of all names
COUNTED, NAMED, FREQUENT = 1 << 21, 1 << 14, 1 << 17
LIVING_BITS = 1 << 25


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, sizes, text numbers, n-grams): distinct n-grams of each
    text, sorted by text and value; a shorter text is one n-gram."""
    for base, data, bounds in slices(column):
        words = Words(data, bounds, NONBLANK)
        texts = len(bounds) - 1
        counts = np.bincount(words.text, minlength=texts)
        grams = words.grams(n)
        whole = words.text[:len(grams)] == words.text[n - 1:n - 1 + len(grams)]
        text, gram = words.text[:len(grams)][whole], grams[whole]
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
            own = [mix((words.hash[s:s + c] * STEP[:c]).sum(dtype=np.uint64, keepdims=True)
                       + np.uint64(c)) for s, c in zip(starts[short], counts[short])]
            text, gram = np.concatenate((text, short)), np.concatenate((gram, *own))
        order = np.lexsort((gram, text))
        text, gram = text[order], gram[order]
        if len(gram):
            new = np.concatenate(([True], (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])))
            text, gram = text[new], gram[new]
        yield base, np.bincount(text, minlength=texts), text, gram


def _digests(sizes: np.ndarray, text: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Two independent sums of hashes per text; equal for equal sets."""
    out = np.zeros((len(sizes), 2), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        first = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        out[full, 0] = np.add.reduceat(mix(gram ^ STEP[7]), first)
        out[full, 1] = np.add.reduceat(mix(gram * STEP[8] + STEP[9]), first)
    return out.view(np.int64)


SIGNED = ("s1", "s2", "s3", "s4")
_SETS = ("row long, id long, n int, d1 long, d2 long, s1 long, s2 long, s3 long, s4 long, "
         "ranges binary, bucket int, gram long, count long")
_SETS_ARROW = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n", pa.int32()),
                         ("d1", pa.int64()), ("d2", pa.int64()),
                         *((s, pa.int64()) for s in SIGNED), ("ranges", pa.binary()),
                         ("bucket", pa.int32()),
                         ("gram", pa.int64()), ("count", pa.int64())])


def _parities(texts: int, text: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Per text 256 bits: whether a count of n-grams with one byte is odd.
    Bits that differ between two texts never outnumber the n-grams that do."""
    odd = np.bincount(text * 256 + (gram >> np.uint64(8) & np.uint64(0xFF)).astype(np.int64),
                      minlength=texts * 256).reshape(-1, 256) & 1
    return np.packbits(odd.astype(np.uint8), axis=1).view("<i8")


RANGES, PER_RANGE = 256, 4


def _ranges(sizes: np.ndarray, gram: np.ndarray) -> list[bytes]:
    """Per text, how many n-grams it has in each of some ranges of hashes, a
    byte each: RANGES, doubled while one would hold more than PER_RANGE on the
    average.  Nothing if a count does not fit: the text is never ruled out."""
    out = []
    edges = np.concatenate(([0], np.cumsum(sizes))).tolist()
    for a, b in zip(edges, edges[1:]):
        bits = (RANGES - 1).bit_length()
        while b - a > PER_RANGE << bits:
            bits += 1
        counts = np.bincount((gram[a:b] >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        out.append(b"" if counts.max() > 0xFF else counts.astype(np.uint8).tobytes())
    return out


class Seen:
    """Sets met in a task: copies of one are told by size and digest."""

    def __init__(self):
        self.keys: set[tuple] = set()

    def fresh(self, sizes: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """Which sets are not empty and were not met before."""
        out = np.zeros(len(sizes), bool)
        for i, (d, size) in enumerate(zip(digests.tolist(), sizes.tolist())):
            key = (size, *d)
            if size and key not in self.keys:
                self.keys.add(key)
                out[i] = True
        return out


def _named(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent of the n-grams, at least twice there, with counts."""
    gram, count = np.unique(np.concatenate(grams), return_counts=True)
    gram, count = gram[count > 1], count[count > 1]
    if len(gram) > NAMED:
        top = np.argpartition(-count, NAMED)[:NAMED]
        gram, count = gram[top], count[top]
    return gram, count


def measured(ngram: int):
    def rows(**columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(size, f.type)) for f in _SETS_ARROW], schema=_SETS_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        seen, held, size = Seen(), [], 0

        def name() -> pa.RecordBatch:
            gram, count = _named(held)
            return rows(gram=pa.array(gram.view(np.int64)), count=pa.array(count))

        for batch in batches:
            for base, sizes, text, gram in _sets(batch.column("body"), ngram):
                d = _digests(sizes, text, gram)
                all_, gram = gram, gram[seen.fresh(sizes, d)[text]]
                total += np.bincount((gram >> np.uint64(64 - BUCKET_BITS)).astype(np.int64),
                                     minlength=len(total))
                held.append(gram)
                size += len(gram)
                if size >= COUNTED:
                    yield name()
                    held, size = [], 0
                k, signed = len(sizes), _parities(len(sizes), text, all_)
                yield rows(row=batch.column("row").slice(base, k), id=batch.column("id").slice(base, k),
                           n=pa.array(sizes.astype(np.int32)), d1=pa.array(d[:, 0].copy()),
                           d2=pa.array(d[:, 1].copy()),
                           ranges=pa.array(_ranges(sizes, all_), pa.binary()),
                           **{s: pa.array(signed[:, i].copy()) for i, s in enumerate(SIGNED)})
        if size:
            yield name()
        some = np.flatnonzero(total)
        yield rows(bucket=pa.array(some.astype(np.int32)), count=pa.array(total[some]))

    return run


_PACKED = "part int, grams binary, ids binary, sizes binary, places binary"
_PACKED_ARROW = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("ids", pa.binary()),
                           ("sizes", pa.binary()), ("places", pa.binary())])


@dataclass
class Rarity:
    """The order of n-grams: by ``rank`` of the bucket, then the frequent ones
    (sorted) by their counts."""

    rank: np.ndarray
    grams: np.ndarray
    counts: np.ndarray

    def __call__(self, gram: np.ndarray) -> np.ndarray:
        out = self.rank[(gram >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, gram), len(self.grams) - 1)
            out = np.where(self.grams[at] == gram, len(self.rank) + self.counts[at], out)
        return out


def rarity(sets: DataFrame) -> Rarity:
    """From the counts of all tasks; at most FREQUENT n-grams are kept, those
    from the lowest power of two on at which they fit."""
    named = (sets.where("gram is not null").groupBy("gram").agg(F.sum("count").alias("n"))
             .withColumn("level", F.floor(F.log2("n")).cast("int")))
    named = stored(named, "gram-frequent")
    sizes = np.zeros(65, np.int64)
    for r in named.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["level"]] = r["n"]
    least = int(np.flatnonzero(sizes[::-1].cumsum()[::-1] <= FREQUENT)[0])
    top = named.where(F.col("level") >= least).select("gram", "n").toArrow()
    grams = top.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, often = grams[order], top.column("n").to_numpy()[order]
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in (sets.where("bucket is not null").groupBy("bucket").agg(F.sum("count").alias("n"))
              .toLocalIterator()):
        counts[r["bucket"]] = r["n"]
    # what stands apart does not make its bucket frequent
    np.subtract.at(counts, (grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), often)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    return Rarity(rank, grams, often)


def prefixes(ngram: int, threshold: int, rare: Rarity, parts: int):
    """Packed postings of the prefixes, an array per part and batch.  A set
    seen before in the task is left out: its copies are the same node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            ids_all = batch.column("id").to_numpy(zero_copy_only=False)
            found = []
            for base, sizes, text, gram in _sets(batch.column("body"), ngram):
                fresh = seen.fresh(sizes, _digests(sizes, text, gram))
                keep = fresh[text]
                text, gram = text[keep], gram[keep]
                order = np.lexsort((gram, rare(gram), text))
                text, gram = text[order], gram[order]
                size = np.where(fresh, sizes, 0)
                first = np.concatenate(([0], np.cumsum(size)[:-1]))
                place = np.arange(len(gram)) - first[text]
                length = size - (size * threshold + 99) // 100 + 1
                head = place < length[text]
                found.append((gram[head], ids_all[base + text[head]], size[text[head]], place[head]))
            gram, ids, size, place = (np.concatenate(x) for x in zip(*found))
            part = ((gram >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            columns = [(gram & np.uint64(0xFFFFFFFF)).astype("<u4")[order], ids.astype("<i8")[order],
                       size.astype("<u4")[order], place.astype("<u4")[order]]
            some = np.flatnonzero(np.diff(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)),
                 *(pa.array([c[edges[p]:edges[p + 1]].tobytes() for p in some.tolist()], pa.binary())
                   for c in columns)], schema=_PACKED_ARROW)

    return run


_SHARED = "gram long, id long, n int, pos int"


def possible(n, pos, m, at, threshold: int):
    """Length and positional filter of two postings of one n-gram: their
    sizes may differ so much, and enough n-grams can follow in both."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    most = np.minimum(n - pos, m - at)
    return (100 * small >= threshold * large) & ((100 + threshold) * most >= threshold * (n + m))


def shared(threshold: int, near: int = 64):
    """Of rows sorted by part: postings that can belong to a candidate pair.
    Each is held against the others of its n-gram; postings of an n-gram with
    more than ``near`` are all kept."""
    kinds = ("<u4", "<i8", "<u4", "<u4")

    def close(part: int, held) -> pa.RecordBatch:
        gram, ids, size, place = (np.frombuffer(b"".join(c), k).astype(np.int64)
                                  for c, k in zip(held, kinds))
        order = np.lexsort((ids, gram))
        gram, ids, size, place = gram[order], ids[order], size[order], place[order]
        edges = np.concatenate(([0], np.flatnonzero(gram[1:] != gram[:-1]) + 1, [len(gram)]))
        many = np.repeat(np.diff(edges), np.diff(edges))
        keep = (many > near) & np.repeat(ids[edges[:-1]] != ids[edges[1:] - 1], np.diff(edges))
        open_ = np.flatnonzero((many > 1) & (many <= near))
        for step in range(1, near):
            i = open_[open_ + step < len(gram)]
            i = i[gram[i + step] == gram[i]]
            if not len(i):
                break
            j = i + step
            pair = (ids[i] != ids[j]) & possible(size[i], place[i], size[j], place[j], threshold)
            keep[i[pair]] = keep[j[pair]] = True
        name = (np.int64(part) << np.int64(32)) | gram[keep]
        return pa.RecordBatch.from_arrays(
            [pa.array(name), pa.array(ids[keep]), pa.array(size[keep].astype(np.int32)),
             pa.array(place[keep].astype(np.int32))], ["gram", "id", "n", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, ([], [], [], [])
        for batch in batches:
            for i, p in enumerate(batch.column("part").to_pylist()):
                if part is not None and p != part:
                    yield close(part, held)
                    held = ([], [], [], [])
                part = p
                for c, name in zip(held, ("grams", "ids", "sizes", "places")):
                    c.append(batch.column(name)[i].as_py())
        if part is not None:
            yield close(part, held)

    return run


def collected(ngram: int):
    """The texts whose sets have the given digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, sizes, text, gram in _sets(batch.column("body"), ngram):
                d = _digests(sizes, text, gram)
                own = [batch.column(c).slice(base, len(sizes)).to_numpy() for c in ("d1", "d2")]
                same = pa.array((d[:, 0] == own[0]) & (d[:, 1] == own[1]))
                yield batch.select(["rep", "body"]).slice(base, len(sizes)).filter(same)

    return run


def _least_shared(m: np.ndarray, n: np.ndarray, threshold: int) -> np.ndarray:
    return -(-threshold * (m + n) // (100 + threshold))


def _most_shared(x: bytes, y: bytes) -> int:
    """N-grams that two sets can share at most, by their ranges; the finer
    ranges of one are added up to those of the other."""
    u, v = (np.frombuffer(c, np.uint8).astype(np.int64) for c in (x, y))
    k = min(len(u), len(v))
    return int(np.minimum(u.reshape(k, -1).sum(axis=1), v.reshape(k, -1).sum(axis=1)).sum())


def plausible(threshold: int):
    """Suffix filter: pairs that can share enough n-grams in all ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (batch.column(c).to_numpy().astype(np.int64) for c in ("m", "n"))
            keep = [not x or not y or _most_shared(x, y) >= least for x, y, least in zip(
                batch.column("x").to_pylist(), batch.column("y").to_pylist(),
                _least_shared(m, n, threshold).tolist())]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def verified(ngram: int, threshold: int):
    """Pairs of texts whose sets are similar enough."""

    def grams(column: pa.Array) -> Iterator[np.ndarray]:
        for _, sizes, _, gram in _sets(column, ngram):
            yield from np.split(gram, np.cumsum(sizes)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for s, t in zip(grams(batch.column("x")), grams(batch.column("y"))):
                both = len(np.intersect1d(s, t, assume_unique=True))
                links.append(both >= _least_shared(len(s), len(t), threshold))
            keep = pa.array(links, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def components(links: DataFrame) -> DataFrame:
    """``rep, comp``: the smallest node reachable, for every node of ``links``
    (a, b); large-star and small-star steps until nothing changes."""
    edges = stored(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                   .where("u <> v").distinct(), "cc-edges")

    def mark(df):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))
                   .alias("h")).first()
        return r["n"], r["h"]

    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        # every larger neighbour of v is hung on v's smallest neighbour
        large = (both.where("u > v").join(least, "v").select(F.col("u").alias("v"),
                                                             F.col("m").alias("u")).distinct())
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").where("u <> m").select(
            F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.unionByName(least.select("v", F.col("m").alias("u")))
        edges = stored(small.where("u <> v").distinct(), "cc-edges")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("v").alias("rep")).agg(F.min("u").alias("comp"))


def _other(column: str) -> str:
    """The column of the other posting of a pair."""
    return f"other_{column}"


def _possible(threshold: int):
    """Length, positional and parity filter of two postings of one n-gram."""
    n, m = F.col("n"), F.col(_other("n"))
    most = F.least(n - F.col("pos"), m - F.col(_other("pos")))
    differ = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(_other(s)))) for s in SIGNED), F.lit(0))
    return ((100 * F.least(n, m) >= threshold * F.greatest(n, m))
            & ((100 + threshold) * most >= threshold * (n + m))
            & ((100 + threshold) * differ <= (100 - threshold) * (n + m)))


def _pair(x: str, y: str):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def living(source: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``source`` (id, ...) whose id can be among ``nodes`` (rep):
    all that are, and some that share a bit with one."""
    def place(column: str):
        return F.xxhash64(column).bitwiseAND(F.lit(LIVING_BITS - 1))

    bits = (nodes.select(place("rep").alias("place"))
            .select(F.shiftright("place", 6).alias("word"),
                    F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    at = source.withColumn("place", place("id"))
    # LIVING_BITS / 64 rows of two numbers at most
    return (at.join(F.broadcast(bits), F.shiftright("place", 6) == F.col("word"))
            .where(F.expr("getbit(bits, cast(place & 63 as int)) = 1")).select(source.columns))


def linked_nodes(docs: DataFrame, ngram: int = NGRAM, threshold: int = THRESHOLD,
                 star_rounds: int = STAR_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(rows, labels): a row (row, id, n, rep) per row of ``docs``, ``rep``
    being the smallest id with the same set (null for an empty set or a null
    id); and (rep, comp) of the nodes that have a link."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")
    source = docs.select(F.col("doc_id").alias("id"), body)
    sets = stored(source.withColumn("row", F.monotonically_increasing_id())
                  .mapInArrow(tidy(measured(ngram)), _SETS), "gram-sets")
    rows = sets.where("row is not null").select("row", "id", "n", "d1", "d2", *SIGNED, "ranges")
    full = rows.where("n > 0 and id is not null")
    reps = full.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep"), *[F.first(s).alias(s) for s in SIGNED])
    reps = stored(reps, "gram-nodes")
    nodes = stored(rows.drop("ranges").join(reps.withColumnRenamed("n", "m").withColumnRenamed("d1", "e1")
                             .withColumnRenamed("d2", "e2").drop(*SIGNED),
                             (F.col("n") == F.col("m")) & (F.col("d1") == F.col("e1"))
                             & (F.col("d2") == F.col("e2")) & F.col("id").isNotNull(), "left")
                   .select("row", "id", "n", "rep"), "gram-rows")

    rare = rarity(sets)
    most = (full.agg(F.sum("n")).first()[0] or 0) * (100 - threshold) // 100
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), most // POSTINGS_PER_PART)

    packed = source.where("id is not null").mapInArrow(
        tidy(prefixes(ngram, threshold, rare, parts)), _PACKED)
    found = stored(packed.repartition("part").sortWithinPartitions("part")
                   .mapInArrow(tidy(shared(threshold)), _SHARED), "gram-postings")
    # ids to nodes; copies in different tasks meet here
    known = nodes.where("rep is not null").select("id", "n", "rep").distinct()
    found = found.join(known, ["id", "n"]).select("gram", "rep", "n", "pos").distinct()
    postings = stored(found, "gram-node-postings")

    alive = postings.select("rep").distinct()
    # a repeated id can stand beside other sets; the node's own is kept
    own = stored(reps.join(alive, "rep", "left_semi").select("rep", "d1", "d2", *SIGNED), "gram-alive")
    # a node of several sets brings the bits of each
    postings = postings.join(own.select("rep", *SIGNED).hint("merge"), "rep")
    # nodes have no size bound, so they are not broadcast at any size
    digest = own.select("rep", F.col("d1").alias("e1"), F.col("d2").alias("e2"))
    ranges = (living(full.select("id", "n", "d1", "d2", "ranges"), own)
              .join(digest.hint("merge"), F.col("id") == F.col("rep"))
              .where("d1 = e1 and d2 = e2").groupBy("rep")
              .agg(F.first("n").alias("n"), F.first("ranges").alias("ranges")))
    ranges = stored(ranges, "gram-ranges")

    # an id with several sets is one document: its sets are linked
    several = nodes.where("rep is not null").groupBy("id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("id", "a")
    links = stored(nodes.join(several, "id").select("a", F.col("rep").alias("b"))
                   .where("a <> b").distinct(), "gram-links")
    labels = components(links)
    tried = None
    for step in range(star_rounds + 1):
        pairs, mixed, held = _candidates(postings, labels, threshold, step, last=step == star_rounds)
        if step < star_rounds:
            # components only grow, so an n-gram within one never gives a pair again
            # and of two nodes the first round has taken the only pair
            left = mixed.where("nodes > 2") if step == 0 else mixed
            postings = held.join(left.select("gram"), "gram", "left_semi").drop("comp")
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs.distinct(), "gram-pairs")
        if not has_rows(pairs):
            if step == star_rounds:
                break
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        small = (pairs.join(ranges.select(F.col("rep").alias("a"), F.col("ranges").alias("x"),
                                          F.col("n").alias("m")), "a")
                 .join(ranges.select(F.col("rep").alias("b"), F.col("ranges").alias("y"), "n"), "b"))
        likely = stored(small.select("a", "b", "x", "y", "m", "n").mapInArrow(
            tidy(plausible(threshold)), "a long, b long"), "gram-likely")
        if not has_rows(likely):
            continue
        # only the texts of these pairs are shuffled
        used = likely.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        used = stored(own.select("rep", "d1", "d2").join(used, "rep", "left_semi"), "gram-used")
        texts = (living(source, used).join(used.hint("merge"), F.col("id") == F.col("rep"))
                 .select("rep", "d1", "d2", "body").mapInArrow(tidy(collected(ngram)), "rep long, body binary")
                 .groupBy("rep").agg(F.first("body").alias("body")))
        texts = stored(texts, "gram-texts-used")
        meet = (likely.join(texts.select(F.col("rep").alias("a"), F.col("body").alias("x")), "a")
                .join(texts.select(F.col("rep").alias("b"), F.col("body").alias("y")), "b"))
        new = stored(meet.select("a", "b", "x", "y").mapInArrow(
            tidy(verified(ngram, threshold)), "a long, b long"), "gram-links")
        if has_rows(new):
            # a component's links are kept as (node, smallest node)
            links = labels.select(F.col("comp").alias("a"), F.col("rep").alias("b")).unionByName(new)
            labels = stored(components(links), "gram-labels")
    return nodes, labels


def _candidates(postings: DataFrame, labels: DataFrame, threshold: int, step: int,
                last: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (a, b), a < b, between different components, once per n-gram they
    share; the n-grams that several components share, with their number of
    postings; and the postings with their components.  After the first round each n-gram draws hubs of its
    own, so a node meets many of a component before the last round."""
    held = (postings.join(labels, "rep", "left")
            .withColumn("comp", F.coalesce("comp", "rep")))
    held = stored(held, "gram-labelled")
    mixed = (held.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("size"))
             .groupBy("gram").agg(F.max_by("comp", F.struct("size", -F.col("comp"))).alias("main"),
                                  F.count(F.lit(1)).alias("comps"), F.sum("size").alias("nodes"))
             .where("comps > 1").select("gram", "main", "nodes"))
    mixed = stored(mixed, "gram-mixed")
    posting = ("rep", "n", "pos", *SIGNED)
    some = held.join(mixed.select("gram"), "gram", "left_semi").withColumnRenamed("gram", "g")
    if not last:
        order = F.col("rep") if step == 0 else F.xxhash64("rep", "g", F.lit(step))
        slot = F.pmod(order, F.lit(HUBS[min(step, len(HUBS) - 1)])) if step else F.lit(0)
        hub = (some.groupBy(F.col("g").alias("gram"), slot.alias("slot"))
               .agg(F.min(F.struct(order.alias("o"), "comp", *posting)).alias("hub"))
               .select("gram", F.col("hub.comp").alias("c"),
                       *[F.col(f"hub.{c}").alias(_other(c)) for c in posting]))
        return (hub.join(some, (F.col("gram") == F.col("g")) & (F.col("comp") != F.col("c"))
                         & _possible(threshold))
                .select(*_pair("rep", _other("rep")))), mixed, held
    others = held.join(mixed.drop("nodes"), "gram").where("comp <> main")
    others = others.select("gram", *[F.col(c).alias(_other(c)) for c in posting],
                           F.col("comp").alias("c"), "main")
    # nodes outside the main component of an n-gram, with all other nodes there
    apart = ((F.col("comp") != F.col("c"))
             & ((F.col("comp") == F.col("main")) | (F.col(_other("rep")) < F.col("rep")))
             & _possible(threshold))
    return (others.join(some, (F.col("gram") == F.col("g")) & apart)
            .select(*_pair("rep", _other("rep")))), mixed, held


def near_groups(docs: DataFrame, ngram: int = NGRAM, threshold: int = THRESHOLD) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``.

    Words are runs without ASCII white-space, A-Z lower-cased.  Null, empty
    and blank texts have an empty set, link with nothing and are their own
    component.  Repeated rows come back as often; an id with several texts is
    one document and joins what any of them links to.  A null id takes no
    part: its component is null.  Other columns are not read.
    """
    nodes, labels = linked_nodes(docs, ngram, threshold)
    # an id with several sets stands under any of them
    of_id = nodes.select("row", "id", "n", "rep").join(labels, "rep", "left")
    comp = F.coalesce("comp", "rep", "id")
    return of_id.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                        comp.alias("component_id"))
