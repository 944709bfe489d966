"""Language-model scores from a log-frequency Bloom filter.

1. *Counts.*  All n-grams of the training texts are counted: a task counts
   what it reads as sorted arrays of (history, word, count), cuts them by
   ranges of the history's hash, and ranges are merged after one shuffle of
   the packed arrays.
2. *Filter.*  A count c is quantised to the level 1 + floor(log_b c).  An
   n-gram is entered in a Bloom filter once for every level up to its own;
   so are single words, and how many different words follow each history.  Short
   ranges of keys build a segment each, sized by what it enters, and the
   segments together are broadcast.
3. *Scores.*  A count is read back by probing level after level until one is
   missing; the level stands for the mean count of its bucket.  Probabilities
   are interpolated with absolute discounting: what is taken off each n-gram
   of a history goes to the shorter history, down to single words with 0.1
   added to each count.  The discount of an order is that of leaving one out,
   n1 / (n1 + 2 n2), over all its n-grams.

What is broadcast is bounded by ``max_bytes``.  When the entries of a corpus
need more, n-grams below a level are not entered, the same level for all, so
that the rest fits.  What a text asks of the filter and does not find at that
level is then looked up in the counts themselves: blocks of texts write down
their open questions, these are shuffled to the ranges of histories, and the
answers and the texts meet again by block.  So the model is the same at every
``max_bytes``, but for false hits of the filter.

The unigram base uses exact counts: the most frequent words (a bounded table)
are looked up in the task, all others by a join.  Words are told apart by
64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import stored, tidy
from twinreach.llm.words import NONBLANK, SLICE, STEP, Words, mix, slices

ORDER = 2
BASE = 1.5  # of the quantisation
BITS = 8  # of the filter per entry
HASHES = 4
MAX_BYTES = 256 << 20  # of the filter
ADDED = 0.1
FREQUENT = 1 << 18  # most words looked up in the task
PART_BYTES = 32 << 20  # of text per range of histories
SEGMENT = 1 << 16  # n-grams of a segment, and those of its last history
RUN = 3 << 17  # tokens scored at once
PROBED = 1 << 14  # keys looked up in the filter at once
BLOCK = 1 << 21  # bytes of text that ask together for what the filter lacks
FLUSH = 1 << 19  # tokens counted in a task before they are sent on

BEGIN, END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC2B2AE3D27D4EB4F)
_WORD, _KINDS = np.uint64(0x165667B19E3779F9), np.uint64(0x85EBCA77C2B2AE63)
_32 = np.uint64(32)
_LOW32 = np.uint64(0xFFFFFFFF)
_SORTED = np.uint64((1 << 20) - 1)  # bits of a word by which n-grams of a history are sorted


# -- tokens and n-grams ----------------------------------------------------------

@dataclass
class Tokens:
    """Tokens of some texts: each text's words and one end."""

    first_row: int
    texts: int
    text: np.ndarray  # text number per token
    token: np.ndarray  # hash per token
    histories: list[np.ndarray]  # per order from 2: hash of the words before


def tokens(column: pa.Array, order: int, size: int = SLICE) -> Iterator[Tokens]:
    for base, data, bounds in slices(column, size):
        words = Words(data, bounds, NONBLANK)
        texts = len(bounds) - 1
        counts = np.bincount(words.text, minlength=texts)
        held = counts + order  # beginnings, words, end
        start = np.cumsum(held) - held
        stream = np.full(int(held.sum()), BEGIN)
        first = np.cumsum(counts) - counts
        stream[start[words.text] + order - 1 + np.arange(len(words.text)) - first[words.text]] = words.hash
        stream[start + held - 1] = END
        real = np.ones(len(stream), bool)
        for j in range(order - 1):
            real[start + j] = False
        at = np.flatnonzero(real)
        histories = []
        for k in range(2, order + 1):
            h = np.full(len(at), k, np.uint64)
            for j in range(1, k):
                h += stream[at - j] * STEP[j]
            histories.append(mix(h))
        yield Tokens(base, texts, np.repeat(np.arange(texts), counts + 1), stream[at], histories)


def runs(column: pa.Array, order: int) -> Iterator[Tokens]:
    """Tokens of about RUN tokens together, found slice by slice."""

    def joined(held: list[Tokens]) -> Tokens:
        before = np.cumsum([0, *(t.texts for t in held)]).tolist()
        return Tokens(held[0].first_row, before[-1],
                      np.concatenate([t.text + n for t, n in zip(held, before)]),
                      np.concatenate([t.token for t in held]),
                      [np.concatenate(h) for h in zip(*(t.histories for t in held))])

    held: list[Tokens] = []
    for t in tokens(column, order):
        held.append(t)
        if sum(len(t.token) for t in held) >= RUN:
            yield joined(held)
            held = []
    if held:
        yield joined(held)


def gram_key(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of an n-gram, from its history and the low half of its word."""
    return mix(history ^ (word * STEP[12]))


def part_of(key: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of keys, so that sorted keys are sorted by part."""
    return ((key >> _32) * np.uint64(parts)) >> _32


# -- counts ----------------------------------------------------------------------

def _summed(key: np.ndarray, word: np.ndarray, n: np.ndarray):
    """Sorted by key and word, counts of the same added up."""
    order = np.argsort(key)
    key, word, n = key[order], word[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    pair = ((np.cumsum(new) - 1).astype(np.uint64) << _32) | word
    order = np.argsort(pair)
    pair, word, n = pair[order], word[order], n[order]
    new[1:] = pair[1:] != pair[:-1]
    first = np.flatnonzero(new)
    return key[first], word[first], (np.add.reduceat(n, first) if len(first) else n)


_COUNTED = "part int, kind int, keys binary, words binary, counts binary"
_COUNTED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()),
                            ("words", pa.binary()), ("counts", pa.binary())])
_TYPES = ("<u8", "<u4", "<i8")


def counted(order: int, parts: int):
    """Counts of the task's n-grams; kind 1 are words, kind k n-grams of k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Tokens] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            token = np.concatenate([t.token for t in held])
            for kind in range(1, order + 1):
                if kind == 1:
                    key, word = token, np.zeros(len(token), np.uint64)
                else:
                    key = np.concatenate([t.histories[kind - 2] for t in held])
                    word = token & _LOW32
                one = np.ones(len(key), np.int64)
                key, word, n = _summed(key, word, one)
                edges = np.searchsorted(part_of(key, parts), np.arange(parts + 1, dtype=np.uint64))
                some = np.flatnonzero(np.diff(edges))
                columns = [c.astype(t) for c, t in zip((key, word, n), _TYPES)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), kind, np.int32)),
                     *(pa.array([c[edges[p]:edges[p + 1]].tobytes() for p in some.tolist()], pa.binary())
                       for c in columns)], schema=_COUNTED_ARROW)

        for batch in batches:
            for t in tokens(batch.column("body"), order):
                held.append(t)
                size += len(t.token)
                if size >= FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def level_count(base: float) -> int:
    """Levels that any count of 63 bits can have, and 0."""
    return 2 + int(63 * math.log(2) / math.log(base))


def level_of(count: np.ndarray, base: float) -> np.ndarray:
    """Level of counts of at least 1 (0 for 0)."""
    count = np.asarray(count, np.float64)
    level = 1 + np.floor(np.log(np.maximum(count, 1)) / math.log(base) + 1e-9)
    return np.where(count < 1, 0, level).astype(np.int64)


def level_means(base: float) -> np.ndarray:
    """Mean of the whole numbers of each level."""
    out = np.zeros(level_count(base))
    for level in range(1, len(out)):
        low, high = math.ceil(base ** (level - 1) - 1e-9), math.ceil(base ** level - 1e-9) - 1
        out[level] = (low + high) / 2 if high >= low else base ** (level - 1)
    return out


_MERGED = ("part int, kind int, keys binary, words binary, counts binary, total long, ones long, twos long, "
           "entries array<long>, events array<long>")
_MERGED_ARROW = pa.schema([*_COUNTED_ARROW, *((c, pa.int64()) for c in ("total", "ones", "twos")),
                           *((c, pa.list_(pa.int64())) for c in ("entries", "events"))])


def _history_events(key: np.ndarray, n: np.ndarray, level: np.ndarray, base: float):
    """Entries, at most, that a history needs beside its n-grams, by the
    highest level among these: with that left out, the history is left out."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    need = level_of(np.add.reduceat(n, first), base) + 1
    return np.bincount(np.maximum.reduceat(level, first), need, level_count(base)).astype(np.int64)


def merged(base: float):
    """Of rows sorted by part and kind: the sums, a row per segment, with
    numbers of n-grams and of entries by level.  A history lies in one row."""

    def close(part: int, kind: int, held) -> Iterator[pa.RecordBatch]:
        key, word, n = (np.frombuffer(b"".join(c), t) for c, t in zip(held, _TYPES))
        sums = _summed(key, word, n)
        cuts = sums[0][::SEGMENT][1:]
        cuts = np.unique(np.searchsorted(sums[0], cuts, side="right"))
        for key, word, n in zip(*(np.split(c, cuts) for c in sums)):
            if not len(key):
                continue
            level = level_of(n, base)
            entries = np.bincount(level, minlength=level_count(base))
            events = entries * np.arange(len(entries))
            if kind > 1:
                events = events + _history_events(key, n, level, base)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([kind], pa.int32()),
                 *(pa.array([c.astype(t).tobytes()], pa.binary()) for c, t in zip((key, word, n), _TYPES)),
                 *(pa.array([int(v)], pa.int64()) for v in (n.sum(), (n == 1).sum(), (n == 2).sum())),
                 pa.array([entries.tolist()], pa.list_(pa.int64())),
                 pa.array([events.tolist()], pa.list_(pa.int64()))], schema=_MERGED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            for i, place in enumerate(zip(batch.column("part").to_pylist(),
                                          batch.column("kind").to_pylist())):
                if now is not None and place != now:
                    yield from close(*now, held)
                    held = ([], [], [])
                now = place
                for c, name in zip(held, ("keys", "words", "counts")):
                    c.append(batch.column(name)[i].as_py())
        if now is not None:
            yield from close(*now, held)

    return run


# -- filter ----------------------------------------------------------------------

_BIT = np.uint8(1) << np.arange(8, dtype=np.uint8)


def places(key: np.ndarray, level: np.ndarray | int, size: np.ndarray, i: int) -> np.ndarray:
    """Bit of the i-th hash of (key, level), within a segment of ``size``."""
    h = mix(key + np.asarray(level, np.uint64) * STEP[13])
    h = ((h & _LOW32) + np.uint64(i) * ((h >> _32) | np.uint64(1))) & _LOW32
    return (h * size) >> _32


def segment(keys: np.ndarray, levels: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """Bytes of a filter with every level up to its own of each key."""
    size = max(64, -(-int(levels.sum()) * bits // 64) * 64)
    if size >= 1 << 32:
        raise ValueError("a segment holds 2^32 bits at most: use more ranges")
    found = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for i in range(hashes):
            found[places(keys, level, np.uint64(size), i)] = True
    return np.packbits(found, bitorder="little")


def entered(kind: int, key: np.ndarray, word: np.ndarray, n: np.ndarray, base: float,
            least: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, levels) to enter for the sums of one part and kind: n-grams from
    level ``least`` on, and how many different words follow their histories."""
    level = level_of(n, base)
    keep = level >= least
    if kind == 1:
        return mix(key ^ _WORD)[keep], level[keep]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    shares = np.diff(np.append(first, len(key)))
    used = np.maximum.reduceat(keep, first)
    history = key[first][used]
    return (np.concatenate((gram_key(key, word)[keep], mix(history ^ _KINDS))),
            np.concatenate((level[keep], level_of(shares[used], base))))


def built(base: float, least: int, bits: int, hashes: int):
    """Segments of the filter, with the first key of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, kind in enumerate(batch.column("kind").to_pylist()):
                key, word, n = (np.frombuffer(batch.column(c)[i].as_buffer(), t)
                                for c, t in zip(("keys", "words", "counts"), _TYPES))
                made = segment(*entered(kind, key, word.astype(np.uint64), n, base, least), bits, hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("kind").slice(i, 1), pa.array(key[:1].view(np.int64)),
                     pa.array([made.tobytes()], pa.binary())], ["kind", "low", "bits"])

    return run


class Filter:
    """Counts by membership probes.  ``segments`` are (kind, first key, bits);
    ``most`` is the highest level."""

    def __init__(self, segments: list[tuple[int, int, bytes]], order: int, hashes: int, base: float):
        # a segment of nothing below the first of each kind
        empty = [(kind, 0, bytes(8)) for kind in range(1, order + 1)]
        ranges = sorted([*empty, *((kind, low % (1 << 64), raw) for kind, low, raw in segments)],
                        key=lambda s: s[:2])
        kinds = np.array([kind for kind, _, _ in ranges])
        self.first = np.searchsorted(kinds, np.arange(1, order + 2)).tolist()
        self.low = np.array([low for _, low, _ in ranges], np.uint64)
        sizes = np.array([len(raw) for _, _, raw in ranges], np.int64)
        self.begin = ((np.cumsum(sizes) - sizes) * 8).astype(np.uint64)
        self.size = (sizes * 8).astype(np.uint64)
        self.raw = b"".join(raw for _, _, raw in ranges)  # bytes are unpickled without a copy
        self.hashes, self.most = hashes, level_count(base) - 1

    def where(self, kind: int, key: np.ndarray) -> np.ndarray:
        """Segments of words or histories."""
        a, b = self.first[kind - 1:kind + 1]
        return a - 1 + np.searchsorted(self.low[a:b], key, side="right")

    def levels(self, key: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The highest level up to which every level of a key is there, in
        the segments ``where``.  Keys of a segment should stand together:
        PROBED keys at a time, with the segments they lie in, fit the cache."""
        out = np.zeros(len(key), np.int64)
        for at in range(0, len(key), PROBED):
            part = slice(at, at + PROBED)
            self._levels(key[part], where[part], out[part])
        return out

    def _levels(self, key: np.ndarray, where: np.ndarray, out: np.ndarray) -> None:
        data = np.frombuffer(self.raw, np.uint8)
        begin, size = self.begin[where], self.size[where]
        left = np.arange(len(key))
        for level in range(1, self.most + 1):
            if not len(left):
                break
            h = mix(key + np.full(1, level, np.uint64) * STEP[13])
            low, step = h.astype(np.uint32), (h >> _32).astype(np.uint32) | np.uint32(1)
            for i in range(self.hashes):
                if i:
                    low = low + step  # modulo 2^32
                bit = ((low * size) >> _32) + begin
                byte = data[(bit >> np.uint64(3)).view(np.int64)]
                hit = (byte & _BIT[bit.astype(np.uint8) & np.uint8(7)]) != 0
                found = found & hit if i else hit
                # keys that miss go when they are many, or the level is done
                some = np.count_nonzero(found)
                if some < (len(left) if i == self.hashes - 1 else 0.8 * len(left)):
                    there = np.flatnonzero(found)
                    key, begin, size, left = key[there], begin[there], size[there], left[there]
                    low, step, found = low[there], step[there], found[there]
            out[left] = level


# -- model -----------------------------------------------------------------------

@dataclass
class Found:
    """Levels that the filter has for the words (kind 1) or n-grams of a run."""

    kind: int
    keys: np.ndarray  # different words or histories, in order of their upper 32 bits
    order: np.ndarray | None = None  # tokens by history and word
    of: np.ndarray | None = None  # place of the history, per token in that order
    low: np.ndarray | None = None  # low half of the token, in that order
    levels: np.ndarray | None = None  # per key: of the word, or of how many words follow
    grams: np.ndarray | None = None  # per token in that order: of the n-gram

    def open(self, least: int) -> tuple[np.ndarray, ...]:
        """What is to be looked up: (places of keys, and of kinds from 2: how
        many n-grams of each key, low halves of their words, tokens in order,
        the n-gram of each).  A word or n-gram entered has at least level
        ``least``, and then its history is entered too."""
        if self.kind == 1:
            return (np.flatnonzero(self.levels < least),)
        at = np.flatnonzero(self.grams < least)
        gram, which = np.unique((self.of[at].astype(np.uint64) << _32) | self.low[at], return_inverse=True)
        places, sizes = np.unique(gram >> _32, return_counts=True)
        return places.astype(np.int64), sizes, gram & _LOW32, at, which


@dataclass
class Model:
    order: int
    base: float
    train_texts: int
    train_tokens: int
    kinds: int  # distinct tokens
    discounts: dict[int, float]
    least: int  # lowest level entered
    filter: Filter

    def denominator(self) -> float:
        return self.train_tokens + ADDED * (self.kinds + 1)

    def found(self, t: Tokens, word: np.ndarray) -> list[Found]:
        """What the filter tells of the different tokens ``word``, in order,
        and of the n-grams of each kind from 2."""
        out = [Found(1, word)]
        keys, where, grams = [mix(word ^ _WORD)], [self.filter.where(1, word)], []
        for kind, h in enumerate(t.histories, 2):
            # the same n-grams stand together and are looked up once; where the
            # sorted bits of two are the same, they are looked up more often
            order = np.argsort((h & ~_SORTED) | (t.token & _SORTED))
            own, low = h[order], t.token[order] & _LOW32
            new = np.concatenate(([True], own[1:] != own[:-1]))
            gram = new.copy()
            gram[1:] |= low[1:] != low[:-1]
            history, of = own[new], np.cumsum(new) - 1
            place = self.filter.where(kind, history)
            keys += [mix(history ^ _KINDS), gram_key(own[gram], low[gram])]
            where += [place, place[of[gram]]]
            grams.append(np.cumsum(gram) - 1)
            out.append(Found(kind, history, order, of, low))
        levels = self.filter.levels(np.concatenate(keys), np.concatenate(where))
        levels = iter(np.split(levels, np.cumsum([len(k) for k in keys])[:-1]))
        out[0].levels = next(levels)
        for f, gram in zip(out[1:], grams):
            f.levels, f.grams = next(levels), next(levels)[gram]
        return out

    def log10(self, t: Tokens, found: list[Found], which: np.ndarray) -> np.ndarray:
        """log10 probability of each token after those before it; ``which`` is
        each token's place among the different ones."""
        means = level_means(self.base)
        n = means[found[0].levels][which]
        p = (n + ADDED) / self.denominator()
        starts = np.concatenate(([True], t.text[1:] != t.text[:-1]))
        for f in found[1:]:
            # a history occurs as often as the shorter n-gram that it is
            total = np.where(starts, self.train_texts, np.roll(n, 1))
            shares, n = np.empty((2, len(f.order)))
            shares[f.order], n[f.order] = means[f.levels][f.of], means[f.grams]
            d = self.discounts.get(f.kind, 0.5)
            own, rest = np.maximum(n - d, 0.0), d * shares
            # quantised counts may add up to more than the history's
            whole = np.maximum(total, own + rest)
            # every history entered has both; one alone is a false hit
            real = (total > 0) & (shares > 0)
            p = np.where(real, (own + rest * p) / np.where(real, whole, 1.0), p)
        return np.log10(p)


def held_out(doc_id: str):
    """Rows whose crc32 of the id, as text, is 0 modulo 10; a null id is not."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 10 == 0, F.lit(False))


def _by_level(table: DataFrame, column: str, levels: int) -> dict[int, np.ndarray]:
    out: dict[int, np.ndarray] = {}
    for r in (table.select("kind", F.posexplode(column).alias("level", "n")).where("n > 0")
              .groupBy("kind", "level").agg(F.sum("n").alias("n")).collect()):
        out.setdefault(r["kind"], np.zeros(levels, np.int64))[r["level"]] = r["n"]
    return out


def train(docs: DataFrame, order: int = ORDER, base: float = BASE, bits: int = BITS,
          hashes: int = HASHES, max_bytes: int = MAX_BYTES) -> tuple[Model, DataFrame, np.ndarray, int]:
    """(model, sums by part and kind, number of words by level, number of
    parts) from the texts of ``docs`` (body)."""
    spark = docs.sparkSession
    texts, size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("body"))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (size or 0) // PART_BYTES)
    sent = docs.select("body").mapInArrow(tidy(counted(order, parts)), _COUNTED)
    sums = stored(sent.repartition("part").sortWithinPartitions("part", "kind")
                  .mapInArrow(tidy(merged(base)), _MERGED), "lm-counts")
    totals = {r["kind"]: r for r in sums.groupBy("kind").agg(
        *[F.sum(c).alias(c) for c in ("total", "ones", "twos")]).collect()}
    discounts = {k: min(max(r["ones"] / max(r["ones"] + 2 * r["twos"], 1), 0.1), 0.99)
                 for k, r in totals.items() if k > 1}
    levels = level_count(base)
    entries, events = (_by_level(sums, c, levels) for c in ("entries", "events"))
    # entries needed when n-grams of levels below the place are not entered
    need = sum(events.values(), np.zeros(levels, np.int64))[::-1].cumsum()[::-1]
    fits = np.flatnonzero(need * bits <= max_bytes * 8)
    least = max(1, int(fits[0]) if len(fits) else levels)
    made = stored(sums.select("kind", "keys", "words", "counts").mapInArrow(
        tidy(built(base, least, bits, hashes)), "kind int, low long, bits binary"), "lm-filter")
    # ``max_bytes``, and eight bytes per segment, at most
    segments = [tuple(r) for r in made.toLocalIterator()]
    words = entries.get(1, np.zeros(levels, np.int64))
    model = Model(order, base, texts, totals[1]["total"] if 1 in totals else 0, int(words.sum()),
                  discounts, least, Filter(segments, order, hashes, base))
    return model, sums, words, parts


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch.column("keys"), batch.column("counts")):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(keys.as_py(), "<i8")),
                 pa.array(np.frombuffer(counts.as_py(), "<i8"))], ["token", "n"])


_SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
           "score double, rare array<long>, times array<long>")
_SCORED_ARROW = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                           ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()),
                           ("score", pa.float64()), ("rare", pa.list_(pa.int64())),
                           ("times", pa.list_(pa.int64()))])


def _scores(model: Model, t: Tokens, found: list[Found], different: np.ndarray, which: np.ndarray,
            own: list[pa.Array], frequent: np.ndarray, logs: np.ndarray) -> pa.RecordBatch:
    """Scores of a run of texts, ``own`` being their row, doc_id and held_out."""
    score = np.bincount(t.text, model.log10(t, found, which), t.texts)
    # each word of a text once
    pairs, times = np.unique(t.text * len(different) + which, return_counts=True)
    text, word = np.divmod(pairs, max(len(different), 1))
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, different), len(frequent) - 1)
        here, log = (frequent[at] == different)[word], logs[at][word]
    else:
        here, log = np.zeros(len(word), bool), np.zeros(len(word))
    word = different[word]
    rare = np.concatenate(([0], np.cumsum(np.bincount(text[~here], minlength=t.texts))))
    lists = [pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.array(v))
             for v in (word[~here].view(np.int64), times[~here])]
    base = np.bincount(text[here], times[here] * log[here], t.texts)
    known = np.bincount(text[here], times[here], t.texts).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [*own, pa.array(np.bincount(t.text, minlength=t.texts)), pa.array(known),
         pa.array(base), pa.array(score), *lists], schema=_SCORED_ARROW)


_OWN = ("row", "doc_id", "held_out")


def scored(sent, frequent: np.ndarray, logs: np.ndarray):
    """Scores of texts; ``frequent`` (sorted) and ``logs`` are the words
    looked up here and the logarithms of their counts, the others of a text
    are returned with how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            for t in runs(batch.column("body"), model.order):
                different, which = np.unique(t.token, return_inverse=True)
                own = [batch.column(c).slice(t.first_row, t.texts) for c in _OWN]
                yield _scores(model, t, model.found(t, different), different, which, own, frequent, logs)

    return run


# -- what the filter lacks ---------------------------------------------------------

_ASKED = ("block long, row long, doc_id long, held_out boolean, body binary, part int, kind int, "
          "keys binary, sizes binary, words binary")
_ASKED_ARROW = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()),
                          ("held_out", pa.bool_()), ("body", pa.binary()), ("part", pa.int32()),
                          ("kind", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()),
                          ("words", pa.binary())])


def _asked_rows(**columns) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, pa.nulls(size, f.type)) for f in _ASKED_ARROW], schema=_ASKED_ARROW)


def asked(sent, parts: int):
    """The texts in blocks, named by their first row, and what each block has
    to look up, a row per part and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        for batch in batches:
            for t in tokens(batch.column("body"), model.order, BLOCK):
                own = {c: batch.column(c).slice(t.first_row, t.texts) for c in (*_OWN, "body")}
                block = own["row"][0].as_py()
                yield _asked_rows(block=pa.array(np.full(t.texts, block)), **own)
                for f in model.found(t, np.unique(t.token)):
                    places, *grams = f.open(model.least)
                    keys = f.keys[places].astype("<u8")
                    sizes, words = (g.astype("<u4") for g in grams[:2]) if grams else (None, None)
                    edges = np.searchsorted(part_of(keys, parts), np.arange(parts + 1, dtype=np.uint64))
                    some = np.flatnonzero(np.diff(edges))
                    if not len(some):
                        continue
                    columns = {"keys": (keys, edges)}
                    if grams:
                        ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                        columns |= {"sizes": (sizes, edges), "words": (words, ends[edges])}
                    yield _asked_rows(
                        block=pa.array(np.full(len(some), block)), part=pa.array(some.astype(np.int32)),
                        kind=pa.array(np.full(len(some), f.kind, np.int32)),
                        **{c: pa.array([v[e[p]:e[p + 1]].tobytes() for p in some.tolist()], pa.binary())
                           for c, (v, e) in columns.items()})

    return run


_ANSWERED = "block long, part int, kind int, levels binary, grams binary"
_ANSWERED_ARROW = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("kind", pa.int32()),
                             ("levels", pa.binary()), ("grams", pa.binary())])


def answered(base: float):
    """Of rows sorted by part, kind and block: levels of what the blocks ask,
    from the counts of that part and kind, which have no block and come first."""

    class Counts:
        def __init__(self, kind: int, held: list):
            held = sorted(held, key=lambda c: int(c[0][0]))  # a segment each
            key, word, n = (np.concatenate([c[i] for c in held]) if held else np.empty(0, t)
                            for i, t in enumerate(_TYPES))
            self.level = level_of(n, base)
            if kind == 1:
                self.keys = key
                return
            new = np.concatenate(([True], key[1:] != key[:-1]))[:len(key)]
            first = np.flatnonzero(new)
            self.keys = key[first]
            self.shares = level_of(np.diff(np.append(first, len(key))), base)
            self.grams = ((np.cumsum(new) - 1).astype(np.uint64) << _32) | word

        @staticmethod
        def _level(of: np.ndarray, asked: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(of):
                return np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
            at = np.minimum(np.searchsorted(of, asked), len(of) - 1)
            return at, np.where(of[at] == asked, levels[at], 0)

        def words(self, keys: np.ndarray) -> np.ndarray:
            return self._level(self.keys, keys, self.level)[1]

        def histories(self, keys: np.ndarray, sizes: np.ndarray, words: np.ndarray):
            at, shares = self._level(self.keys, keys, self.shares)
            gram = (np.repeat(at, sizes).astype(np.uint64) << _32) | words
            grams = self._level(self.grams, gram, self.level)[1]
            return shares, np.where(np.repeat(shares > 0, sizes), grams, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, counts = None, [], None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["part"], r["kind"]) != now:
                    now, held, counts = (r["part"], r["kind"]), [], None
                if r["block"] is None:
                    held.append([np.frombuffer(r[c], t) for c, t in zip(("keys", "words", "counts"), _TYPES)])
                    continue
                if counts is None:
                    counts, held = Counts(r["kind"], held), []
                keys, grams = np.frombuffer(r["keys"], "<u8"), None
                if r["kind"] == 1:
                    levels = counts.words(keys)
                else:
                    levels, grams = counts.histories(keys, *(np.frombuffer(r[c], "<u4")
                                                             for c in ("sizes", "words")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int64()), pa.array([r["part"]], pa.int32()),
                     pa.array([r["kind"]], pa.int32()), *(pa.array(
                         [None if v is None else v.astype("<u2").tobytes()], pa.binary())
                         for v in (levels, grams))], schema=_ANSWERED_ARROW)

    return run


def scored_blocks(sent, frequent: np.ndarray, logs: np.ndarray):
    """``scored`` of rows sorted by block and row: the answers, which have no
    row, come before the texts of their block."""

    def close(texts: list, answers: list) -> pa.RecordBatch:
        model: Model = sent.value
        (t,) = tokens(pa.array([r["body"] for r in texts], pa.binary()), model.order, BLOCK)
        different, which = np.unique(t.token, return_inverse=True)
        found = model.found(t, different)
        for f in found:
            of = sorted((r["part"], r["levels"], r["grams"]) for r in answers if r["kind"] == f.kind)
            places, *grams = f.open(model.least)
            f.levels[places] = np.frombuffer(b"".join(levels for _, levels, _ in of), "<u2")
            if grams:
                _, _, at, gram = grams
                f.grams[at] = np.frombuffer(b"".join(g for _, _, g in of), "<u2")[gram]
        own = [pa.array([r[c] for r in texts], _SCORED_ARROW.field(c).type) for c in _OWN]
        return _scores(model, t, found, different, which, own, frequent, logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, texts, answers = None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != block:
                    if texts:
                        yield close(texts, answers)
                    block, texts, answers = r["block"], [], []
                (answers if r["row"] is None else texts).append(r)
        if texts:
            yield close(texts, answers)

    return run


def _looked_up(rows: DataFrame, sums: DataFrame, sent, base: float, parts: int) -> DataFrame:
    """Texts and answers, in order of their blocks."""
    asks = stored(rows.mapInArrow(tidy(asked(sent, parts)), _ASKED), "lm-asked")
    none = F.lit(None)
    counts = sums.select(none.cast("long").alias("block"), "part", "kind", "keys",
                         none.cast("binary").alias("sizes"), "words", "counts")
    told = (asks.where("part is not null").select("block", "part", "kind", "keys", "sizes", "words",
                                                  none.cast("binary").alias("counts"))
            .unionByName(counts).repartition("part").sortWithinPartitions("part", "kind", "block")
            .mapInArrow(tidy(answered(base)), _ANSWERED))
    texts = asks.where("part is null").select("block", "row", "doc_id", "held_out", "body")
    return (texts.unionByName(told, allowMissingColumns=True)
            .repartition("block").sortWithinPartitions("block", "row"))


def lm_scores(docs: DataFrame, order: int = ORDER, base: float = BASE, bits: int = BITS,
              hashes: int = HASHES, max_bytes: int = MAX_BYTES, most_frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` per row of ``docs``.

    Tokens are runs without ASCII white-space, A-Z lower-cased, and one end
    per text; null and empty texts are an end alone.  The model learns from
    all rows that are not held out; a null id is not held out.  Repeated rows
    are learned from as often as they occur and come back as often.  Without
    training rows every token is unknown.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    model, sums, words, parts = train(rows.where(~F.col("held_out")), order, base, bits, hashes, max_bytes)
    counts = stored(sums.where("kind = 1").select("keys", "counts")
                    .mapInArrow(_unpacked, "token long, n long"), "lm-words")
    # the lowest level from which on the words fit the table
    fits = np.flatnonzero(words[::-1].cumsum()[::-1] <= most_frequent)
    floor = math.ceil(base ** (max(int(fits[0]), 1) - 1) - 1e-9) if len(fits) else 1 << 62
    top = counts.where(F.col("n") >= floor).toArrow()  # ``most_frequent`` rows at most
    token = top.column("token").to_numpy().view(np.uint64)
    by_token = np.argsort(token)
    logs = np.log10(top.column("n").to_numpy()[by_token] + ADDED)
    sent = spark.sparkContext.broadcast(model)
    if model.least == 1:
        out = rows.mapInArrow(tidy(scored(sent, token[by_token], logs)), _SCORED)
    else:
        out = _looked_up(rows, sums, sent, base, parts).mapInArrow(
            tidy(scored_blocks(sent, token[by_token], logs)), _SCORED)
    out = stored(out, "lm-scored")
    sent.destroy()
    rare = (out.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w"))
            .select("row", F.col("w.rare").alias("token"), F.col("w.times").alias("times"))
            .join(counts, "token", "left"))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADDED))).alias("more"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("also"))
    none = F.lit(0)
    return out.drop("rare", "times").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("also", none)).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", none.cast("double"))
         - F.col("n_tokens") * F.lit(math.log10(model.denominator()))).alias("base_score"), "score")
