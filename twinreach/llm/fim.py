"""Fill-in-the-middle transformation of whole texts.

A text is a row of units: a run of ASCII letters, or any other code point.
Two of the places before, between and after its units, drawn from a digest
of the seed and the id, part it into prefix, middle and suffix, which are
written out with sentinels in one of two orders.

Units are never listed.  The UTF-8 bytes of a text are viewed as 64-bit
words, eight bytes at a time:

* arithmetic on whole words marks the high bit of every byte that ends a
  unit (a letter that no letter follows, or the last byte of another code
  point);
* ``bitwise_count`` gives the marks of each word, and a running sum the units
  up to each word;
* the word with the k-th mark is found by binary search in that sum, and the
  place inside of it by one multiplication (running counts of its bytes) and
  one comparison of all bytes at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinreach.llm.words import slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = 1

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)
_UP_TO_A = np.uint64(0x80 - 0x61) * _ONES
_BEYOND_Z = np.uint64(0x80 - 0x7B) * _ONES
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _of_next(marks: np.ndarray) -> np.ndarray:
    """Marks moved one byte down: each byte sees the mark of the byte after it."""
    following = np.append(marks[1:], np.uint64(0))
    return (marks >> np.uint64(8)) | (following << np.uint64(56))


def unit_ends(words: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High bits of the bytes that end a unit, and of those that begin a code
    point.  ``inside`` has ones over the bytes of texts; after the last byte
    of each text there is at least one zero byte."""
    folded = (words & _LOW7) | _CASE
    letters = (folded + _UP_TO_A) & ~(folded + _BEYOND_Z) & ~words & _HIGH
    continued = words & ~(words << np.uint64(1)) & _HIGH
    ends = _HIGH & ~_of_next(continued) & ~(letters & _of_next(letters)) & inside
    return ends, _HIGH & ~continued & inside


class Units:
    """Units of some texts (bytes ``data``, cut at ``bounds``)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        sizes = np.diff(bounds)
        held = sizes // 8 + 1
        self.first = np.cumsum(held) - held
        room = np.zeros(int(held.sum()) * 8, np.uint8)
        for begin, end, at in zip(bounds[:-1].tolist(), bounds[1:].tolist(),
                                  (self.first * 8).tolist()):
            room[at:at + end - begin] = data[begin:end]
        words = room.view("<u8")
        inside = np.full(len(words), _ALL)
        last = self.first + held - 1
        inside[last] = (np.uint64(1) << (np.uint64(8) * (sizes % 8).astype(np.uint64))) - np.uint64(1)
        self.ends, self.points = unit_ends(words, inside)
        self.sums = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.point_sums = np.cumsum(np.bitwise_count(self.points), dtype=np.int64)
        self.before = self._up_to(self.sums, self.first)
        self.counts = self.sums[last] - self.before

    @staticmethod
    def _up_to(sums: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.where(word > 0, sums[word - 1], 0)

    def after(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, code points) of the first ``units`` units of each text."""
        rank = self.before + np.maximum(units, 1)
        word = np.minimum(np.searchsorted(self.sums, rank), len(self.sums) - 1)
        nth = (rank - self._up_to(self.sums, word)).astype(np.uint64)
        running = (self.ends[word] >> np.uint64(7)) * _ONES
        reached = ((running | _HIGH) - nth * _ONES) & _HIGH
        place = 8 - np.bitwise_count(reached).astype(np.int64)
        head = _ALL >> (np.uint64(8) * (7 - np.minimum(place, 7)).astype(np.uint64))
        points = (self._up_to(self.point_sums, word) - self._up_to(self.point_sums, self.first)
                  + np.bitwise_count(self.points[word] & head))
        none = units == 0
        return (np.where(none, 0, (word - self.first) * 8 + place + 1), np.where(none, 0, points))


def draws(seed: int, ids: list) -> np.ndarray:
    """Four numbers per id: the first 8-digit groups of the hex SHA-256 of
    ``seed:id``, as unsigned integers.  A null id counts as no digits."""
    raw = b"".join(hashlib.sha256(b"%d:%s" % (seed, b"" if i is None else b"%d" % i)).digest()[:16]
                   for i in ids)
    return np.frombuffer(raw, ">u4").reshape(-1, 4).astype(np.int64)


_OUT = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
        "output string")
_OUT_ARROW = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                        ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                        ("output", pa.string())])


def transformed(seed: int, fim_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, bounds in slices(batch.column("body")):
                ids = batch.column("doc_id").slice(row, len(bounds) - 1)
                units = Units(data, bounds)
                h = draws(seed, ids.to_pylist())
                x, y = h[:, 0] % (units.counts + 1), h[:, 1] % (units.counts + 1)
                one, one_points = units.after(np.minimum(x, y))
                two, two_points = units.after(np.maximum(x, y))
                raw, forms, outputs = data.tobytes(), [], []
                for s, e, a, b, p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist(), one.tolist(),
                                            two.tolist(), (h[:, 2] % 100).tolist(),
                                            (h[:, 3] % 100).tolist()):
                    text = raw[s:e]
                    if (p >= fim_percent or not text or PREFIX in text or SUFFIX in text
                            or MIDDLE in text):
                        forms.append("plain")
                    elif q < spm_percent:
                        forms.append("spm")
                        text = b"".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
                    else:
                        forms.append("psm")
                        text = b"".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))
                    outputs.append(text)
                plain = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(units.counts), pa.array(forms, pa.string()),
                     pa.array(one_points, mask=plain), pa.array(two_points - one_points, mask=plain),
                     pa.array(outputs, pa.binary()).cast(pa.string())], schema=_OUT_ARROW)

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row.

    ``n`` units; ``form`` is ``plain`` (the text itself: empty, holding a
    sentinel, or not drawn), ``psm`` or ``spm``.  Lengths are code points and
    null for plain rows.  Null texts count as empty; repeated rows come back
    as often, alike; a null id is drawn like an id without digits.  Other
    columns are not read.  Nothing is shuffled, and a row depends on its own
    id and text alone.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    return rows.mapInArrow(transformed(seed, fim_percent, spm_percent), _OUT)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text, from output and form alone.  Sentinels are found exactly:
    transformed texts hold none, and none can arise where parts meet."""
    parts = F.split(F.col(output), "<[PSM]>", -1)
    return (F.when(F.col(form) == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(F.col(form) == "spm", F.concat(parts[2], parts[3], parts[1]))
            .otherwise(F.col(output)))


def fim_report(docs: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them."""
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(), 256).alias("restored_sha256"))
