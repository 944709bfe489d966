"""Token counts through a cache of content digests.

A count depends on the normalised content and on the tokenizer's version.
Documents are joined to the stored counts by (content digest, version
digest); only the distinct contents that miss are encoded, and their counts
are appended to the cache, so a later run over grown data encodes what is new.

Normalising collapses runs of the white-space that the vocabulary's own
pattern drops.  Digests are taken once, into a narrow table of ids, lengths
and digests, and only that is shuffled for the lookup; texts are shuffled
once, for the rows that stand for a missing content.

Inside a task a text is encoded piece by piece: the vocabulary's split
pattern never crosses white-space, so the pieces' ids in a row are the
text's ids.  A bounded memo keeps the ids of pieces seen.  A new piece of
plain letters, digits and marks goes to the vocabulary's model at once: what
the normalizer and the split pattern do to it is known.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import stored, tidy
from twinreach.llm.words import PIECE, Words, slices
from twinreach.session import scratch_path

# a vocabulary file is sent to the tasks; one beyond this is refused
MAX_VOCABULARY = 64 << 20
# what an encoder keeps: pieces of 16 bytes each, and their ids of 4 bytes each
MEMO_PIECES = 600_000
MEMO_IDS = 4 << 20
RECENT = 1 << 15  # pieces learned before they join the others

# settings for which ``PLAIN`` parts are what the split pattern gives, and
# ``LETTERS`` what the normalizer and the byte alphabet make of them
SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
# runs of ASCII and Latin-1 letters, single digits, runs of ASCII marks; no
# apostrophe (it begins 's, 't ...), and no < or | (special strings have them)
PLAIN = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9]|[!-&(-/:;=-@\[-`{}~]+")


def _byte_alphabet(n: int) -> str:
    own = 33 <= n <= 126 or 161 <= n <= 172 or 174 <= n <= 255
    return chr(n) if own else chr(256 + (n if n <= 32 else n - 127 + 33 if n <= 160 else 67))


LETTERS = {c: "".join(map(_byte_alphabet, chr(c).lower().encode())) for c in (*range(0x41, 0x5B), *range(0xC0, 0x100))}


def plain_settings(raw: bytes) -> bool:
    """Whether a vocabulary splits and normalizes by ``SETTINGS``."""
    known = json.loads(raw)
    return (all(known.get(k) == v for k, v in SETTINGS.items()) and known["model"].get("type") == "BPE"
            and all("<" in t["content"] or "|" in t["content"] for t in known.get("added_tokens", ())))


def vocabulary(path: str) -> bytes:
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    with open(path, "rb") as f:
        return f.read()


def version_digest(raw: bytes) -> str:
    """Digest of the vocabulary and of the library that applies it."""
    import tokenizers

    return hashlib.sha256(raw + tokenizers.__version__.encode()).hexdigest()


class PieceEncoder:
    """Ids of texts, by pieces between blanks, line ends and tabs, and between
    an ASCII letter or digit and a mark such as a comma: the vocabulary's
    split pattern begins anew at all of these.

    Pieces are told apart by 64-bit hashes.  The memo holds the hashes in
    order, and where the ids of each piece lie in one long array (without
    ``keep_ids``, only how many there are).  New pieces stand apart and join
    the others some thousands at a time.  The memo starts anew when it is
    full, so it takes some 10 MB for the pieces and 16 MB for their ids.
    """

    def __init__(self, raw: bytes, keep_ids: bool, most: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(raw.decode())
        self.model = self.tokenizer.model if plain_settings(raw) else None
        self.keep_ids, self.most = keep_ids, most
        self._reset()

    def _reset(self) -> None:
        none = np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint32)
        self.known, self.recent = none, none  # keys in order, begins, sizes
        self.ids, self.used = np.empty(1 << 16, np.uint32), 0

    @staticmethod
    def _joined(some: tuple, more: tuple) -> tuple:
        keys = np.concatenate((some[0], more[0]))
        order = np.argsort(keys, kind="stable")
        return keys[order], *(np.concatenate((a, b))[order] for a, b in zip(some[1:], more[1:]))

    def _plain(self, piece: str) -> list[int] | None:
        """Ids of a piece that ``PLAIN`` covers."""
        if piece.isascii() and piece.isalpha():
            return [t.id for t in self.model.tokenize(piece.lower())]
        parts = PLAIN.findall(piece)
        if sum(map(len, parts)) < len(piece):
            return None
        return [t.id for part in parts for t in self.model.tokenize(part.translate(LETTERS))]

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Encode new pieces; ``keys`` are in order."""
        found = [self._plain(p) for p in pieces] if self.model else [None] * len(pieces)
        others = [i for i, ids in enumerate(found) if ids is None]
        for at in range(0, len(others), 4096):
            some = others[at:at + 4096]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([pieces[i] for i in some],
                                                                   add_special_tokens=False)):
                found[i] = e.ids
        sizes = list(map(len, found))
        ids = list(chain.from_iterable(found)) if self.keep_ids else []
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.ids[self.used:self.used + len(ids)] = ids
        new = np.array(sizes, np.int64)
        begins = (self.used + np.cumsum(new) - new if self.keep_ids else np.zeros(len(new)))
        self.used += len(ids)
        self.recent = self._joined(self.recent, (keys, begins.astype(np.uint32), new.astype(np.uint32)))

    @staticmethod
    def _found(memo: tuple, keys: np.ndarray, begins: np.ndarray, sizes: np.ndarray,
               missing: np.ndarray) -> None:
        """Fill in what ``memo`` has of ``keys``."""
        if len(memo[0]):
            at = np.minimum(np.searchsorted(memo[0], keys), len(memo[0]) - 1)
            hit = memo[0][at] == keys
            begins[hit], sizes[hit] = memo[1][at[hit]], memo[2][at[hit]]
            missing &= ~hit

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
        """(number of texts, words, ids per word, where a word's ids begin in
        ``self.ids``) for runs of the column's texts, in order."""
        for _, data, bounds in slices(column):
            # special strings are known by their case, so it is kept near one
            special = b"<|" in data.tobytes()
            words = Words(data, bounds, PIECE, lower=not special, parted=True)
            if len(self.known[0]) + len(self.recent[0]) > self.most or self.used > MEMO_IDS:
                self._reset()
            elif len(self.recent[0]) > RECENT:
                self.known, self.recent = self._joined(self.known, self.recent), tuple(
                    c[:0] for c in self.recent)
            keys, first, place = np.unique(words.hash, return_index=True, return_inverse=True)
            begins, counts = np.zeros((2, len(keys)), np.int64)
            missing = np.ones(len(keys), bool)
            for memo in (self.known, self.recent):
                self._found(memo, keys, begins, counts, missing)
            if missing.any():
                raw, new = words.raw(), first[missing]
                self._learn(keys[missing], [raw[s:e].decode("utf-8") for s, e in zip(
                    words.start[new].tolist(), words.end[new].tolist())])
                self._found(self.recent, keys, begins, counts, missing)
            yield len(bounds) - 1, words, counts[place], begins[place]


def count_batches(raw: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = PieceEncoder(raw, keep_ids=False)
        for batch in batches:
            counts = [np.empty(0, np.int64)]
            for texts, words, sizes, _ in encode(batch.column("body")):
                counts.append(np.bincount(words.text, sizes, texts).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("content"), pa.array(np.concatenate(counts))], ["content", "n_tokens"])

    return run


def counted(docs: DataFrame, vocabulary_path: str, cache_path: str,
            text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` per row of ``docs`` (``n_bytes`` in UTF-8);
    missing counts are added to ``cache_path``.

    Every row of the input comes back, repeated rows too.  Null counts as
    empty: 0 bytes, 0 tokens.  The cache is a Parquet table (version, content,
    n_tokens); a folder that does not exist yet is an empty cache.
    """
    spark = docs.sparkSession
    raw = vocabulary(vocabulary_path)
    version = version_digest(raw)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # ``mark`` tells texts of one id apart, at less than a digest's cost
    mark = F.xxhash64(text)
    content = F.unhex(F.sha2(F.regexp_replace(text, r"[\x20\x09\x0A\x0D]+", " "), 256))
    narrow = stored(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
                                mark.alias("mark"), content.alias("content")), "token-digests")
    known = _cache(spark, cache_path).where(F.col("version") == version).select("content", "n_tokens")
    # one row stands for each content that misses
    firsts = (narrow.groupBy("content").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
              .join(known, "content", "left_anti")
              .select(F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark"), "content"))
    texts = docs.select("doc_id", mark.alias("mark"), text.cast("binary").alias("body"))
    misses = texts.join(firsts, F.col("doc_id").eqNullSafe(F.col("_id"))
                        & (F.col("mark") == F.col("_mark")))
    fresh = (misses.select("content", "body")
             .mapInArrow(tidy(count_batches(raw)), "content binary, n_tokens long")
             # repeated rows of one id and content
             .dropDuplicates(["content"]))
    fresh.select(F.lit(version).alias("version"), "content", "n_tokens").write.mode(
        "append").parquet(cache_path)
    known = (_cache(spark, cache_path).where(F.col("version") == version)
             .groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))
    # as a table, so that contents held by many rows can be split in the join
    known = stored(known, "token-known")
    return narrow.join(known, "content").select("doc_id", "n_bytes", "n_tokens")


def _cache(spark, path: str) -> DataFrame:
    schema = "version string, content binary, n_tokens long"
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def token_counts(docs: DataFrame, vocabulary_path: str, cache_path: str | None = None,
                 limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``; without
    ``cache_path`` the cache is a new table in the checkpoint folder."""
    path = cache_path or scratch_path(docs.sparkSession, "token-cache")
    return counted(docs, vocabulary_path, path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
