"""Toxicity by a weighted finite-state pattern grammar.

A clause is read as a string of word classes: insult, threat, target,
negation, report, other.  Three sequential transducers rewrite it: negation
marks what stands in its scope, reported speech marks what follows the
reporting verb, and target marks insults and threats near somebody they are
aimed at.  Their composition is one transducer whose output symbols are
matched patterns ("insult", "insult, negated", "threat, at a target", ...).
Words score only as parts of matched patterns of their clause.

Both kinds of weights are learned from labelled rows:

* the lexicon, a trie of words and word beginnings, with the lower bound of
  the log odds between toxic and other documents (plus a short fixed list);
* the weight of each pattern, by logistic regression on the sums of lexicon
  weights per pattern, with the length of the text.

Labels are read only for rows that are not held out, at most ``max_fit`` of
them (those with the smallest hash of the id).  Language, source, id and
labels are not inputs of a score.  Every document is scored on its whole text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import stored, tidy

MAX_FIT = 20_000
MAX_LEXICON = 50_000
MIN_TOXIC = 3
SURE = 2.5  # standard errors taken off a log odds
LEAST_WEIGHT = 0.5
PREFIXES = range(3, 9)
SCOPE = 3  # words a negation reaches
REACH = 4  # words a target reaches, either way
LONGEST_CLAUSE = 60  # words; a longer one is read in parts of this length

# Fixed word lists of the grammar's classes (English, German, French, Spanish).
INSULTS = ("idiot moron stupid dumb fool loser clown trash scum pathetic disgusting worthless "
           "imbecile bastard dumm trottel abschaum imbécile débile ordure idiota imbécil basura").split()
THREATS = ("kill hurt destroy murder beat burn punish shoot stab strangle töten umbringen tuer "
           "frapper matar golpear").split()
TARGETS = ("you your yours he she they them him her these those people du dich ihr euch sie tu toi "
           "vous ils elles tú usted ustedes ellos ellas").split()
NEGATIONS = "not no never none nor neither nicht kein keine nie pas jamais ne nunca jamás ni".split()
REPORTS = ("said says say told called quoted quote reported reports wrote claimed sagte sagt schrieb "
           "dit écrit déclaré dijo dice escribió").split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = "other insult threat target negation report end".split()
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:]")
ENDS = frozenset(".!?;:")
PLAIN = (OTHER, 0.0, "")


@dataclass
class Transducer:
    """Sequential transducer: one arc per (state, input symbol)."""

    start: object
    arcs: dict = field(default_factory=dict)  # (state, symbol) -> (state, symbol)

    def then(self, other: Transducer) -> Transducer:
        """Composition: ``other`` reads what this one writes."""
        out = Transducer((self.start, other.start))
        todo, done = [out.start], set()
        inputs = sorted({s for _, s in self.arcs})
        while todo:
            state = todo.pop()
            if state in done:
                continue
            done.add(state)
            for symbol in inputs:
                p, middle = self.arcs[state[0], symbol]
                q, result = other.arcs[state[1], middle]
                out.arcs[state, symbol] = ((p, q), result)
                todo.append((p, q))
        return out

    def numbered(self) -> Transducer:
        """The same with integer states, the start being 0."""
        names = {self.start: 0}
        for state, _ in self.arcs:
            names.setdefault(state, len(names))
        return Transducer(0, {(names[s], x): (names[t], y) for (s, x), (t, y) in self.arcs.items()})


WORDS = (OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT)


def negation() -> Transducer:
    """Insults and threats up to SCOPE words after a negation are negated."""
    t = Transducer(0)
    for left in range(SCOPE + 1):
        for word in WORDS:
            after = SCOPE if word == NEGATION else max(0, left - 1)
            marked = left and word in (INSULT, THREAT)
            t.arcs[left, word] = (after, f"{word} negated" if marked else word)
    return t


def reported(inputs) -> Transducer:
    """Insults and threats after a reporting verb are somebody else's."""
    t = Transducer(False)
    for inside in (False, True):
        for word in inputs:
            marked = inside and word.split()[0] in (INSULT, THREAT)
            t.arcs[inside, word] = (inside or word == REPORT, f"{word} reported" if marked else word)
    return t


def targeted(inputs) -> Transducer:
    """Insults and threats near a target are aimed.  The state holds how far
    the last target and the last pattern reach; a target that comes after its
    pattern is written as ``aimed``."""
    t = Transducer((0, 0))
    for target in range(REACH + 1):
        for pattern in range(REACH + 1):
            for word in inputs:
                hit = word.split()[0] in (INSULT, THREAT)
                state = (REACH if word == TARGET else max(0, target - 1),
                         REACH if hit else 0 if word == TARGET else max(0, pattern - 1))
                out = word
                if hit and target:
                    out = f"{word} aimed"
                elif word == TARGET and pattern:
                    out = "aimed"
                t.arcs[(target, pattern), word] = (state, out)
    return t


def grammar() -> Transducer:
    first = negation()
    second = reported(sorted({y for _, y in first.arcs.values()}))
    both = first.then(second)
    third = targeted(sorted({y for _, y in both.arcs.values()}))
    return both.then(third).numbered()


PATTERNS = sorted(f"{w}{n}{r}{a}" for w in (INSULT, THREAT) for n in ("", " negated")
                  for r in ("", " reported") for a in ("", " aimed"))
FEATURES = [*PATTERNS, "aimed", "clauses", "strongest", "spread", "density", "length"]


class Lexicon(dict):
    """Piece of text between blanks -> None when it is one plain word, else
    (has a pattern, has a clause end, [(class, weight, word)]).  A piece is
    taken apart once and kept while there is room."""

    MOST = 150_000

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned
        self.fixed = {}
        for kind, words, weight in ((INSULT, INSULTS, 2.0), (THREAT, THREATS, 2.0),
                                    (TARGET, TARGETS, 0.0), (NEGATION, NEGATIONS, 0.0),
                                    (REPORT, REPORTS, 0.0)):
            for w in words:
                self.fixed[w] = (kind, weight)
        # a word that begins unlike every entry is plain
        self.heads = {w[:3] for w in self.fixed} | {f.rstrip("*")[:3] for f in learned} | ENDS

    def word(self, word: str) -> tuple[str, float, str]:
        if word[:3] not in self.heads:
            return PLAIN
        kind, weight = self.fixed.get(word, (OTHER, 0.0))
        if word in ENDS:
            kind = END
        elif kind in (OTHER, INSULT):
            # the trie: the best weight among the word and its beginnings
            best = max((self.learned.get(f, 0.0) for f in word_features(word)), default=0.0)
            if max(best, weight) > 0:
                kind, weight = INSULT, max(best, weight)
        return kind, weight, word

    def __missing__(self, piece: str):
        if len(self) > self.MOST:
            self.clear()
        lower = piece.lower()
        read = [self.word(w) for w in ([lower] if lower.isalpha() else TOKEN.findall(lower))]
        kinds = {k for k, _, _ in read}
        value = None if len(read) == 1 and kinds == {OTHER} else (
            INSULT in kinds or THREAT in kinds, END in kinds, read)
        self[piece] = value
        return value


def word_features(word: str) -> list[str]:
    """The word itself and its beginnings (marked with a star)."""
    return [word, *(word[:k] + "*" for k in PREFIXES if k <= len(word))]


def _clause(read: list, hit: int, least: int) -> tuple[list, int]:
    """The words of the pieces around ``hit`` up to a clause end on either
    side, and the first piece after them; pieces before ``least`` are used up."""
    first = hit
    while first > least and hit - first < LONGEST_CLAUSE:
        if read[first - 1] is not None and read[first - 1][1]:
            break
        first -= 1
    last = hit
    while last < len(read) and last - hit < LONGEST_CLAUSE:
        last += 1
        if read[last - 1] is not None and read[last - 1][1]:
            break
    words = []
    for piece in read[first:last]:
        words += [PLAIN] if piece is None else piece[2]
    return words, last


def features(text: str, lexicon: Lexicon, machine: Transducer) -> list[float]:
    pieces = text.replace("\n", " ; ").split()
    read = [lexicon[p] for p in pieces]
    sums = dict.fromkeys(FEATURES, 0.0)
    kinds = set()
    at = 0
    for hit in [i for i, piece in enumerate(read) if piece is not None and piece[0]]:
        if hit < at:
            continue  # in a clause already read
        words, at = _clause(read, hit, at)
        state = machine.start
        for kind, weight, word in words:
            if kind == END:  # inside of a piece
                state = machine.start
                continue
            state, out = machine.arcs[state, kind]
            if out in sums:
                sums[out] += weight if out != "aimed" else 1.0
                sums["strongest"] = max(sums["strongest"], weight)
                kinds.add(word)
        sums["clauses"] += 1.0
    total = sum(sums[p] for p in PATTERNS)
    out = [math.log1p(sums[f]) for f in FEATURES[:-4]]
    return [*out, sums["strongest"], math.log1p(len(kinds)),
            math.log1p(100.0 * total / (len(read) + 1)), math.log1p(len(read))]


def held_out(doc_id) -> F.Column:
    """Rows whose crc32 of the id, as text, is 2 modulo 4; a null id is not."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have each word or beginning."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 1000):
            part = batch.slice(begin, 1000)
            counts = Counter(), Counter()
            memo: dict[str, list[str]] = {}
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                found: set[str] = set()
                for w in set(TOKEN.findall((text or "").lower())):
                    if w not in memo:
                        memo[w] = word_features(w)
                    found.update(memo[w])
                counts[1 if toxic else 0].update(found)
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([counts[1][n] for n in names], pa.int64()),
                 pa.array([counts[0][n] for n in names], pa.int64())], ["feature", "a", "b"])


def learn_lexicon(rows: DataFrame, max_lexicon: int = MAX_LEXICON) -> dict[str, float]:
    """Feature -> weight, from rows (text, toxic); at most ``max_lexicon``."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("toxic"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(True, 0) + 1.0, sizes.get(False, 0) + 1.0
    counts = (rows.select("text", "toxic").mapInArrow(tidy(_counted), "feature string, a long, b long")
              .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .where(F.col("a") >= MIN_TOXIC))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    weight = F.log(a / n1) - F.log(b / n0) - SURE * F.sqrt(1 / a + 1 / b)
    best = (counts.select("feature", weight.alias("w")).where(F.col("w") >= LEAST_WEIGHT)
            .orderBy(F.desc("w"), "feature").limit(max_lexicon))
    return {r["feature"]: r["w"] for r in best.collect()}


def _features(learned: dict[str, float], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, machine = Lexicon(learned), grammar()
        for batch in batches:
            x = [features(t or "", lexicon, machine) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(x, pa.list_(pa.float64()))],
                [*columns, "x"])

    return run


@dataclass
class Model:
    learned: dict[str, float]
    weights: list[float]
    bias: float


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> Model:
    """Lexicon and pattern weights from at most ``max_fit`` labelled rows that
    are not held out.  Without labels of both kinds only the fixed lists are
    used, with even weights."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = (known.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", "doc_id").limit(max_fit)
              .select(F.col("doc_id").alias("_id"), "toxic"))
    # at most max_fit rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    rows = stored(rows.select("doc_id", "text", "toxic"), "toxicity-fit")
    learned = learn_lexicon(rows)
    got = (rows.mapInArrow(tidy(_features(learned, ["doc_id", "toxic"])),
                           "doc_id long, toxic int, x array<double>")
           .dropDuplicates(["doc_id"]).orderBy("doc_id").collect())  # one row per sampled id
    y = np.array([float(r["toxic"] > 0) for r in got])
    if len(y) == 0 or y.min() == y.max():
        weights = [1.0 if f in PATTERNS else 0.0 for f in FEATURES]
        return Model(learned, weights, -2.0)
    weights, bias = logistic(np.array([r["x"] for r in got]), y)
    return Model(learned, weights, bias)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[list[float], float]:
    """Ridge logistic regression by Newton steps on standardised columns."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9),
                               z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights.tolist(), float(w[-1] - (weights * mean).sum())


def _scores(model: Model):
    """Function from texts to an array of scores, with its own lexicon."""
    lexicon, machine, weights = Lexicon(model.learned), grammar(), np.array(model.weights)

    def scores(texts: pa.Array) -> np.ndarray:
        x = np.array([features(t or "", lexicon, machine) for t in texts.to_pylist()])
        x = x.reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ weights + model.bias, -30, 30)))

    return scores


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
             max_fit: int = MAX_FIT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Null and empty texts get the score of a text without matches.  Repeated
    rows are scored alike.  A null id is not held out and never learned from.
    Other columns of either table are not read; empty tables are allowed.
    """
    model = fit(docs, labels, max_fit)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"),
                 pa.array(scores(batch.column("text")))], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    out = rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                    max_fit: int = MAX_FIT) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, unchanged."""
    model = fit(docs, labels, max_fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(model)
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column("text")) < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)
