"""Scores against a plain model with exact counts in dictionaries."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from twinreach.llm import lm_score as lm
from twinreach.llm import queries
from twinreach.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
END, BEGIN = "end", "begin"


def token_list(text):
    return [*WORD.findall((text or "").encode().lower()), END]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


class Plain:
    """Interpolated absolute discounting over exact counts."""

    def __init__(self, docs, order):
        self.order, self.words = order, Counter()
        self.grams = defaultdict(Counter)
        for i, text in docs:
            if not is_held_out(i):
                for h, w in self.places(text):
                    self.words[w] += 1
                    for k in range(1, order):
                        self.grams[h[-k:]][w] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.d = {}
        for k in range(1, order):
            c = [x for h, f in self.grams.items() if len(h) == k for x in f.values()]
            ones, twos = c.count(1), c.count(2)
            self.d[k] = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.99)

    def places(self, text):
        words = [BEGIN] * (self.order - 1) + token_list(text)
        for i in range(self.order - 1, len(words)):
            yield tuple(words[i - self.order + 1:i]), words[i]

    def p(self, h, w):
        out = (self.words[w] + 0.1) / (self.n + 0.1 * (self.v + 1))
        for k in range(1, self.order):
            f = self.grams.get(h[-k:])
            if f:
                total, d = sum(f.values()), self.d[k]
                out = max(f[w] - d, 0) / total + d * len(f) / total * out
        return out

    def score(self, text):
        return sum(math.log10(self.p(h, w)) for h, w in self.places(text))

    def base(self, text):
        known = [self.words[w] for w in token_list(text)]
        size = self.n + 0.1 * (self.v + 1)
        return (len(known), sum(c > 0 for c in known), self.n,
                sum(math.log10((c + 0.1) / size) for c in known))


rng = random.Random(8)
VOCABULARY = [f"w{i}" for i in range(300)]


def sentence(n):
    at, out = rng.randrange(300), []
    for _ in range(n):
        at = (at * 7 + rng.choice((1, 2, 3, 50))) % 300  # few words follow each word
        out.append(VOCABULARY[at])
    return rng.choice((" ", "\n", " \t")).join(out)


DOCS = [(i, sentence(rng.randrange(80))) for i in range(400)]
DOCS += [(1000, None), (1001, ""), (1002, " \n "), (None, "w1 w2 W3"), (1003, "È É été"), (3, DOCS[3][1]),
         (1004, "w5 " * 30_000), (1005, " ".join(f"new{i}" for i in range(3000)))]
DOCS += [(2000 + i, "the very same text stands here") for i in range(200)]


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("row", "body", "score", "n", "held_out")]).repartition(3)
    return lm.lm_scores(df, **kw).collect()


def test_short_segments_give_the_same_scores(spark, monkeypatch):
    whole = {(r["doc_id"], r["n_tokens"]): r["score"] for r in run(spark, DOCS, bits=60, hashes=8)}
    monkeypatch.setattr(lm, "SEGMENT", 50)
    for out in lm.merged(1.5)(lm.counted(2, 3)([pa.RecordBatch.from_arrays(
            [pa.array([t.encode() for _, t in DOCS[:400]], pa.binary())], ["body"])])):
        assert len(out.column("keys")[0].as_py()) // 8 <= 50 + 400
    for r in run(spark, DOCS, bits=60, hashes=8):
        assert math.isclose(r["score"], whole[r["doc_id"], r["n_tokens"]], rel_tol=0.01, abs_tol=0.1)


@pytest.mark.parametrize("kw", [{}, {"most_frequent": 20}, {"order": 3, "most_frequent": 0}])
def test_base_is_exact_and_scores_are_near_the_plain_model(spark, kw):
    plain = Plain(DOCS, kw.get("order", 2))
    # small steps of the quantisation and a filter with hardly a false hit
    got = run(spark, DOCS, base=1.01 if not kw else 1.05, bits=40, hashes=8, **kw)
    texts = defaultdict(list)
    for i, t in DOCS:
        texts[i].append(t)
    assert len(got) == len(DOCS)
    for r in got:
        want = [(*plain.base(t), plain.score(t)) for t in texts[r["doc_id"]]]
        assert r["held_out"] == is_held_out(r["doc_id"])
        assert any((r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
                   and math.isclose(r["base_score"], w[3], rel_tol=1e-9)
                   and abs(r["score"] - w[4]) <= 0.03 * abs(w[4]) + 0.02 for w in want), (r, want)


# a level spans a factor of 1.5, so a count is off by half of that at most; a
# probability holds up to four counts (n-gram, history, its kinds, word)
STEP = math.log10(1.5)


def assert_near(plain, docs, got):
    off = []
    for i, t in docs:
        off.append(abs(got[i]["score"] - plain.score(t)) / len(token_list(t)))
        assert off[-1] <= 2 * STEP, (t, got[i])
    assert sum(off) / len(off) <= STEP / 2


def test_production_parameters_stay_near(spark):
    got = {r["doc_id"]: r for r in run(spark, DOCS)}
    assert_near(Plain(DOCS, 2), [(i, t) for i, t in DOCS if i is not None and i != 3], got)


def test_plain_model_adds_up_to_one():
    plain = Plain(DOCS, 3)
    for h in (("begin", "begin"), (b"w1", b"w8"), (b"w1", b"nowhere"), (b"nowhere", b"w9")):
        known = sum(plain.p(h, w) for w in plain.words)
        assert math.isclose(known + plain.p(h, b"unknown"), 1, rel_tol=1e-9)


def test_held_out_texts_score_better_than_by_single_words(spark):
    got = [r for r in run(spark, DOCS) if r["held_out"] and (r["doc_id"] or 0) < 400]
    assert len(got) > 20
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert gain > 0.5  # a factor of three per token


def test_left_out_levels_go_to_the_shorter_history(spark):
    whole, small = run(spark, DOCS, bits=40, hashes=8), run(spark, DOCS, bits=40, hashes=8, max_bytes=4000)
    assert {r["doc_id"] for r in whole} == {r["doc_id"] for r in small}
    base = {(r["doc_id"], r["n_tokens"]): r["base_score"] for r in whole}
    for r in small:
        assert math.isclose(r["base_score"], base[r["doc_id"], r["n_tokens"]], rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


@pytest.mark.parametrize("kw", [{"max_bytes": 4000}, {"max_bytes": 0}, {"max_bytes": 9000, "order": 3}])
def test_what_the_filter_lacks_is_looked_up(spark, monkeypatch, kw):
    """The scores are those of a filter that holds every level."""
    monkeypatch.setattr(lm, "BLOCK", 20_000)
    whole, small = ({(r["doc_id"], r["n_tokens"]): tuple(r) for r in run(spark, DOCS, bits=60, hashes=8, **k)}
                    for k in ({**kw, "max_bytes": lm.MAX_BYTES}, kw))
    assert whole.keys() == small.keys()
    for key, r in small.items():
        assert r[:5] == whole[key][:5] and math.isclose(r[5], whole[key][5], rel_tol=1e-9)
        assert math.isclose(r[6], whole[key][6], rel_tol=1e-6)


def test_no_training_rows_and_empty_table(spark):
    out = [i for i in range(100) if is_held_out(i)]
    for r in run(spark, [(i, "a b") for i in out]):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0)
        assert math.isclose(r["base_score"], 0, abs_tol=1e-12) and math.isclose(r["score"], 0, abs_tol=1e-12)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.lm_scores(df).collect() == []


def test_filter_never_misses_and_seldom_errs():
    r = np.random.default_rng(1)
    keys = r.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    counts = r.integers(1, 1000, 20_000)
    levels = lm.level_of(counts, 1.5)
    f = lm.Filter([(1, 0, lm.segment(keys, levels, 8, 4).tobytes())], 2, 4, 1.5)
    none = f.where(1, keys)
    found = f.levels(keys, none)
    assert (found >= levels).all() and (found > levels).mean() < 0.05
    assert (f.levels(r.integers(0, 1 << 63, 20_000, dtype=np.uint64), none) > 0).mean() < 0.05
    means = lm.level_means(1.5)
    assert means[1:5].tolist() == [1, 2, 3, 4.5]


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    plain = Plain(docs, 2)
    got = {r["doc_id"]: r for r in queries.op12_lm_scores(spark, SF).collect()}
    assert len(got) == len(docs)
    for i, t in docs:
        n, known, total, base = plain.base(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
    assert_near(plain, docs, got)


def small_model(order=2):
    counted = pa.Table.from_batches(lm.counted(order, 3)([pa.RecordBatch.from_arrays(
        [pa.array([t.encode() for _, t in DOCS if t], pa.binary())], ["body"])]))
    sums = list(lm.merged(1.5)(counted.sort_by([("part", "ascending"), ("kind", "ascending")]).combine_chunks().to_batches()))
    made = [tuple(v[0] for v in b.to_pydict().values()) for b in lm.built(1.5, 1, 8, 4)(sums)]
    return lm.Model(order, 1.5, len(DOCS), 1000, 100, {}, 1, lm.Filter(made, order, 4, 1.5))


@pytest.mark.parametrize("order", [2, 3])
def test_an_n_gram_of_a_run_is_looked_up_once(monkeypatch, order):
    model, asked = small_model(order), []
    levels = lm.Filter.levels
    monkeypatch.setattr(lm.Filter, "levels", lambda self, key, where: (asked.append(len(key)), levels(self, key, where))[1])
    texts = [t for _, t in DOCS if t][:30]
    body = pa.array([t.encode() for t in texts * 20], pa.binary())
    tokens_of = lm.tokens
    monkeypatch.setattr(lm, "tokens", lambda column, order: tokens_of(column, order, 1000))
    grams = set()
    for t in texts:
        tokens = [b"begin"] * (order - 1) + token_list(t)
        for k in range(1, order + 1):
            for i in range(order - 1, len(tokens)):
                grams |= {tuple(tokens[i - j] for j in range(k)), (k, *(tokens[i - j] for j in range(1, k)))}
    list(lm.scored(type("Sent", (), {"value": model}), np.empty(0, np.uint64), np.empty(0))(
        [pa.RecordBatch.from_arrays([pa.array(range(len(body))), pa.array(range(len(body))),
                                     pa.array([False] * len(body)), body], ["row", "doc_id", "held_out", "body"])]))
    assert len(asked) == 1 and asked[0] <= len(grams)


def test_levels_are_those_of_each_key_alone(monkeypatch):
    """Against probes of one key at a time, level by level and hash by hash."""
    model = small_model()
    found = model.filter
    rng = np.random.default_rng(5)
    (t, *_) = lm.tokens(pa.array([b" ".join(t.encode() for _, t in DOCS if t)], pa.binary()), 2, 1 << 30)
    history = np.sort(np.concatenate((t.histories[0], rng.integers(1, 1 << 63, 300, dtype=np.uint64))))
    where = found.where(2, history)
    key = lm.mix(history ^ lm._KINDS)
    bits = np.unpackbits(np.frombuffer(found.raw, np.uint8), bitorder="little")
    want = []
    for k, w in zip(key[:2000], where[:2000]):
        level = 0
        while all(bits[int(found.begin[w] + lm.places(np.array([k]), level + 1, found.size[w], i)[0])]
                  for i in range(found.hashes)):
            level += 1
        want.append(level)
    for probed in (1 << 40, 7):
        monkeypatch.setattr(lm, "PROBED", probed)
        assert found.levels(key[:2000], where[:2000]).tolist() == want
    assert max(want) > 3 and min(want) == 0


def test_sums_are_sorted_and_whole():
    rng = np.random.default_rng(3)
    key = rng.integers(0, 6, 500).astype(np.uint64) << np.uint64(61)
    word, n = rng.integers(0, 9, 500).astype("<u4"), rng.integers(1, 9, 500)
    want = defaultdict(int)
    for k, w, c in zip(key.tolist(), word.tolist(), n.tolist()):
        want[k, w] += c
    got = lm._summed(key, word, n)
    assert list(zip(*(c.tolist() for c in got))) == [(*k, c) for k, c in sorted(want.items())]
    assert [len(c) for c in lm._summed(key[:0], word[:0], n[:0])] == [0, 0, 0]
