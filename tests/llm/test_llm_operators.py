"""Operators against plain versions, on the small tables and on edge cases:
nulls, empty and very long texts, ties, repeated rows, empty tables, and
columns whose names an operator uses itself."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from twinreach.llm import (decontaminate, exact_dedup, line_dedup, ngram_join, packing, queries,
                           sharding, token_counts, toxicity, url_lists, warc)
from twinreach.llm.common import ranked_within, table
from twinreach.plans.compare import compare

SF = "/root/testdata/sf0.001"
CLASH = ["row", "name", "shard", "slot", "n_lines", "_keep", "level", "rep", "body", "_class"]


def frame(spark, rows, schema="doc_id long, text string"):
    """Rows with further columns that have names an operator uses itself."""
    df = spark.createDataFrame(rows, schema)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH])


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]


rng = random.Random(5)
WORDS = [f"w{i}" for i in range(40)]
LONG = " ".join(rng.choice(WORDS) for _ in range(60_000))
EDGE = [(1, None), (2, ""), (3, "  \n\t "), (4, "a"), (5, "A\nb \nA"), (6, "same text, here"),
        (7, "same  text,\nhere"), (8, "sametext,here"), (8, "sametext,here"), (None, "no id"),
        (None, None), (9, LONG), (10, LONG + " end"), (11, "😀é" * 3000), (12, "x" * 5000)]


@pytest.fixture(scope="module")
def edge(spark):
    return frame(spark, EDGE)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, duck_small, name):
    assert compare(queries.QUERIES[name](spark, SF), duck_small, queries.ORACLE[name]) == []


# -- ranks ----------------------------------------------------------------------

def test_ranks_are_gapless_in_every_group(spark):
    df = spark.range(3000).select((F.col("id") % 3 * F.col("id") % 2).alias("g"),
                                  (F.col("id") % 7).alias("o"), "id")
    got = defaultdict(list)
    for g, o, _, r in rows_of(ranked_within(df, ["g"], ["o"], "r", "test")):
        got[g].append((r, o))
    for pairs in got.values():
        pairs.sort()
        assert [r for r, _ in pairs] == list(range(len(pairs)))
        assert [o for _, o in pairs] == sorted(o for _, o in pairs)


# -- 1 --------------------------------------------------------------------------

PAGES = [(1, "http://a/x", "p" * 2000), (2, "http://a/y", "p" * 2000), (3, None, None),
         (4, "http://b\r\nEvil: 1", ""), (5, "http://c", "small"), (6, "http://c", "small"),
         (7, "u", "é" * 600 + "\r\n\r\nWARC/1.1"), (8, "u", "p" * 2000), (8, "u", "p" * 2000),
         (None, "u", "p" * 2000)]


def test_warc_round_trip(spark):
    pages = frame(spark, PAGES, "page_id long, url string, html string").repartition(3)
    # archives of at most a few records
    index, records = warc.archive_round_trip(pages, archive_bytes=3000)
    got = rows_of(records)
    assert len(got) == len(PAGES)
    kinds = Counter((r[0], r[3], r[4]) for r in got)
    assert kinds == Counter({(1, "revisit", 8): 1, (2, "revisit", 8): 1, (3, "response", None): 1,
                             (4, "response", None): 1, (5, "response", None): 1,
                             (6, "response", None): 1, (7, "response", None): 1,
                             (8, "response", None): 1, (8, "revisit", 8): 1,
                             (None, "revisit", 8): 1})
    want = {p: (h or "").encode() for p, _, h in PAGES}
    for page, size, digest, _, _ in got:
        assert (size, digest) == (len(want[page]), hashlib.sha1(want[page]).hexdigest())
    assert index.count() == len(PAGES)
    by_archive = defaultdict(list)
    for archive, _, offset, length in rows_of(index):
        by_archive[archive].append((offset, length))
    assert len(by_archive) > 1
    for places in by_archive.values():  # members follow each other without a gap
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]


def test_warc_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert rows_of(warc.warc_report(empty)) == []


def test_cut_off_archives_are_refused():
    import gzip

    for whole in (gzip.compress(b"record" * 4000), gzip.compress(b"a" * 50) + gzip.compress(b"b" * 5000)):
        assert b"".join(warc.inflated(iter([whole])))
        assert b"".join(warc.inflated(iter([whole[:30], whole[30:]])))
        for end in (len(whole) - 1, len(whole) - 8, len(whole) - 12):  # trailer or data missing
            with pytest.raises(ValueError, match="cut off"):
                list(warc.inflated(iter([whole[:end]])))
    assert list(warc.inflated(iter([]))) == []


def test_inflating_takes_one_member_or_many():
    parts = [b"one" * 1000, b"", b"two" * 500]
    z = b""
    for p in parts:
        c = zlib.compressobj(6, zlib.DEFLATED, 31)
        z += c.compress(p) + c.flush()
    chunks = [z[i:i + 7] for i in range(0, len(z), 7)]
    assert b"".join(warc.inflated(iter(chunks))) == b"".join(parts)


# -- 2 --------------------------------------------------------------------------

def test_lines_against_brute_force(spark, docs):
    got = {r[0]: r[1:] for r in rows_of(line_dedup.line_report(frame(spark, docs)))}
    assert got == brute.lines(docs)


def test_lines_edge_cases(spark, edge, none):
    got = rows_of(line_dedup.line_report(edge, min_docs=2))
    assert len(got) == len(EDGE)
    assert (1, 1, 0, brute.sha(b"")) in got and (2, 1, 0, brute.sha(b"")) in got
    assert (3, 2, 0, brute.sha(b"  \n\t ")) in got
    # "a" is in 4 and 5; a repeated row is no second document
    assert (4, 1, 1, brute.sha(b"")) in got and (5, 3, 2, brute.sha(b"b ")) in got
    assert got.count((8, 1, 0, brute.sha(b"sametext,here"))) == 2
    assert rows_of(line_dedup.line_report(none)) == []
    maps = rows_of(line_dedup.keep_bitmaps(edge, min_docs=2))
    assert {(m[0], m[2], m[3], tuple(line_dedup.stays(m[4], m[2]))) for m in maps} == {
        (4, 1, 1, (0,)), (5, 3, 2, (0, 1, 0))}
    out = line_dedup.without_repeated_lines(edge, min_docs=2)
    assert {r["_keep"] for r in out.collect()} == {"own _keep"}


@pytest.mark.parametrize("seed", range(6))
def test_streaming_over_cut_partitions(seed):
    """However sorted rows are cut into partitions and batches, drops are
    those of hashes with enough documents."""
    r = random.Random(seed)
    rows = sorted({(r.randrange(4), 0, r.choice([*range(30), None]), 0) for _ in range(90)},
                  key=lambda x: (x[0], x[2] is not None, x[2] or 0))
    rows = [x for x in rows for _ in range(r.choice([1, 1, 2]))]  # repeated rows
    counts = Counter(h for h, *_ in dict.fromkeys(rows))
    frequent = {h for h, n in counts.items() if n >= 10}
    # equal rows are never cut apart: the sort key is the range key
    cuts = sorted({i for i in r.sample(range(len(rows)), 5) if i and rows[i] != rows[i - 1]})
    marks = []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        part, batches = rows[a:b], []
        while part:
            k = r.randint(1, 7)
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in part[:k]], pa.int64()) for i in range(4)]
                + [pa.array([b""] * len(part[:k])), pa.array([1] * len(part[:k]), pa.int32())],
                schema=line_dedup._KEYS_ARROW))
            part = part[k:]
        for out in line_dedup.streamed(10)(iter(batches)):
            marks += out.to_pylist()
    total = Counter()
    for m in marks:
        if m["kind"] == line_dedup.COUNT:
            total[m["h1"]] += m["n"]
    late = {h for h, n in total.items() if n >= 10}
    dropped = [(m["h1"], m["id"]) for m in marks if m["kind"] == line_dedup.DROP
               or m["kind"] == line_dedup.OPEN and m["h1"] in late]
    assert sorted(dropped, key=str) == sorted(
        [(x[0], x[2]) for x in dict.fromkeys(rows) if x[0] in frequent], key=str)


# -- 3 --------------------------------------------------------------------------

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def check_packing(pieces, docs):
    ids = defaultdict(list)
    for d, text in docs:
        ids[d].append(np.array(library().encode(text or "", add_special_tokens=False).ids + [1], "<u4"))
    covered, sequences = defaultdict(Counter), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in pieces:
        own = [x for x in ids[doc] if len(x) == tokens
               and zlib.crc32(x[start:start + length].tobytes()) == crc]
        assert own and 0 < length <= 2048
        covered[doc][start, length] += 1
        sequences[sequence].append((offset, length))
    for doc, texts in ids.items():
        total = sum(n * c for (_, n), c in covered[doc].items())
        assert total == sum(map(len, texts))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    return len(sequences), sum(p[2] for p in pieces)


def test_packing_small_table(spark, docs):
    n, tokens = check_packing(rows_of(packing.pack_documents(
        frame(spark, docs), queries.vocabulary_path())), docs)
    assert n <= tokens / 2048 * 1.03 + 1


def test_packing_edge_cases(spark, edge, none):
    check_packing(rows_of(packing.pack_documents(edge, queries.vocabulary_path())), EDGE)
    assert rows_of(packing.pack_documents(none, queries.vocabulary_path())) == []


def test_knapsack_against_enumeration():
    r = random.Random(2)
    for _ in range(20):
        sizes = np.array(r.sample(range(1, 9), 4))
        values = np.array([r.random() for _ in sizes])
        best = [0.0] * 18
        for w in range(1, 18):
            best[w] = max([best[w - 1]] + [best[w - s] + v for s, v in zip(sizes, values) if s <= w])
        value, counts = packing.knapsack(sizes, values, 17)
        assert math.isclose(value, best[17]) and math.isclose(counts @ values, value)
        assert counts @ sizes <= 17


@pytest.mark.parametrize("seed", range(4))
def test_patterns_use_up_the_demand(seed):
    r = np.random.default_rng(seed)
    sizes = np.sort(r.choice(np.arange(1, 65), 20, replace=False))
    demand = r.integers(0, 200, 20) + 1
    plan = packing.patterns(sizes, demand, 64)
    assert (sum(c * n for c, n in plan) == demand).all()
    assert all(c @ sizes <= 64 for c, _ in plan)
    # no worse than first-fit decreasing
    bins = []
    for size in sorted(np.repeat(sizes, demand).tolist(), reverse=True):
        at = next((i for i, room in enumerate(bins) if room >= size), None)
        if at is None:
            bins.append(64 - size)
        else:
            bins[at] -= size
    assert sum(n for _, n in plan) <= len(bins) + 1


# -- 4 --------------------------------------------------------------------------

def test_composition_is_one_after_the_other():
    r = random.Random(1)
    first = toxicity.negation()
    second = toxicity.reported(sorted({y for _, y in first.arcs.values()}))
    third = toxicity.targeted(sorted({y for _, y in first.then(second).arcs.values()}))
    whole = toxicity.grammar()
    for _ in range(200):
        word = [r.choice(toxicity.WORDS) for _ in range(12)]
        chain = word
        for t in (first, second, third):
            state, out = t.start, []
            for symbol in chain:
                state, y = t.arcs[state, symbol]
                out.append(y)
            chain = out
        state, got = whole.start, []
        for symbol in word:
            state, y = whole.arcs[state, symbol]
            got.append(y)
        assert got == chain


def test_grammar_reads_clauses():
    lexicon, machine = toxicity.Lexicon({"zork*": 3.0}), toxicity.grammar()

    def matched(text):
        x = dict(zip(toxicity.FEATURES, toxicity.features(text, lexicon, machine)))
        return {p for p in (*toxicity.PATTERNS, "aimed") if x[p] > 0}

    assert matched("what a zorkling.") == {"insult"}
    assert matched("you are a zorkling") == {"insult aimed"}
    assert matched("not a zorkling") == {"insult negated"}
    assert matched("not here. a zorkling") == {"insult"}
    assert matched("it was said: zorkling") == {"insult"}
    assert matched("it was said that zorkling") == {"insult reported"}
    assert matched("I will hurt you") == {"threat", "aimed"}
    assert matched("nothing of the kind") == set()


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    return rows_of(queries.QUERIES["op4_toxicity"](spark, sf)), {
        r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}


def test_held_out_accuracy(scored):
    rows, labels = scored
    held = [(s, labels[d]) for d, h, s, _ in rows if h and d in labels]
    assert all(h == (zlib.crc32(str(d).encode()) % 4 == 2) for d, h, _, _ in rows)
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    above = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert above >= 0.75
    assert sum((s >= 0.3) == y for s, y in held) / len(held) >= 0.9


def test_held_out_labels_and_other_columns_are_not_read(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flip = F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    other = docs.select("doc_id", "text", F.lit("zz").alias("lang"), F.lit(0).alias("score"))
    a = sorted(rows_of(toxicity.toxicity(docs, labels)))
    b = sorted(rows_of(toxicity.toxicity(other, labels.withColumn("toxic", flip.cast("int")))))
    assert a == b


def test_toxicity_edge_cases(spark, edge, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rows_of(toxicity.toxicity(edge, labels))
    assert len(got) == len(EDGE) and all(0 <= r[2] <= 1 for r in got)
    assert {r[2] for r in got if r[0] in (1, 2)} == {r[2] for r in got if r[0] == 1}
    assert rows_of(toxicity.toxicity(none, labels)) == []
    twice = spark.createDataFrame([(4, 1, 0), (4, 1, 1), (5, 0, 0), (None, 1, 1), (7, 1, None)],
                                  labels.schema)
    assert len(rows_of(toxicity.toxicity(edge, twice))) == len(EDGE)


# -- 5 --------------------------------------------------------------------------

def brute_exact(docs):
    groups = defaultdict(list)
    for i, (d, text) in enumerate(docs):
        body = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups[body].append((-len(text or ""), d is None, d or 0, i))
    out = []
    for body, members in groups.items():
        best = min(members)
        keep = docs[best[3]][0]
        out += [(docs[i][0], keep, len(members), brute.sha(body.encode())) for *_, i in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups_edge_cases(spark, edge, none, weak):
    """With a fingerprint that many blocks share, names come from the texts."""
    kind = {"fingerprint": lambda b: F.length(b).cast("long")} if weak else {}
    got = rows_of(exact_dedup.exact_groups(edge, block=100 if weak else 2048, **kind))
    want, groups = brute_exact(EDGE)
    assert sorted(((a, b, c, e) for a, b, c, _, e in got), key=str) == want
    assert sum(r[3] for r in got) == groups
    assert rows_of(exact_dedup.exact_groups(none, **kind)) == []


def test_blocks_of_mixed_width_text(spark):
    text = "é😀x" * 20_000
    df = spark.createDataFrame([(text,)], "t string")
    blocks = df.select(exact_dedup.cut_blocks(F.col("t"), 2048)).first()[0]
    assert "".join(blocks) == text and {len(b) for b in blocks[:-1]} == {2048}


# -- 6 --------------------------------------------------------------------------

def test_near_groups_small_table(spark, docs):
    got = {r[0]: r[1:] for r in rows_of(ngram_join.near_groups(frame(spark, docs)))}
    assert got == brute.components(docs)


def near_family(n, size, edits, seed):
    r = random.Random(seed)
    base = [f"t{r.randrange(10**6)}" for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(size)] = f"e{r.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_near_groups_of_many_copies(spark):
    texts = near_family(120, 60, 3, 1) + near_family(40, 30, 2, 2) + ["common start of all " + t for t in
                                                                      near_family(30, 8, 2, 3)]
    texts += texts[:20] + [None, "", "one two", "one  two", "ONE two", "one two three"]
    docs = list(enumerate(texts))
    random.Random(4).shuffle(docs)
    got = {r[0]: r[1:] for r in rows_of(ngram_join.near_groups(frame(spark, docs).repartition(5)))}
    assert got == brute.components(docs)


def test_near_groups_edge_cases(spark, edge, none):
    got = rows_of(ngram_join.near_groups(edge))
    known = [(d, t) for d, t in EDGE if d is not None]
    want = brute.components(known)
    assert len(got) == len(EDGE)
    for d, n, c in got:
        assert c is None if d is None else (n, c) == want[d]
    assert rows_of(ngram_join.near_groups(none)) == []
    # an id with several texts is one document
    several = frame(spark, [(1, "a b c d e f"), (2, "x y z u v w"), (2, "a b c d e f")])
    assert {(r[0], r[2]) for r in rows_of(ngram_join.near_groups(several))} == {(1, 1), (2, 1)}


def test_ranges_bound_what_two_sets_share():
    """Large sets get more ranges, so that unrelated ones are told apart; the
    bound never falls below what two sets share."""
    r = np.random.default_rng(3)
    for m, n, both in ((5000, 5200, 0), (5000, 5200, 4600), (900, 1100, 500), (4000, 4200, 3900), (1, 1, 1)):
        common = r.integers(0, 1 << 63, both, dtype=np.uint64) << np.uint64(1)
        x, y = (np.sort(np.concatenate((common, r.integers(0, 1 << 63, k - both, dtype=np.uint64) << np.uint64(1))))
                for k in (m, n))
        u, v = ngram_join._ranges(np.array([m, n]), np.concatenate((x, y)))
        most = ngram_join._most_shared(u, v)
        assert len(np.intersect1d(x, y)) <= most
        if not both:
            assert most < ngram_join._least_shared(m, n, 75)
    # a count that does not fit a byte rules nothing out
    assert ngram_join._ranges(np.array([300]), np.arange(300, dtype=np.uint64)) == [b""]


def test_long_unrelated_texts_are_not_compared(spark, monkeypatch):
    """Texts that share a common passage only: no pair of them gets to the
    comparison of the sets, but their near copies do and are linked."""
    r = random.Random(7)
    docs, compared = [], []
    for i in range(4):
        words = [f"u{i} {r.randrange(10**6)}" for _ in range(3000)]
        words[10:20] = ["a passage that stands in all of these texts here"]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-20]))]
    stored = ngram_join.stored

    def watched(df, name):
        out = stored(df, name)
        if name == "gram-likely":
            compared.extend(tuple(p) for p in out.collect())
        return out

    monkeypatch.setattr(ngram_join, "stored", watched)
    got = {r[0]: r[2] for r in rows_of(ngram_join.near_groups(frame(spark, docs)))}
    assert got == {i: i - i % 2 for i in range(8)}
    assert sorted(set(compared)) == [(0, 1), (2, 3), (4, 5), (6, 7)]


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)],
                                  "a long, b long")
    got = dict(rows_of(ngram_join.components(links)))
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100}


# -- 7 --------------------------------------------------------------------------

def test_intervals_and_as_of(spark):
    day = 86400
    events = [("x.org", 10 * day, "add"), ("x.org", 100 * day, "remove"), ("x.org", 100 * day, "add"),
              ("x.org", 400 * day, "add"), ("x.org", 400 * day, "add"), ("x.org/p", 50 * day, "add"),
              (None, 5, "add"), ("y.org", 3 * day, "remove")]
    ev = spark.createDataFrame(events, "entry string, at long, action string")
    assert sorted(rows_of(url_lists.intervals(ev)), key=str) == sorted(
        [("x.org", 10 * day, 100 * day), ("x.org", 400 * day, None), ("x.org/p", 50 * day, None)],
        key=str)
    caps = [(1, "http://a.X.org./p/q", 20 * day), (2, "https://u@x.org:80/p?x", 60 * day),
            (3, "http://x.org/", 100 * day), (4, "http://x.org", 500 * day), (5, None, 1),
            (6, "no url", 1), (7, "http://x.org", None), (7, "http://x.org", None),
            (8, "http://notx.org/p", 60 * day)]
    got = rows_of(url_lists.judged(spark.createDataFrame(
        caps, "page_id long, url string, fetched long").withColumn("row", F.lit(0)), ev))
    assert sorted((r[0], r[3], r[4], r[5]) for r in got if r[0] != 7 and r[3]) == [
        (1, True, 1, "x.org"), (2, True, 2, "x.org/p"), (4, True, 1, "x.org")]
    assert len(got) == len(caps)
    assert rows_of(url_lists.judged(spark.createDataFrame(
        [], "page_id long, url string, fetched long"), ev)) == []


# -- 8 --------------------------------------------------------------------------

def test_contamination_small_table(spark, docs):
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    got = {r[0]: r[1:] for r in rows_of(decontaminate.contamination(
        frame(spark, docs), table(spark, SF, "benchmark")))}
    assert got == brute.contamination(docs, items)


def test_contamination_edge_cases(spark, edge, none):
    items = [(1, "w1 w2"), (2, None), (3, ""), (4, "Same text, here"), (4, "no"), (None, "a"),
             (5, " ".join(WORDS[:14])), (11, LONG[300:500]), (12, "w1  W2 "), (6, "é 😀é")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("x"))
    got = Counter(rows_of(decontaminate.contamination(edge, bench)))
    want = Counter()
    for doc in EDGE:
        want[(doc[0], *brute.contamination([doc], items)[doc[0]])] += 1
    assert got == want
    assert rows_of(decontaminate.contamination(none, bench)) == []
    clean = rows_of(decontaminate.contamination(edge, bench.limit(0)))
    assert len(clean) == len(EDGE) and not any(r[5] for r in clean)


# -- 9 --------------------------------------------------------------------------

def test_shards_hold_equal_counts(spark, docs):
    df = frame(spark, docs + [(None, None)] * 50)
    got = rows_of(sharding.shard_documents(df, shards=7))
    by = defaultdict(list)
    for doc, size, crc, law, shard, slot, grown in got:
        by[shard].append(slot)
        assert law == "rows" and grown is None
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    text = dict(docs)
    assert all((size, crc) == (len((text[d] or "").encode()) + 16, brute.crc(text[d]))
               for d, size, crc, *_ in got if d is not None)


def test_shards_of_nothing(spark, none):
    assert rows_of(sharding.shard_documents(none)) == []


def test_few_rows_move_when_a_shard_is_added(spark):
    df = spark.range(4000).withColumnRenamed("id", "doc_id")
    a = dict(rows_of(sharding.ring_shards(df, "doc_id", 10, slack=0.25).select("doc_id", "shard")))
    b = dict(rows_of(sharding.ring_shards(df, "doc_id", 11, slack=0.25).select("doc_id", "shard")))
    assert max(Counter(a.values()).values()) <= 500 and max(Counter(b.values()).values()) <= 455
    assert sum(a[k] != b[k] for k in a) < 4000 * 0.35  # hashing modulo would move 91 %


def test_walk_keeps_to_capacities():
    r = random.Random(3)
    points = sharding.ring_points(5, 8)
    counts = [r.randrange(60) for _ in points]
    counts[3] += 900  # a hot arc
    room = sharding.capacities(sum(counts), 5, 0.0)
    ranges = sharding.walk(points, counts, room)
    assert len(ranges) <= 2 * len(points) + 5
    used = Counter()
    for arc in range(len(points)):
        mine = sorted(x[1:3] for x in ranges if x[0] == arc)
        assert [a for a, _ in mine] == [0, *[b for _, b in mine]][:len(mine)]
        assert (mine[-1][1] if mine else 0) == counts[arc]
    for _, a, b, shard, slot in sorted(ranges, key=lambda x: (x[3], x[4])):
        assert slot == used[shard]
        used[shard] += b - a
    assert [used[s] for s in range(5)] == room


# -- 10 -------------------------------------------------------------------------

TOKEN_TEXTS = ["Don't stop. it's 3.14, isn't it?", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>",
               "café café. naïve; ÉTÉ!", "x y z\x1cq \x85 w", "..a..b!? (c)[d] \"e\"",
               "'s 't 're'll", "ΑΣ ΑΣ. ß ẞ İ", "日本語、テスト。", "a\r\nb\tc\x0bd\x0ce", "'.s", "́.a", "1,000.00",
               "don'.t", "(́a)", "", "   ", "word" * 500]


def test_token_counts_are_the_library_s(spark, tmp_path):
    docs = list(enumerate(TOKEN_TEXTS)) + EDGE
    cache = f"file://{tmp_path}/cache"
    got = Counter(rows_of(token_counts.token_counts(frame(spark, docs), queries.vocabulary_path(),
                                                    cache)))
    tk, want = library(), Counter()
    for d, t in docs:
        n = len(tk.encode(t or "", add_special_tokens=False).ids)
        want[(d, len((t or "").encode()), n, n > 2048)] += 1
    assert got == want
    stored = spark.read.parquet(cache).count()
    # nothing new: nothing is added
    again = token_counts.token_counts(frame(spark, docs[:9]), queries.vocabulary_path(), cache)
    assert again.count() == 9 and spark.read.parquet(cache).count() == stored
    # what is new is added, once
    more = token_counts.token_counts(frame(spark, [(1, "quite new"), (2, "quite  new")]),
                                     queries.vocabulary_path(), cache)
    assert more.count() == 2 and spark.read.parquet(cache).count() == stored + 1


def test_token_counts_of_nothing(spark, none):
    assert rows_of(token_counts.token_counts(none, queries.vocabulary_path())) == []


def test_memo_starts_anew():
    raw = token_counts.vocabulary(queries.vocabulary_path())
    encode = token_counts.PieceEncoder(raw, keep_ids=True, most=2)
    tk = library()
    for text in TOKEN_TEXTS * 2:
        column = pa.array([text.encode()], pa.binary())
        ids = []
        for _, _, sizes, begins in encode(column):
            for b, n in zip(begins.tolist(), sizes.tolist()):
                ids += encode.ids[b:b + n].tolist()
        assert ids == tk.encode(text, add_special_tokens=False).ids


def test_plain_pieces_have_the_ids_of_the_library():
    raw, tk = token_counts.vocabulary(queries.vocabulary_path()), library()
    encode = token_counts.PieceEncoder(raw, keep_ids=True)
    letters = [chr(c) for c in (*range(0x21, 0x180), 0x301, 0x3A3)]
    pieces = [a + b + c for a in ("", "a", "Zu") for b in letters for c in ("", "s", "T9", "...", *letters[64:190:9])]
    pieces += ["thousand", "THOUSAND", "stößt", "ÉTÉ", "x" * 5000, "it's", "a<|endoftext|>b", "<|x|>", "e.g.,", "12ab34"]
    want = [e.ids for e in tk.encode_batch_fast(pieces, add_special_tokens=False)]
    plain = [encode._plain(p) for p in pieces]
    assert all(got in (None, ids) for got, ids in zip(plain, want))
    for p in pieces:
        # what may be spoilt by its neighbours, or has a letter of unknown case, goes the whole way
        whole = any(c in "'<|\xd7\xf7" or "\x7f" <= c <= "\xbf" or c > "\xff" for c in p)
        assert (encode._plain(p) is None) == whole, p


def test_only_pieces_that_are_not_plain_go_through_the_whole_tokenizer():
    encode = token_counts.PieceEncoder(token_counts.vocabulary(queries.vocabulary_path()), keep_ids=True)
    whole, seen = encode.tokenizer, []

    class Counted:
        def encode_batch_fast(self, pieces, **kw):
            seen.extend(pieces)
            return whole.encode_batch_fast(pieces, **kw)

    encode.tokenizer = Counted()
    text = "Plain words, über 20 of them; it's \u0130 <|endoftext|> end..."
    ids = [i for _, _, sizes, begins in encode(pa.array([text.encode()], pa.binary()))
           for b, n in zip(begins.tolist(), sizes.tolist()) for i in encode.ids[b:b + n].tolist()]
    assert ids == whole.encode(text, add_special_tokens=False).ids
    assert sorted(seen) == sorted(["it's", "\u0130", "<|endoftext|>"])


def test_another_vocabulary_is_encoded_by_its_own_settings():
    other = json.loads(token_counts.vocabulary(queries.vocabulary_path()))
    other["normalizer"] = None
    raw = json.dumps(other).encode()
    encode = token_counts.PieceEncoder(raw, keep_ids=True)
    assert not token_counts.plain_settings(raw) and encode.model is None
    from tokenizers import Tokenizer

    text = "plain words, über all"
    ids = [i for _, _, sizes, begins in encode(pa.array([text.encode()], pa.binary()))
           for b, n in zip(begins.tolist(), sizes.tolist()) for i in encode.ids[b:b + n].tolist()]
    assert ids == Tokenizer.from_str(raw.decode()).encode(text, add_special_tokens=False).ids


# -- pipeline -------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["toxicity"](spark, docs, SF)
    scores = toxicity.toxicity(docs, labels).collect()
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scores if not r["predicted"]}

    lined = stage["line_dedup"](spark, kept, SF)
    texts = [(r["doc_id"], r["text"]) for r in kept.collect()]
    want = brute.lines(texts)
    got = lined.collect()
    assert lined.columns == docs.columns and len(got) == len(texts)
    assert all(brute.sha(r["text"].encode()) == want[r["doc_id"]][2] for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)

    apart = stage["ngram_jaccard_join"](spark, lined, SF)
    groups = brute.components([(r["doc_id"], r["text"]) for r in got])
    assert apart.columns == docs.columns
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(
        d for d, (_, c) in groups.items() if c == d)

    clean = stage["decontamination"](spark, apart, SF)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    found = brute.contamination([(r["doc_id"], r["text"]) for r in apart.collect()], items)
    left = [(r["doc_id"], r["text"]) for r in clean.collect()]
    assert clean.columns == docs.columns
    assert sorted(d for d, _ in left) == sorted(d for d, x in found.items() if not x[4])

    check_packing(rows_of(stage["packing"](spark, clean, SF)), left)
    run = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in run.collect()} == {d for d, _ in left}


def test_pipeline_stages_take_edge_cases(spark, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(d, t, None, "s", None) for d, t in EDGE]
    docs = spark.createDataFrame(rows, columns).withColumn("row", F.lit("own")).withColumn(
        "_id", F.lit("own"))
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns
        out.collect()
        assert f(spark, docs.limit(0), SF).count() == 0
    once = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert sum(r["doc_id"] == 8 for r in once.collect()) == 1


def test_pipeline_contamination_is_by_row(spark):
    """Of rows that share an id, or have none, only those with a passage go."""
    passage = table(spark, SF, "benchmark").where("text is not null").orderBy("item_id").first()["text"]
    rows = [(None, passage), (None, "clean without id"), (None, None), (7, passage),
            (7, "clean under a repeated id"), (8, "clean")]
    docs = frame(spark, rows).withColumn("_row", F.lit("own"))
    out = corpus_pipeline.drop_contaminated(spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(
        r for r in rows if r[1] != passage)


def test_pipeline_near_copies_are_by_row(spark):
    """Rows that share an id are linked only if their texts are."""
    family = near_family(3, 200, 2, 8)
    rows = [(1, "first text under an id that comes twice"), (1, family[0]), (2, family[1]),
            (3, family[2]), (3, "another text without any copy here"), (4, "copied under one id"),
            (4, "copied under one id"), (None, family[0]), (5, ""), (5, None)]
    docs = frame(spark, rows).withColumn("_row", F.lit("own"))
    out = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter(
        rows[i] for i in (0, 1, 4, 5, 7, 8, 9))
