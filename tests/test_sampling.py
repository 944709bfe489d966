"""Undersampling and hash split against brute force."""

import random

import pandas as pd
from pyspark.sql import functions as F

from twinreach.functions.columns import hash60
from twinreach.operators import sampling as sm


def _brute(pdf, seed_hash):
    pdf = pdf.assign(h=seed_hash)
    counts = pdf.groupby("label").size()
    k = counts.min()
    pdf = pdf.sort_values(["label", "h", "user_id"])
    kept = []
    for _lab, g in pdf.groupby("label"):
        before = 0
        for (h, u), grp in g.groupby(["h", "user_id"], sort=True):
            if before < k:
                kept.extend(grp[["user_id", "label"]].itertuples(index=False))
            before += len(grp)
    return sorted(map(tuple, kept))


def test_undersample_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        label = 1 if rnd.random() < 0.2 else 0
        for _ in range(1 + (rnd.random() < 0.1) * 2):  # some keys repeat
            rows.append((f"u{i}", label))
    df = spark.createDataFrame(rows, "user_id string, label int")
    got = sorted(tuple(r) for r in sm.undersample(df, seed=9, bits=3).select("user_id", "label").collect())
    hashed = df.withColumn("h", hash60("user_id", salt="9")).toPandas()
    want = _brute(hashed[["user_id", "label"]], hashed["h"].values)
    assert got == want
    n1 = sum(1 for _u, lab in got if lab == 1)
    assert n1 == sum(1 for _u, lab in rows if lab == 1)


def test_hash_split_is_disjoint_and_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("user_id"))
    a1, b1 = sm.hash_split(df, "user_id", 0.7, 42)
    a2, _ = sm.hash_split(df.repartition(7), "user_id", 0.7, 42)
    ta, tb = {r.user_id for r in a1.collect()}, {r.user_id for r in b1.collect()}
    assert not (ta & tb) and len(ta) + len(tb) == 2000
    assert ta == {r.user_id for r in a2.collect()}
    assert 0.65 < len(ta) / 2000 < 0.75


def test_undersample_three_classes_hot_key_and_edges(spark):
    """Three classes, one key holding a third of all rows, several bucket
    widths; one class alone keeps everything; no rows gives no rows."""
    rnd = random.Random(11)
    rows = [("hot", 2)] * 150
    for i in range(300):
        lab = rnd.choice([0, 0, 1, 2])
        rows += [(f"k{i}", lab)] * (1 + (rnd.random() < 0.15))
    df = spark.createDataFrame(rows, "user_id string, label int")
    hashed = df.withColumn("h", hash60("user_id", salt="5")).toPandas()
    want = _brute(hashed[["user_id", "label"]], hashed["h"].values)
    for bits in (1, 4, 16):
        got = sorted(tuple(r) for r in
                     sm.undersample(df, seed=5, bits=bits).select("user_id", "label").collect())
        assert got == want, bits
    one = df.where(F.col("label") == 1)
    assert sm.undersample(one, seed=5).count() == one.count()
    assert sm.undersample(df.where(F.lit(False)), seed=5).count() == 0


def test_undersample_null_keys_are_one_key(spark):
    """A null key hashes as the empty text; null labels are left out."""
    rows = [(None, 0)] * 4 + [(f"a{i}", 0) for i in range(20)] + [(None, 1)] * 3 + [
        (f"b{i}", 1) for i in range(5)] + [("c", None)]
    df = spark.createDataFrame(rows, "user_id string, label int")
    got = [tuple(r) for r in sm.undersample(df, seed=2).select("user_id", "label").collect()]
    hashed = {r.user_id: r.h for r in df.select("user_id", hash60("user_id", salt="2").alias("h")).collect()}
    want = []
    for label in (0, 1):
        keys = sorted((hashed[k], k or "", k) for k in {u for u, lab in rows if lab == label})
        n = 0
        for _, _, k in keys:
            if n < 8:
                copies = rows.count((k, label))
                want += [(k, label)] * copies
                n += copies
    assert sorted(got, key=str) == sorted(want, key=str)
    train, test = sm.hash_split(spark.createDataFrame([(None,)] * 7, "user_id string"), "user_id")
    assert {train.count(), test.count()} == {0, 7}


def test_undersample_shuffles_no_key_before_the_boundary(spark):
    """The totals' exchange carries (class, bucket) only."""
    df = spark.range(100).select(F.col("id").cast("string").alias("user_id"),
                                 (F.col("id") % 2).cast("int").alias("label"))
    plan = sm.undersample(df)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines()
            if "Aggregate [" in line]
    assert any("_us_b#" in k and "user_id" not in k for k in keys)
    assert all("_us_cut" in k for k in keys if "user_id" in k)


def test_digest_of_a_draw_is_taken_once_a_row(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("k"))
    out = sm.sample_with_replacement(df, 1.7, 5, key="k")
    # a second md5 in the plan is a second digest of every row
    assert out._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1
    steps = sm.poisson_steps(1.7)
    want = {r["k"]: sum(r["u"] >= s for s in steps) for r in df.select("k", hash60("k", salt="5").alias("u")).collect()}
    got = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert out.columns == ["k"]
