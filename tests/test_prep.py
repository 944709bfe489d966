"""Rows-only queries checked against values computed another way: one-hot
vectors against the string indices (which have an exact oracle), assembled
vectors against mean imputation done in DuckDB, and Spark's own samplers
against their input."""

import math

import __spark_entry__ as entry
from pyspark.sql import functions as F

from conftest import SF_SMALL
from twinreach.plans import catalog as cat
from twinreach.sources.fixtures import AUDIENCE_SQL


def _by_user(df):
    return {r["user_id"]: r for r in df.collect()}


def test_one_hot_positions_follow_the_string_index(spark, duck_small):
    hot = _by_user(entry.queries()["one_hot"](spark, SF_SMALL))
    idx = _by_user(entry.queries()["string_index"](spark, SF_SMALL))
    assert hot.keys() == idx.keys()
    for c in cat.CAT:
        n = duck_small.execute(
            f"SELECT count(DISTINCT {c}) FROM ({AUDIENCE_SQL}) a").fetchall()[0][0]
        for user, row in hot.items():
            vec, i = row[f"{c}_vec"], int(idx[user][f"{c}_index"])
            # the indexer's keep bucket (null / unseen, index n) is one of its
            # labels, so it gets a position of its own; the encoder's own
            # invalid bucket is the one dropLast removes
            assert len(vec) == n + 1
            assert vec[i] == 1.0 and sum(vec) == 1.0


def test_assembled_vector_is_the_imputed_columns(spark, duck_small):
    cols = cat.NUM + ["num_children"]
    got = _by_user(entry.queries()["assemble"](spark, SF_SMALL))
    sel = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM a)) AS {c}"
                    for c in cols)
    want = duck_small.execute(f"WITH a AS ({AUDIENCE_SQL}) SELECT user_id, {sel} FROM a").fetchall()
    assert len(want) == len(got)
    for user, *vals in want:
        vec = got[user]["num_features"]
        assert len(vec) == len(cols)
        for v, w in zip(vec, vals):
            assert math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9)


def test_feature_vector_ends_with_imputed_numerics(spark):
    vecs = entry.queries()["features_vector"](spark, SF_SMALL)
    data = cat._training(spark, SF_SMALL)
    _c, num = cat.fr.split_columns(data.schema)
    means = data.select(*[F.avg(F.col(c).cast("double")).alias(c) for c in num]).first()
    want = {r["user_id"]: [r[c] if r[c] is not None else means[c] for c in num]
            for r in data.select("user_id", *[F.col(c).cast("double").alias(c) for c in num]).collect()}
    rows = vecs.collect()
    assert len(rows) == len(want)
    assert len({len(r["features"]) for r in rows}) == 1
    for r in rows:
        tail = r["features"][-len(num):]
        for v, w in zip(tail, want[r["user_id"]]):
            assert math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9)


def test_random_split_partitions_the_input(spark):
    split = entry.queries()["random_split"](spark, SF_SMALL)
    lab = cat.fx.labelled(spark, SF_SMALL)
    rows = split.select("user_id", "label", "side").collect()
    sides = {}
    for r in rows:
        assert r.user_id not in sides  # every row on exactly one side
        sides[r.user_id] = r.side
    assert sorted((r.user_id, r.label) for r in rows) == sorted(tuple(r) for r in lab.collect())
    again = {r.user_id: r.side for r in split.select("user_id", "side").collect()}
    assert again == sides  # repeatable on the same input


def test_sample_with_replacement_draws_from_the_input(spark):
    s = entry.queries()["sample_wr"](spark, SF_SMALL)
    lab = cat.fx.labelled(spark, SF_SMALL)
    assert s.join(lab, ["user_id", "label"], "left_anti").count() == 0
    n, m = lab.count(), s.count()
    assert 0.15 * n < m < 0.45 * n  # Poisson(0.3) per row
