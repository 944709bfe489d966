"""Fill-in-the-middle against a plain version and its own round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from twinreach.llm import fim, queries
from twinreach.llm.common import table
from twinreach.plans.compare import compare

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    """The contract, read literally."""
    text = text or ""
    units = UNIT.findall(text)
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[i:i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


rng = random.Random(3)
ALPHABET = "abcXYZ@[`{09 \n\t\0é߿ࠀ中￿😀<>PSM"
TEXTS = [None, "", "a", "é", "😀", "abcdefgh", "abcdefg ", "0123456", "ab<S>cd", "<<P", "<P", "S><M",
         "a" * 7 + "é", "a" * 8 + "é", "é" * 4, "中" * 8, "@AZ[`az{", "a" * 300_000, "é" * 200_000,
         *("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(600)),
         *("".join(rng.choice("ab <") for _ in range(rng.randrange(30))) for _ in range(200))]
DOCS = [*((i, t) for i, t in enumerate(TEXTS)), (None, "no id at all"), (None, None), (5, "abcdefgh"),
        (-3, "negative id"), (7, "other text of an id")]


def test_outputs_equal_a_plain_version(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("body", "n", "form", "output")])
    got = sorted((tuple(r) for r in fim.fill_in_middle(df).withColumn("back", fim.restored()).collect()),
                 key=repr)
    want = sorted(((i, *plain(i, t), t or "") for i, t in DOCS), key=repr)
    assert got == want
    assert {"plain", "psm", "spm"} == {r[2] for r in got}


def test_every_cut_of_a_text():
    text = "ab é0c😀 Z中zz".encode()
    units = UNIT.findall(text.decode())
    for pad in range(9):  # every place of a text inside of a word
        data = np.frombuffer(b"x" * pad + text, np.uint8)
        u = fim.Units(data, np.array([0, pad, len(data)]))
        assert u.counts.tolist() == [1 if pad else 0, len(units)]
        for k in range(len(units) + 1):
            size, points = u.after(np.array([0, k]))
            head = "".join(units[:k])
            assert (size[1], points[1]) == (len(head.encode()), len(head))


def test_parameters_and_empty_table(spark):
    df = spark.createDataFrame(DOCS[:60], "doc_id long, text string")
    assert {r["form"] for r in fim.fill_in_middle(df, fim_percent=0).collect()} == {"plain"}
    assert "psm" not in {r["form"] for r in fim.fill_in_middle(df, spm_percent=100).collect()}
    first, other = (fim.fill_in_middle(df, seed=s).select("doc_id", "output").collect() for s in (1, 2))
    assert first != other
    assert fim.fim_report(df.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_rebuilt_texts_are_the_texts(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    out = queries.op11_fill_in_middle(spark, f"/root/testdata/sf{sf}")
    same = out.join(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")), "doc_id")
    assert same.where("restored_sha256 <> s").count() == 0 and same.count() == docs.count()


def test_query_matches_its_sql_on_more_rows(spark):
    from twinreach.plans.compare import duckdb_connection

    sf = "/root/testdata/sf0.01"
    assert compare(queries.op11_fill_in_middle(spark, sf), duckdb_connection(sf),
                   queries.ORACLE["op11_fill_in_middle"]) == []
