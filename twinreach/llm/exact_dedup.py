"""Exact de-duplication by deterministic block naming.

Every normalised text is cut into fixed-size blocks.  Sorting the blocks
gives each distinct block an integer name; then adjacent pairs of names are
sorted and named in turn, until one name stands for the whole document.
Two documents have the same name exactly when their texts are equal: a name
is handed out per distinct value, never by a hash alone.

Only DataFrame functions are used.  What is shuffled:

* once, the blocks, as (fingerprint, block) with map-side combining, to show
  that no fingerprint stands for two different blocks.  Copies collapse
  before the shuffle, so a block held by a third of all documents costs one
  row per map task;
* then only longs.  A block is sorted by its fingerprint; the few
  fingerprints that do stand for several blocks (none, as a rule) are sorted
  by the block's text and their blocks are looked up by text.

A document that holds a block (or a pair) no other row holds is unlike every
other document: that name already is its identity, and it leaves the
recursion.  So later levels work on rows that may still have an equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinreach.llm.common import WHITESPACE, has_rows, numbered, stored

BLOCK = 2048


def fingerprint(block: Column) -> Column:
    return F.xxhash64(block)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE + "+", "")


def cut_blocks(body: Column, block: int) -> Column:
    """Array of the text's blocks of ``block`` code points; '' has one."""
    return F.when(body == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(body, F.lit(f"(?s).{{1,{int(block)}}}"), F.lit(0)))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, fingerprint=fingerprint) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``.

    Texts are equal when identical after deleting every ASCII white-space
    character; null counts as empty.  Of equal texts the row with the most
    code points in the original text stays, then the smallest id (a null id
    comes last); of rows that tie in both, one stays.  Other columns of
    ``docs`` are not read; an empty table gives an empty result.
    ``fingerprint`` only has to be a function of the block: a poor one costs
    time, not correctness.
    """
    base = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long").alias("points"),
        normalised(F.col(text_col)).alias("body"))
    # numbered before it is cut: the number is the row's, not the block's
    base = base.withColumn("sha", F.sha2("body", 256)).withColumn(
        "row", F.monotonically_increasing_id())
    blocks = (base.select("id", "sha", "points", "row",
                          F.posexplode(cut_blocks(F.col("body"), block)).alias("pos", "block"))
              .withColumn("fp", fingerprint(F.col("block"))))
    # written at once, so the row numbers handed out here hold from now on
    at = stored(blocks.drop("block"), "block-places")

    # every distinct block once; a fingerprint with more than one is shared
    distinct = stored(blocks.groupBy("fp", "block").agg(F.count(F.lit(1)).alias("n"))
                      .select("fp", "n"), "block-values")
    values = distinct.groupBy("fp").agg(F.count(F.lit(1)).alias("values"),
                                        F.sum("n").alias("n"))
    plain = numbered(values.where("values = 1").select("fp", "n").orderBy("fp"),
                     "name", "block-names")
    named = at.join(plain, "fp").select("row", "pos", "name", "n")
    shared = stored(values.where("values > 1").select("fp"), "block-shared")
    if has_rows(shared):
        named = named.unionByName(_named_by_text(blocks, at, shared))
    current = stored(named, "block-level-0")

    settled, level = [], 0
    while True:
        by_row = current.groupBy("row").agg(
            F.max("pos").alias("last"), F.min("n").alias("least"),
            F.min(F.struct("n", "name")).alias("rarest"))
        # a name held once names its row; so does a name that is alone
        settled.append(by_row.where("least = 1 or last = 0").select(
            "row", F.lit(level).alias("level"), F.col("rarest.name").alias("name")))
        open_rows = by_row.where("least > 1 and last > 0").select("row")
        pairs = (current.join(open_rows, "row", "left_semi")
                 .groupBy("row", F.shiftright("pos", 1).alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b")))
        # a last name without a neighbour pairs with a name that no block has
        pairs = stored(pairs.withColumn("b", F.coalesce("b", F.lit(-(1 << 62)))),
                       f"block-pairs-{level}")
        if not has_rows(pairs):
            break
        level += 1
        names = numbered(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
                         .orderBy("a", "b"), "name", f"block-names-{level}")
        current = stored(pairs.join(names, ["a", "b"]).select("row", "pos", "name", "n"),
                         f"block-level-{level}")
    identity = settled[0]
    for more in settled[1:]:
        identity = identity.unionByName(more)

    rows = at.where("pos = 0").select("row", "id", "points", "sha")
    rows = stored(rows.join(identity, "row"), "block-identity")
    best = rows.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("z"),
                       F.col("id").alias("id"), F.col("row").alias("row"))).alias("best"))
    # as a table, so that a group held by many rows can be split in the join
    best = stored(best, "block-groups")
    return rows.join(best, ["level", "name"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def _named_by_text(blocks: DataFrame, at: DataFrame, shared: DataFrame) -> DataFrame:
    """Names of the blocks whose fingerprint stands for several texts: these
    are sorted by the text itself.  The names are negative, so apart from
    those of the other blocks."""
    hit = blocks.join(shared, "fp").select("id", "sha", "pos", "block")
    names = numbered(hit.groupBy("block").agg(F.count(F.lit(1)).alias("n")).orderBy("block"),
                     "order", "block-shared-names")
    found = (hit.join(names, "block")
             .select(F.col("id").alias("_id"), F.col("sha").alias("_sha"),
                     F.col("pos").alias("_pos"), (-1 - F.col("order")).alias("name"), "n")
             .distinct())
    places = at.join(shared, "fp")
    return places.join(found, places["id"].eqNullSafe(found["_id"])
                       & (places["sha"] == found["_sha"])
                       & (places["pos"] == found["_pos"])).select("row", "pos", "name", "n")
