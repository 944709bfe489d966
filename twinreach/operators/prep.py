"""Feature preparation with Spark ML stages.

Fitting a stage is a distributed aggregation (category counts, means,
moments); only its small result (category labels, one mean per column)
reaches the driver.  Categorical columns should be of bounded cardinality:
ids and personal data are excluded by ``split_columns`` by default.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinreach.session import cut_lineage


def index_cols(cat):
    return [f"{c}_index" for c in cat]


def vec_cols(cat):
    return [f"{c}_vec" for c in cat]


def imputed_cols(num):
    return [f"{c}_imputed" for c in num]


def string_indexer(cat, handle_invalid: str = "keep") -> StringIndexer:
    """Frequency-descending indices (ties alphabetical); null and unseen
    values go to one extra index when ``handle_invalid='keep'``."""
    return StringIndexer(inputCols=list(cat), outputCols=index_cols(cat),
                         handleInvalid=handle_invalid, stringOrderType="frequencyDesc")


def one_hot(cat, handle_invalid: str = "keep") -> OneHotEncoder:
    return OneHotEncoder(inputCols=index_cols(cat), outputCols=vec_cols(cat),
                         handleInvalid=handle_invalid)


def mean_imputer(num) -> Imputer:
    """Nulls and NaN of each numeric column -> that column's mean."""
    return Imputer(inputCols=list(num), outputCols=imputed_cols(num), strategy="mean")


def feature_stages(cat, num, impute: bool = True, scale: bool = False,
                   out: str = "features") -> list:
    """Index + one-hot the categoricals, impute (and optionally standardise)
    the numerics, assemble one vector.

    Imputation comes before assembly: a null kept as NaN inside a vector
    passes the assembler and then fails every classifier's fit.
    """
    stages = []
    parts = []
    if cat:
        stages += [string_indexer(cat), one_hot(cat)]
        parts += vec_cols(cat)
    if num:
        num_in = list(num)
        if impute:
            stages.append(mean_imputer(num))
            num_in = imputed_cols(num)
        stages.append(VectorAssembler(inputCols=num_in, outputCol="num_features",
                                      handleInvalid="keep"))
        if scale:
            stages.append(StandardScaler(inputCol="num_features", outputCol="num_scaled",
                                         withMean=True, withStd=True))
            parts.append("num_scaled")
        else:
            parts.append("num_features")
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


def cast_numeric(df: DataFrame, num) -> DataFrame:
    """Numeric inputs as double (Imputer and the assemblers want numbers)."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in set(num) else F.col(c)
                       for c in df.columns])


def string_index(df: DataFrame, cat) -> DataFrame:
    """Add ``<col>_index`` for each categorical column."""
    return string_indexer(cat).fit(df).transform(df)


def impute_mean(df: DataFrame, num) -> DataFrame:
    """Replace nulls of the numeric columns by their means (in place)."""
    d = cast_numeric(df, num)
    model = mean_imputer(num).fit(d)
    out = model.transform(d)
    return out.select(*[F.col(f"{c}_imputed").alias(c) if c in set(num) else F.col(c)
                        for c in df.columns])


def standardize(df: DataFrame, num, keep=("user_id",)) -> DataFrame:
    """(x - mean) / sample standard deviation of each numeric column."""
    d = impute_mean(df, num)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(num), outputCol="_std_in"),
        StandardScaler(inputCol="_std_in", outputCol="_std_out", withMean=True, withStd=True),
    ]).fit(d)
    arr = vector_to_array(F.col("_std_out"))
    return pipe.transform(d).select(*keep, *[arr.getItem(i).alias(c) for i, c in enumerate(num)])


def vector_as_array(df: DataFrame, *cols: str) -> DataFrame:
    """Replace vector columns by ``array<double>`` (portable, comparable)."""
    for c in cols:
        df = df.withColumn(c, vector_to_array(F.col(c)))
    return df


# -- dictionaries of any size -------------------------------------------------

def category_dictionary(df: DataFrame, col: str, min_count: int = 1,
                        buckets: int | None = None) -> DataFrame:
    """``_cd_value, _cd_count, _cd_index`` for the values of ``col`` found in at
    least ``min_count`` rows, as a written table: the indices of
    ``string_indexer`` (most frequent first, ties by value, in the column's own
    type) without a label list in the driver.

    Values are counted with partial aggregation, so a hot value is one row
    before the shuffle.  The distinct values are range-partitioned by (count,
    value) and written with their place in the range; only the sizes of the
    ranges (one row each) are broadcast.  Nulls have no entry; a table without
    values gives an empty dictionary.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_cd_value")).agg(
        F.count(F.lit(1)).alias("_cd_count")).where(F.col("_cd_count") >= min_count)
    order = [F.col("_cd_count").desc(), F.col("_cd_value").asc()]
    spread = counts.repartitionByRange(buckets, *order) if buckets else counts.repartitionByRange(*order)
    # upper bits: the range's number, lower 33 bits: the place in it
    placed = cut_lineage(spread.sortWithinPartitions(*order)
                         .withColumn("_cd_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_cd_range", F.shiftright("_cd_at", 33))
    sizes = placed.groupBy("_cd_range").agg(F.count(F.lit(1)).alias("_cd_in"))
    earlier = Window.orderBy("_cd_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_cd_range", F.coalesce(F.sum("_cd_in").over(earlier), F.lit(0)).alias("_cd_before"))
    place = F.col("_cd_at").bitwiseAND(F.lit((1 << 33) - 1))
    return cut_lineage(placed.join(F.broadcast(before), "_cd_range").select(
        "_cd_value", "_cd_count", (F.col("_cd_before") + place).alias("_cd_index")))


def index_by_dictionary(df: DataFrame, col: str, dictionary: DataFrame, out: str,
                        head: int = 1000) -> DataFrame:
    """``df`` with ``out``: the index of ``col`` in ``dictionary`` as bigint.
    Null, values below the dictionary's ``min_count`` and unseen values share
    the index after the last one.

    Rows of the ``head`` most frequent values take their index from a broadcast
    of at most ``head`` entries and are not shuffled, so no hot value meets in
    one task; the others join the table by value.  ``df`` is read once per
    branch and should be a table or a repeatable plan.
    """
    last = F.lit(dictionary.count()).cast("long")  # one number, from the table's row counts
    cols = [F.col(c) for c in df.columns if c != out]
    known = df.where(F.col(col).isNotNull())
    entry = F.col(col) == F.col("_cd_value")
    top = F.broadcast(dictionary.where(F.col("_cd_index") < head))
    frequent = known.join(top, entry).select(*cols, F.col("_cd_index").alias(out))
    others = known.join(top, entry, "left_anti").join(
        dictionary.where(F.col("_cd_index") >= head), entry, "left")
    others = others.select(*cols, F.coalesce("_cd_index", last).alias(out))
    nulls = df.where(F.col(col).isNull()).select(*cols, last.alias(out))
    return frequent.unionByName(others).unionByName(nulls)
