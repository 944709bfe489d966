"""Registry of checked queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or tables Spark derives from them), whole; the matching DuckDB text
is in ``twinreach.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinreach.functions.columns import (
    PRICES_AS_PUBLISHED,
    PRICES_CORRECTED,
    churn_flag,
    days_since,
    epoch_seconds,
    subscription_revenue,
)
from twinreach.operators import conform as cf
from twinreach.operators import features as feat
from twinreach.operators import kpi as kp
from twinreach.operators import quality as ql
from twinreach.operators import ranking as rk
from twinreach.operators import seed as sd
from twinreach.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# -- silver, features, KPI ---------------------------------------------------

def silver_frame(spark, sf_dir):
    """Audience as raw strings (bronze stand-in) typed to the silver schema."""
    return cf.conform(cf.as_strings(fx.audience(spark, sf_dir)), cf.AUDIENCE_SILVER_SCHEMA,
                      missing="drop")


def features_frame(spark, sf_dir, **kw):
    return feat.lal_features(silver_frame(spark, sf_dir), as_of=fx.AS_OF, **kw)


@query("silver")
def q_silver(spark, sf_dir):
    return silver_frame(spark, sf_dir)


@query("recency")
def q_recency(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return a.select("user_id", days_since("last_login_date", fx.AS_OF).cast("int")
                    .alias("days_since_last_session"))


@query("churn")
def q_churn(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    days = days_since("last_login_date", fx.AS_OF)
    return a.select("user_id", churn_flag(days).alias("is_churn"))


@query("revenue")
def q_revenue(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return a.select("user_id", "subscription_type",
                    subscription_revenue("subscription_type", PRICES_AS_PUBLISHED)
                    .alias("monthly_subscription_revenue"))


@query("revenue_corrected")
def q_revenue_corrected(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return a.select("user_id", "subscription_type",
                    subscription_revenue("subscription_type", PRICES_CORRECTED)
                    .alias("monthly_subscription_revenue"))


def _pct(col, out):
    def run(spark, sf_dir):
        a = fx.audience(spark, sf_dir).select("user_id", col)
        return rk.global_percent_rank(a, col, out)
    return run


QUERIES["pct_ad"] = _pct("ad_interaction_rate", "ad_interaction_percentile")
QUERIES["pct_watch"] = _pct("avg_daily_watch_time", "avg_daily_watch_percentile")
QUERIES["pct_sub"] = _pct("subscription_length", "subscription_length_percentile")


@query("pct_distributed")
def q_pct_distributed(spark, sf_dir):
    """All three ranks with few buckets on a table of many rows per bucket."""
    a = fx.audience(spark, sf_dir)
    return rk.global_percent_ranks(a.select("user_id", *feat.PERCENTILES), feat.PERCENTILES,
                                   buckets=3)


@query("features")
def q_features(spark, sf_dir):
    return features_frame(spark, sf_dir)


@query("churn_count")
def q_churn_count(spark, sf_dir):
    return kp.churn_count(features_frame(spark, sf_dir, percentiles={}))


@query("kpi")
def q_kpi(spark, sf_dir):
    return kp.kpi(features_frame(spark, sf_dir, percentiles={}), fx.impressions(spark, sf_dir))


@query("kpi_subcent")
def q_kpi_subcent(spark, sf_dir):
    """Ad prices of a fraction of a cent, one per line item."""
    prices = tb.table(spark, sf_dir, "lineitem").select(
        (F.col("l_discount").cast("double") / 25).alias("WinningPrice"))
    return kp.kpi(features_frame(spark, sf_dir, percentiles={}), prices)


@query("epoch_login")
def q_epoch_login(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return a.select("user_id", epoch_seconds("last_login_date").alias("last_login_date"))


# -- quality -----------------------------------------------------------------

@query("expect_report")
def q_expect_report(spark, sf_dir):
    rules = ql.load_rules(ql.rules_frame(spark, ql.RULES_AS_PUBLISHED), "audience_team")
    return ql.expectation_report(silver_frame(spark, sf_dir), rules)


@query("expect_report_corrected")
def q_expect_report_corrected(spark, sf_dir):
    rules = ql.load_rules(ql.rules_frame(spark, ql.RULES_CORRECTED), "audience_team")
    return ql.expectation_report(silver_frame(spark, sf_dir), rules)


@query("expect_flags")
def q_expect_flags(spark, sf_dir):
    rules = ql.load_rules(ql.rules_frame(spark, ql.RULES_AS_PUBLISHED), "audience_team")
    return ql.expectation_flags(silver_frame(spark, sf_dir), rules, keep=["user_id"])


@query("expect_drop")
def q_expect_drop(spark, sf_dir):
    rules = ql.load_rules(ql.rules_frame(spark, ql.RULES_AS_PUBLISHED), "audience_team")
    kept, _ = ql.apply_expectations(silver_frame(spark, sf_dir), rules, action="drop")
    return kept.select("user_id", "email", "gender")


@query("key_report")
def q_key_report(spark, sf_dir):
    return cf.key_report(silver_frame(spark, sf_dir), "user_id")


@query("key_report_repeated")
def q_key_report_repeated(spark, sf_dir):
    s = fx.seed(spark, sf_dir)
    return cf.key_report(s.unionByName(s), "user_id_seed")


# -- seed and labels ---------------------------------------------------------

@query("seed_select")
def q_seed_select(spark, sf_dir):
    return fx.seed(spark, sf_dir)


@query("label_audience")
def q_label_audience(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return sd.label_audience(a, fx.seed(spark, sf_dir)).select("user_id", "favorite_genre", "label")


@query("label_fanout")
def q_label_fanout(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    s = fx.seed(spark, sf_dir)
    return sd.label_audience(a, s.unionByName(s), dedupe=False).select("user_id", "label")


@query("label_repeated_dedup")
def q_label_repeated_dedup(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    s = fx.seed(spark, sf_dir)
    return sd.label_audience(a, s.unionByName(s), dedupe=True).select("user_id", "label")


# -- sampling and splits -----------------------------------------------------

from twinreach.operators import frames as fr  # noqa: E402
from twinreach.operators import metrics as mt  # noqa: E402
from twinreach.operators import prep as pp  # noqa: E402
from twinreach.operators import sampling as sm  # noqa: E402

RULE_GENRES = ("Comedy", "Documentary", "Reality TV")


def rule_prediction():
    """The seed rule without the tier filter, used as a fixed predictor."""
    return (F.when(F.col("favorite_genre").isin(*RULE_GENRES)
                   & (F.col("avg_daily_watch_time") > 60)
                   & (F.col("last_login_date") >= F.to_date(F.lit("2001-02-02"))), F.lit(1))
            .otherwise(F.lit(0)).cast("int"))


def labelled_audience(spark, sf_dir):
    return sd.label_audience(fx.audience(spark, sf_dir), fx.seed(spark, sf_dir))


@query("sample_wr")
def q_sample_wr(spark, sf_dir):
    return sm.sample_with_replacement(fx.labelled(spark, sf_dir), 0.30, 1, key="user_id")


@query("sample_wr_lines")
def q_sample_wr_lines(spark, sf_dir):
    """More than one draw a row on average, by a key of two columns."""
    li = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sm.sample_with_replacement(li, 1.7, 5, key=F.concat_ws("-", "l_orderkey", "l_linenumber"))


@query("random_split_rows")
def q_random_split_rows(spark, sf_dir):
    """Both sides of a random split together: every row, once."""
    train, test = sm.random_split(fx.labelled(spark, sf_dir), (0.7, 0.3), 42)
    return train.unionByName(test)


@query("random_split")
def q_random_split(spark, sf_dir):
    train, test = sm.random_split(fx.labelled(spark, sf_dir), (0.7, 0.3), 42)
    return (train.withColumn("side", F.lit("train"))
            .unionByName(test.withColumn("side", F.lit("test"))))


@query("hash_split")
def q_hash_split(spark, sf_dir):
    return fx.labelled(spark, sf_dir).withColumn("side", sm.split_side("user_id", 0.7, 42))


@query("undersample")
def q_undersample(spark, sf_dir):
    return sm.undersample(fx.labelled(spark, sf_dir), "label", "user_id", seed=42)


@query("undersample_copies")
def q_undersample_copies(spark, sf_dir):
    """Copies of a key (seed appended twice -> fan-out) are kept together."""
    a = fx.audience(spark, sf_dir)
    s = fx.seed(spark, sf_dir)
    fan = sd.label_audience(a, s.unionByName(s), dedupe=False).select("user_id", "label")
    return sm.undersample(fan, "label", "user_id", seed=7, bits=4)


# -- projections and set operations -----------------------------------------

@query("dedupe_rows")
def q_dedupe_rows(spark, sf_dir):
    lab = fx.labelled(spark, sf_dir)
    return fr.dedupe_rows(lab.unionByName(lab.where(F.col("label") == 1)))


def _aligned(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    training = labelled_audience(spark, sf_dir).select(
        "user_id", "email", "avg_daily_watch_time", "num_children", "label")
    pseudo = a.select("user_id", "avg_daily_watch_time", "num_children",
                      rule_prediction().alias("label"), F.lit(0.5).alias("score"))
    return fr.align_union(fr.align_to(pseudo, training.columns), training)


@query("align_union")
def q_align_union(spark, sf_dir):
    return _aligned(spark, sf_dir)


@query("fill_numeric")
def q_fill_numeric(spark, sf_dir):
    return fr.fill_numeric(_aligned(spark, sf_dir), 0)


MAP_AGE_GENRE = {"18-24": "Action", "25-34": "Comedy", "55+": "Drama"}


@query("map_override")
def q_map_override(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    a = fr.override_where(a, F.col("age_group").isin("45-54", "55+")
                          & (F.col("favorite_genre") != "Documentary"),
                          "favorite_genre", "Documentary")
    a = fr.map_column(a, "age_group", "favorite_genre", MAP_AGE_GENRE, share=0.7, seed=12345)
    return a.select("user_id", "age_group", "favorite_genre")


CAT = ["subscription_type", "favorite_genre", "age_group", "gender"]
NUM = ["avg_daily_watch_time", "subscription_length"]


@query("drop_helpers")
def q_drop_helpers(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    encoded = pp.one_hot(CAT).fit(pp.string_index(a, CAT))
    return fr.drop_helper_columns(encoded.transform(pp.string_index(a, CAT)))


@query("limit_ordered")
def q_limit_ordered(spark, sf_dir):
    a = fx.audience(spark, sf_dir).select("user_id", "avg_daily_watch_time")
    return fr.limit_ordered(a, 10, F.col("avg_daily_watch_time").desc(), F.col("user_id"))


@query("limit_large")
def q_limit_large(spark, sf_dir):
    """A third of all line items, the dearest, ties by key."""
    li = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return fr.limit_large(li, li.count() // 3, ("l_extendedprice", False), ("l_orderkey", True),
                          ("l_linenumber", True))


@query("limit_large_ties")
def q_limit_large_ties(spark, sf_dir):
    """Half of the line items by a column of few values, some of them null."""
    li = tb.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_linenumber") % 3 != 1, F.col("l_quantity")).alias("quantity"))
    return fr.limit_large(li, li.count() // 2, ("quantity", True), ("l_linenumber", False),
                          ("l_orderkey", True))


@query("latest_row")
def q_latest_row(spark, sf_dir):
    return fr.latest_row(fx.impressions(spark, sf_dir), "Timestamp", "ImpressionID")


# -- metrics -----------------------------------------------------------------

def _rule_scored(spark, sf_dir):
    return labelled_audience(spark, sf_dir).select("user_id", "label",
                                                   rule_prediction().alias("prediction"))


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return mt.class_counts(fx.labelled(spark, sf_dir))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(_rule_scored(spark, sf_dir))


@query("class_metrics")
def q_class_metrics(spark, sf_dir):
    return mt.classification_metrics(_rule_scored(spark, sf_dir))


# -- feature preparation -----------------------------------------------------

@query("string_index")
def q_string_index(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    return pp.string_index(a, CAT).select("user_id", *pp.index_cols(CAT))


@query("impute_mean")
def q_impute_mean(spark, sf_dir):
    out = pp.impute_mean(fx.audience(spark, sf_dir).select("user_id", *NUM), NUM)
    return out.select("user_id", *[F.round(c, 9).alias(c) for c in NUM])


STD_COLS = ["avg_daily_watch_time", "subscription_length", "ad_interaction_rate"]


@query("standardize")
def q_standardize(spark, sf_dir):
    out = pp.standardize(fx.audience(spark, sf_dir).select("user_id", *STD_COLS), STD_COLS)
    return out.select("user_id", *[F.round(c, 9).alias(c) for c in STD_COLS])


@query("one_hot")
def q_one_hot(spark, sf_dir):
    a = pp.string_index(fx.audience(spark, sf_dir), CAT)
    out = pp.one_hot(CAT).fit(a).transform(a)
    return pp.vector_as_array(out.select("user_id", *pp.vec_cols(CAT)), *pp.vec_cols(CAT))


@query("assemble")
def q_assemble(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler

    a = pp.impute_mean(fx.audience(spark, sf_dir), NUM + ["num_children"])
    out = VectorAssembler(inputCols=NUM + ["num_children"], outputCol="num_features").transform(a)
    return pp.vector_as_array(out.select("user_id", "num_features"), "num_features")


# -- models ------------------------------------------------------------------

from twinreach.operators import models as md  # noqa: E402
from twinreach.plans import training as tr  # noqa: E402


def _training(spark, sf_dir):
    return tr.training_frame(features_frame(spark, sf_dir), fx.seed(spark, sf_dir))


@query("features_vector")
def q_features_vector(spark, sf_dir):
    from pyspark.ml import Pipeline

    data = _training(spark, sf_dir)
    cat, num = fr.split_columns(data.schema)
    d = pp.cast_numeric(data, num)
    out = Pipeline(stages=pp.feature_stages(cat, num)).fit(d).transform(d)
    return pp.vector_as_array(out.select("user_id", "label", "features"), "features")


@query("gbt_score")
def q_gbt_score(spark, sf_dir):
    """Every user scored, with the side it was on."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    rows = res.data.withColumn("side", sm.split_side("user_id", 0.7, 42))
    return md.score(res.model, rows, res.numeric, keep=["user_id", "label", "side"])


@query("score_rounded")
def q_score_rounded(spark, sf_dir):
    """Every user scored, with the side it was on."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    rows = res.data.withColumn("side", sm.split_side("user_id", 0.7, 42))
    return md.score(res.model, rows, res.numeric,
                    keep=["user_id", "label", "side", "age_group", "favorite_genre",
                          "avg_daily_watch_time"], digits=2)


@query("scores_valid")
def q_scores_valid(spark, sf_dir):
    """Per user, whether its prediction is 0 or 1 and its probability in 0..1."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    out = md.scored_table(res.model, res.data, res.numeric)
    return out.select("user_id", (F.col("prediction").isin(0, 1)
                                  & F.col("probability").between(0, 1)).alias("valid"))


@query("model_comparison")
def q_model_comparison(spark, sf_dir):
    metrics, _models, _c, _n, _t = tr.compare(_training(spark, sf_dir))
    return metrics


@query("best_model")
def q_best_model(spark, sf_dir):
    metrics, _models, _c, _n, _t = tr.compare(_training(spark, sf_dir))
    return md.best_of(metrics)


@query("pseudo_label")
def q_pseudo_label(spark, sf_dir):
    res = tr.fit_gbt(_training(spark, sf_dir))
    return md.pseudo_label(res.model, res.audience(), res.numeric).select("user_id", "label")


@query("augment_training")
def q_augment_training(spark, sf_dir):
    """The train side with its labels, the test side with predicted ones."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    return md.semi_supervised_frame(res.model, res.train, res.test.drop("label"), res.numeric)


@query("augment_sides")
def q_augment_sides(spark, sf_dir):
    """Which rows of the stacked frame are pseudo-labelled."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    out = md.semi_supervised_frame(res.model, res.train, res.test.drop("label"), res.numeric,
                                   mark="is_pseudo")
    return out.select("user_id", sm.split_side("user_id", 0.7, 42).alias("side"), "is_pseudo")


@query("semi_supervised")
def q_semi_supervised(spark, sf_dir):
    res = tr.fit_gbt(_training(spark, sf_dir))
    _m2, metrics, _rows = md.semi_supervised_fit(res.model, res.train, res.test,
                                                 res.categorical, res.numeric)
    return metrics


@query("best_published")
def q_best_published(spark, sf_dir):
    """Compare, take the best model, publish its positives: published ids
    that the model does not predict, predicted ids that are not published,
    and published ids outside of the audience."""
    training = _training(spark, sf_dir)
    metrics, models, _cat, num, _test = tr.compare(training)
    _name, best = md.best_model(metrics, models)
    published = act.activate(best, training.drop("label"), num,
                             scratch_path(spark, "best"), prepared=True).select("user_id")
    scored = md.score(best, training.drop("label"), num, keep=["user_id"])
    both = (published.withColumn("p", F.lit(1)).join(scored, "user_id", "full"))
    return both.agg(
        F.count_if((F.col("p") == 1) & (F.coalesce("prediction", F.lit(0)) != 1)).alias("not_predicted"),
        F.count_if((F.col("prediction") == 1) & F.col("p").isNull()).alias("not_published"),
        F.count_if(F.col("prediction").isNull()).alias("outside"))


@query("positives")
def q_positives(spark, sf_dir):
    res = tr.fit_gbt(_training(spark, sf_dir))
    return md.score_audience(res.model, res.audience(), res.numeric)


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Scores of a fitted pipeline before and after save / load."""
    from twinreach.session import scratch_path

    res = tr.fit_gbt(_training(spark, sf_dir))
    path = scratch_path(spark, "model")
    md.save_model(res.model, path)
    again = md.load_model(path)
    a = md.score(res.model, res.data, res.numeric, keep=["user_id"])
    b = md.score(again, res.data, res.numeric, keep=["user_id"]).select(
        "user_id", F.col("prediction").alias("prediction_reloaded"),
        F.col("probability").alias("probability_reloaded"))
    return a.join(b, "user_id")


@query("reload_equal")
def q_reload_equal(spark, sf_dir):
    """Per user, whether the reloaded model gives the same scores."""
    return q_model_roundtrip(spark, sf_dir).select("user_id", (
        (F.col("prediction") == F.col("prediction_reloaded"))
        & (F.col("probability") == F.col("probability_reloaded"))).alias("same"))


# -- streams and sinks -------------------------------------------------------

from twinreach.session import scratch_path  # noqa: E402
from twinreach.sources import tables as tb  # noqa: E402
from twinreach.streaming import ingest as ing  # noqa: E402

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _stream_once(spark, df, schema, batches=1, rescue=True):
    """Land ``df`` as JSON files ``batches`` times, ingesting after each."""
    land, target, ckpt = (scratch_path(spark, n) for n in ("landing", "bronze", "stream-ckpt"))
    for _ in range(batches):
        tb.write_json(df, land)
        ing.ingest_json_stream(spark, land, target, ckpt, schema, rescue=rescue)
        ing.ingest_json_stream(spark, land, target, ckpt, schema, rescue=rescue)  # adds nothing
    return spark.read.parquet(target)


def _bronze_audience(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    land = scratch_path(spark, "landing")
    tb.write_json(a, land)
    schema = ing.infer_json_schema(spark, land, strings=True)
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    return spark.read.parquet(target)


@query("ingest_strings")
def q_ingest_strings(spark, sf_dir):
    return _bronze_audience(spark, sf_dir)


@query("ingest_conformed")
def q_ingest_conformed(spark, sf_dir):
    return cf.conform(_bronze_audience(spark, sf_dir), cf.AUDIENCE_SILVER_SCHEMA, missing="drop")


def _impressions_json(spark, sf_dir):
    return fx.impressions(spark, sf_dir).withColumn("Timestamp", F.date_format("Timestamp", ISO_Z))


@query("ingest_typed")
def q_ingest_typed(spark, sf_dir):
    imp = _impressions_json(spark, sf_dir)
    land = scratch_path(spark, "landing")
    tb.write_json(imp, land)
    schema = ing.infer_json_schema(spark, land)
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    return spark.read.parquet(target).drop(cf.RESCUED)


@query("ingest_appended")
def q_ingest_appended(spark, sf_dir):
    """Seed files appended twice; each file is ingested exactly once."""
    s = fx.seed(spark, sf_dir)
    return _stream_once(spark, s, cf.SEED_SCHEMA, batches=2).drop(cf.RESCUED)


def _rescue_lines(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    cols = [c for c in a.columns if c != "avg_daily_watch_time"]
    extra = F.when(F.col("gender") == "U", F.lit("unknown")).alias("extra_note")
    good = F.to_json(F.struct(*cols, "avg_daily_watch_time", extra))
    bad = F.to_json(F.struct(*cols, F.lit("n/a").alias("avg_daily_watch_time"), extra))
    return a.select(F.when(F.col("avg_daily_watch_time").isNull(), bad).otherwise(good).alias("value"))


@query("rescue_records")
def q_rescue_records(spark, sf_dir):
    land = scratch_path(spark, "landing")
    _rescue_lines(spark, sf_dir).write.text(land)
    schema = fx.audience(spark, sf_dir).schema
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    return spark.read.parquet(target).select("user_id", "avg_daily_watch_time", "gender", cf.RESCUED)


@query("ingest_repeated_keys")
def q_ingest_repeated_keys(spark, sf_dir):
    """Lines that name a declared and an undeclared key twice."""
    a = fx.audience(spark, sf_dir)
    twice = F.concat(F.lit('{"user_id":"'), "user_id", F.lit('","gender":"first","note":"one","gender":"'),
                     F.coalesce("gender", F.lit("none")), F.lit('","note":"two"}'))
    once = F.to_json(F.struct("user_id", "gender"))
    land = scratch_path(spark, "landing")
    a.select(F.when(F.col("num_children") > 1, twice).otherwise(once).alias("value")).write.text(land)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("user_id", "gender")])
    target, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "stream-ckpt")
    ing.ingest_json_stream(spark, land, target, ckpt, schema)
    return spark.read.parquet(target)


@query("json_roundtrip")
def q_json_roundtrip(spark, sf_dir):
    a = fx.audience(spark, sf_dir)
    path = scratch_path(spark, "json")
    tb.write_json(a, path, files=4)
    return spark.read.schema(a.schema).option("dateFormat", "yyyy-MM-dd").json(path)


@query("constrained_write")
def q_constrained_write(spark, sf_dir):
    """Two writes of the labels, one refused for a null and repeated keys:
    the rows that stay readable, and what the refusal names."""
    lab = fx.labelled(spark, sf_dir)
    root = scratch_path(spark, "constrained")
    tb.materialize_checked(lab, root, key=["user_id"], not_null=["label"])
    again = lab.where(F.col("label") == 1)
    bad = lab.unionByName(again).select(
        "user_id", F.when(F.col("user_id").cast("long") % 11 != 3, F.col("label")).alias("label"))
    refused = tb.materialize_checked(bad, root, key=["user_id"], not_null=["label"])
    kept = tb.read_checked(spark, root).select(F.lit("kept").alias("what"), "user_id")
    return kept.unionByName(refused.offences.select(F.col("reason").alias("what"), "user_id"))


@query("publish_latest")
def q_publish_latest(spark, sf_dir):
    lab = fx.labelled(spark, sf_dir)
    root = scratch_path(spark, "published")
    tb.publish_snapshot(lab.where(F.col("label") == 0), root, 1)
    tb.publish_snapshot(lab.where(F.col("label") == 1), root, 2)
    return tb.read_snapshot(spark, root)


@query("predictions_sink")
def q_predictions_sink(spark, sf_dir):
    res = tr.fit_gbt(_training(spark, sf_dir))
    positives = md.score_audience(res.model, res.audience(), res.numeric)
    path = scratch_path(spark, "lal_predictions")
    tb.write_table(positives, path)
    return spark.read.parquet(path)


# -- end-to-end plans --------------------------------------------------------

from twinreach.plans import activation as act  # noqa: E402
from twinreach.plans import feature_pipeline as fp  # noqa: E402


def _pipeline(spark, sf_dir):
    landing = {n: scratch_path(spark, f"landing-{n}") for n in ("audience", "seed", "impressions")}
    tb.write_json(fx.audience(spark, sf_dir), landing["audience"])
    tb.write_json(fx.seed(spark, sf_dir), landing["seed"])
    tb.write_json(_impressions_json(spark, sf_dir), landing["impressions"])
    rules = ql.load_rules(ql.rules_frame(spark), "audience_team")
    return fp.run_feature_pipeline(spark, landing, scratch_path(spark, "pipeline"), rules,
                                   as_of=fx.AS_OF)


@query("pipeline_features")
def q_pipeline_features(spark, sf_dir):
    """The feature columns and those the audience brings; the other declared
    columns are null throughout."""
    brought = {*fx.audience(spark, sf_dir).columns, *cf.ddl_schema(cf.FEATURE_COLUMNS_DDL).names}
    features = _pipeline(spark, sf_dir).features
    return features.select(*[c for c in features.columns if c in brought])


@query("pipeline_kpi")
def q_pipeline_kpi(spark, sf_dir):
    return _pipeline(spark, sf_dir).kpi


@query("seed_window")
def q_seed_window(spark, sf_dir):
    """Second seed form: no tier filter, recency as a window before as_of."""
    return sd.select_seed(fx.audience(spark, sf_dir), genres=fx.SEED_GENRES,
                          min_watch=fx.SEED_MIN_WATCH, as_of=fx.AS_OF, window_days=181)


@query("activation")
def q_activation(spark, sf_dir):
    """Fit, then publish the positives twice; the second publication is v2."""
    res = tr.fit_gbt(_training(spark, sf_dir))
    root = scratch_path(spark, "lal_predictions")
    act.activate(res.model, res.audience(), res.numeric, root, prepared=True)
    return act.activate(res.model, res.audience(), res.numeric, root, prepared=True)


LINEITEM_RANKS = {"l_quantity": "quantity_pct", "l_extendedprice": "price_pct", "l_discount": "discount_pct"}


@query("pct_lineitem")
def q_pct_lineitem(spark, sf_dir):
    """W1 at the size of the largest table: three distributed percent ranks
    over all of ``lineitem`` (few distinct quantities and discounts: every
    value is hot)."""
    li = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_RANKS)
    return rk.global_percent_ranks(li, LINEITEM_RANKS)


@query("pct_bigint")
def q_pct_bigint(spark, sf_dir):
    """Integers beyond 2**53, which a cast to double would tie."""
    li = tb.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_orderkey").cast("long") + F.lit(9007199254740992)).alias("big"))
    return rk.global_percent_rank(li, "big", "big_pct")


@query("pct_date")
def q_pct_date(spark, sf_dir):
    """A date and a string column, each ranked in its own type."""
    o = tb.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    return rk.global_percent_ranks(o, {"day": "day_pct", "o_orderpriority": "priority_pct"})


@query("undersample_null_keys")
def q_undersample_null_keys(spark, sf_dir):
    """A ninth of the keys is null: they count as copies of one key."""
    lab = fx.labelled(spark, sf_dir).select(
        F.when(F.col("user_id").cast("long") % 9 != 4, F.col("user_id")).alias("user_id"), "label")
    return sm.undersample(lab, seed=42)


@query("publish_empty")
def q_publish_empty(spark, sf_dir):
    """A publication without rows is the newest one all the same."""
    lab = fx.labelled(spark, sf_dir)
    root = scratch_path(spark, "published")
    tb.publish_snapshot(lab, root, 1)
    tb.publish_snapshot(lab.where(F.col("label") == 7), root, 2)
    return tb.read_snapshot(spark, root)


def _two_landings(spark, first, second):
    """Land and ingest ``first``, then ``second``, with the stored schema."""
    land, target, ckpt, store = (scratch_path(spark, n) for n in ("land", "bronze", "ckpt", "schema"))
    for part in (first, second):
        tb.write_json(part, land)
        schema = ing.kept_schema(spark, land, store)
        ing.ingest_json_stream(spark, land, target, ckpt, schema)
    return target, store, schema


@query("ingest_new_column")
def q_ingest_new_column(spark, sf_dir):
    """The second landing carries a new key: kept in the rescue column, and a
    column for all rows once it is adopted."""
    lab = fx.labelled(spark, sf_dir)
    target, store, _ = _two_landings(spark, lab, lab.withColumn(
        "coupon", F.concat(F.lit("C"), "user_id")))
    schema = ing.add_columns(spark, store, T.StructType([T.StructField("coupon", T.StringType())]))
    return ing.read_bronze(spark, target, schema)


@query("ingest_type_change")
def q_ingest_type_change(spark, sf_dir):
    """The second landing has fractions in an integer column: the column
    keeps its type, and the values are in the rescue column."""
    lab = fx.labelled(spark, sf_dir)
    target, _, schema = _two_landings(spark, lab, lab.withColumn("label", F.col("label") + F.lit(0.5)))
    return ing.read_bronze(spark, target, schema)


def _history(spark, sf_dir):
    """Three publications of the labels; their root."""
    lab = fx.labelled(spark, sf_dir).withColumn("label", F.when(F.col("label") == 1, 1))
    root = scratch_path(spark, "history")
    tb.publish_snapshot(lab.where(F.col("user_id").cast("long") % 3 != 0), root, 1)
    tb.publish_snapshot(lab.where(F.col("user_id").cast("long") % 3 != 1), root, 2)
    tb.publish_snapshot(lab, root, 3)
    return root


@query("history_as_of")
def q_history_as_of(spark, sf_dir):
    """What readers saw between the second and the third publication."""
    root = _history(spark, sf_dir)
    third = tb.manifest(spark, root).where("version = 3").first()["published_at"]
    return tb.read_as_of(spark, root, third - 1)


@query("history_changes")
def q_history_changes(spark, sf_dir):
    """Rows added, removed and kept from the first publication to the second."""
    return tb.changes(spark, _history(spark, sf_dir), 1, 2)


# -- models as column expressions --------------------------------------------

@query("columns_score")
def q_columns_score(spark, sf_dir):
    """Per user and candidate, whether the fitted pipeline and its column
    expressions give the same prediction and probability."""
    from twinreach.operators import model_columns as mc

    data = tr.cut_lineage(_training(spark, sf_dir), rebalance=True)
    _metrics, models, _cat, num, _test = tr.compare(data)
    out = None
    for name, model in models.items():
        both = mc.score_columns(model, md.score(model, data, num).withColumnRenamed(
            "prediction", "whole").withColumnRenamed("probability", "whole_p"), prefix="columns_")
        same = F.col("whole") == F.col("columns_prediction")
        if "whole_p" in both.columns:
            same = same & (F.abs(F.col("whole_p") - F.col("columns_probability")) < 1e-9)
        one = both.select("user_id", F.lit(name).alias("model"), same.alias("same"))
        out = one if out is None else out.unionByName(one)
    return out


@query("columns_positives")
def q_columns_positives(spark, sf_dir):
    """Users predicted positive by one way and not by the other, counted."""
    from twinreach.operators import model_columns as mc

    res = tr.fit_gbt(_training(spark, sf_dir))
    a = md.score_audience(res.model, res.audience(), res.numeric).withColumn("whole", F.lit(1))
    b = mc.score_audience_columns(res.model, res.audience()).withColumn("columns", F.lit(1))
    both = a.groupBy("user_id").agg(F.count("whole").alias("n")).join(
        b.groupBy("user_id").agg(F.count("columns").alias("m")), "user_id", "full")
    return both.agg(F.count(F.when(~F.col("n").eqNullSafe(F.col("m")), 1)).alias("different"))


# -- category dictionaries ----------------------------------------------------

def _part_index(spark, sf_dir, min_count):
    lines = tb.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    words = pp.category_dictionary(lines, "l_partkey", min_count)
    return pp.index_by_dictionary(lines, "l_partkey", words, "part_index")


@query("category_index")
def q_category_index(spark, sf_dir):
    return _part_index(spark, sf_dir, 1)


@query("category_index_tail")
def q_category_index_tail(spark, sf_dir):
    """Part keys of fewer than 30 lines share one index."""
    return _part_index(spark, sf_dir, 30)


# -- kernel SVM ---------------------------------------------------------------

@query("kernel_svm")
def q_kernel_svm(spark, sf_dir):
    """Order lines inside a ring of (quantity, discount) against those outside,
    split by order: whether the kernel SVM and the linear one separate them."""
    from twinreach.operators import kernel as kn
    from twinreach.operators.metrics import classification_metrics

    x, y = (F.col("l_quantity").cast("double") - 25.5) / 24.5, (F.col("l_discount").cast("double") - 0.05) / 0.05
    lines = tb.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", x.alias("x"), y.alias("y"), (x * x + y * y < 0.637).cast("int").alias("label"))
    train, test = sm.hash_split(lines, "l_orderkey", 0.7, 42)
    kernel = classification_metrics(kn.fit_kernel_svm(train, ["x", "y"]).score(test), "label", "prediction")
    linear = md.evaluate(md.fit(train, md.candidate_classifiers()["SVM"], [], ["x", "y"]), test, ["x", "y"])
    rows = kernel.select(F.lit("kernel").alias("model"), "accuracy").unionByName(
        linear.select(F.lit("linear").alias("model"), "accuracy"))
    return rows.select("model", (F.col("accuracy") > 0.9).alias("separates"))
