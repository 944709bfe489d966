"""DuckDB texts for the registered queries (the independent oracle).

Each text runs on the driver's pre-registered parquet views; the derived
fixture tables are prepended as CTEs by ``with_fixtures``.
"""

from __future__ import annotations

from twinreach.operators.quality import RULES_AS_PUBLISHED, RULES_CORRECTED
from twinreach.operators.sampling import poisson_steps
from twinreach.sources.fixtures import AS_OF_SQL, with_fixtures

ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLE[name] = with_fixtures(sql)


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


DAYS = f"CAST(abs(date_diff('day', last_login_date, {AS_OF_SQL})) AS INT)"
REVENUE = ("CAST(CASE subscription_type WHEN 'Premium' THEN 20 WHEN 'Basic' THEN 6.99 "
           "WHEN '{std}' THEN 12.99 WHEN 'Free Trial' THEN 0 ELSE 0 END AS DOUBLE)")
SILVER_COLS = ("ad_interaction_rate, age_group, avg_daily_watch_time, email, favorite_genre, "
               "gender, last_login_date, num_children, subscription_length, subscription_type, user_id")
PCT = {
    "ad_interaction_rate": "ad_interaction_percentile",
    "avg_daily_watch_time": "avg_daily_watch_percentile",
    "subscription_length": "subscription_length_percentile",
}


def pct(col: str) -> str:
    return f"percent_rank() OVER (ORDER BY {col} ASC NULLS FIRST) AS {PCT[col]}"


FEATURES = (f"(SELECT {SILVER_COLS}, " + ", ".join(pct(c) for c in PCT)
            + f", {DAYS} AS days_since_last_session,"
            + f" CAST(CASE WHEN {DAYS} > 14 THEN 1 ELSE 0 END AS INT) AS is_churn, "
            + REVENUE.format(std="Ftandard") + " AS monthly_subscription_revenue FROM audience)")

# Regexes after the constraint text is parsed as an expression.
EMAIL_RE_AS_PUBLISHED = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+.[A-Z|a-z]{2,}$"
EMAIL_RE_CORRECTED = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def rule_preds(email_re: str) -> dict[str, str]:
    return {
        "email_not_null": "email IS NOT NULL",
        "email_format_valid": f"coalesce(regexp_matches(email, {q(email_re)}), false)",
        "gender_valid": "coalesce(gender IN ('M', 'F', 'Other'), false)",
    }


def report_sql(rules, email_re) -> str:
    preds = rule_preds(email_re)
    parts = []
    for name, constraint, _tag in rules:
        p = preds[name]
        parts.append(f"SELECT {q(name)} AS rule, {q(constraint)} AS \"constraint\", "
                     f"CAST(count(*) FILTER (WHERE {p}) AS BIGINT) AS passed, "
                     f"CAST(count(*) FILTER (WHERE NOT ({p})) AS BIGINT) AS failed FROM audience")
    return " UNION ALL ".join(parts)


def key_report_sql(source: str, key: str) -> str:
    return (f"SELECT CAST(sum(n) AS BIGINT) AS n_rows, "
            f"CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys, "
            f"CAST(count(k) AS BIGINT) AS distinct_keys, "
            f"CAST(count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS BIGINT) AS duplicated_keys, "
            f"CAST(coalesce(sum(n) FILTER (WHERE k IS NOT NULL AND n > 1), 0) AS BIGINT) AS duplicate_rows "
            f"FROM (SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {key}) per_key")


# -- silver, features, KPI ---------------------------------------------------
oracle("silver", f"SELECT {SILVER_COLS} FROM audience")
oracle("recency", f"SELECT user_id, {DAYS} AS days_since_last_session FROM audience")
oracle("churn", f"SELECT user_id, CAST(CASE WHEN {DAYS} > 14 THEN 1 ELSE 0 END AS INT) AS is_churn FROM audience")
oracle("revenue", "SELECT user_id, subscription_type, " + REVENUE.format(std="Ftandard")
       + " AS monthly_subscription_revenue FROM audience")
oracle("revenue_corrected", "SELECT user_id, subscription_type, " + REVENUE.format(std="Standard")
       + " AS monthly_subscription_revenue FROM audience")
oracle("pct_ad", f"SELECT user_id, ad_interaction_rate, {pct('ad_interaction_rate')} FROM audience")
oracle("pct_watch", f"SELECT user_id, avg_daily_watch_time, {pct('avg_daily_watch_time')} FROM audience")
oracle("pct_sub", f"SELECT user_id, subscription_length, {pct('subscription_length')} FROM audience")
oracle("pct_distributed", "SELECT user_id, " + ", ".join(PCT) + ", "
       + ", ".join(pct(c) for c in PCT) + " FROM audience")
oracle("features", f"SELECT * FROM {FEATURES} f")
oracle("churn_count", f"SELECT CAST(count(*) FILTER (WHERE is_churn = 1) AS BIGINT) AS churned_users, "
       f"CAST(count(*) AS BIGINT) AS n_users FROM {FEATURES} f")
oracle("kpi", f"SELECT (SELECT CAST(count(*) FILTER (WHERE is_churn = 1) AS INT) FROM {FEATURES} f) AS churned_users, "
       f"CAST((SELECT sum(monthly_subscription_revenue) FROM {FEATURES} f) AS FLOAT) AS sub_revenue, "
       f"CAST((SELECT sum(WinningPrice) FROM impressions) AS FLOAT) AS ad_revenue")
oracle("kpi_subcent", f"SELECT (SELECT CAST(count(*) FILTER (WHERE is_churn = 1) AS INT) FROM {FEATURES} f) AS churned_users, "
       f"CAST((SELECT sum(monthly_subscription_revenue) FROM {FEATURES} f) AS FLOAT) AS sub_revenue, "
       "CAST((SELECT sum(CAST(l_discount AS DOUBLE) / 25) FROM lineitem) AS FLOAT) AS ad_revenue")
oracle("epoch_login", "SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', last_login_date) AS BIGINT) * 86400 "
       "AS last_login_date FROM audience")

# -- quality -----------------------------------------------------------------
oracle("expect_report", report_sql(RULES_AS_PUBLISHED, EMAIL_RE_AS_PUBLISHED))
oracle("expect_report_corrected", report_sql(RULES_CORRECTED, EMAIL_RE_CORRECTED))
_p = rule_preds(EMAIL_RE_AS_PUBLISHED)
oracle("expect_flags", "SELECT user_id, "
       + ", ".join(f"CAST(CASE WHEN {p} THEN 1 ELSE 0 END AS INT) AS {n}" for n, p in _p.items())
       + ", CAST(" + " + ".join(f"(CASE WHEN {p} THEN 0 ELSE 1 END)" for p in _p.values())
       + " AS INT) AS failed_rules FROM audience")
oracle("expect_drop", "SELECT user_id, email, gender FROM audience WHERE "
       + " AND ".join(f"({p})" for p in _p.values()))
oracle("key_report", key_report_sql("audience", "user_id"))
oracle("key_report_repeated", key_report_sql("(SELECT * FROM seed UNION ALL SELECT * FROM seed)", "user_id_seed"))

# -- seed and labels ---------------------------------------------------------
oracle("seed_select", "SELECT user_id_seed FROM seed")
oracle("label_audience", "SELECT a.user_id, a.favorite_genre, l.label FROM audience a JOIN labelled l USING (user_id)")
oracle("label_fanout", "SELECT a.user_id, CAST(CASE WHEN s.user_id_seed IS NOT NULL THEN 1 ELSE 0 END AS INT) AS label "
       "FROM audience a LEFT JOIN (SELECT * FROM seed UNION ALL SELECT * FROM seed) s ON a.user_id = s.user_id_seed")
oracle("label_repeated_dedup", "SELECT user_id, label FROM labelled")

# -- sampling and splits -----------------------------------------------------
SHARE70 = 3006477107  # int(0.7 * 2**32)


def md5_bucket_sql(key: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5(concat({q(salt)}, {key})), 1, 8)) AS BIGINT)"


def hash60_sql(key: str, salt: str) -> str:
    return f"CAST(('0x' || substr(md5(concat({q(salt)}, {key})), 1, 15)) AS BIGINT)"


oracle("hash_split", f"SELECT user_id, label, CASE WHEN {md5_bucket_sql('user_id', '42')} < {SHARE70} "
       "THEN 'train' ELSE 'test' END AS side FROM labelled")


def draws_sql(mean: float, h: str) -> str:
    """How often a row with the 60-bit number ``h`` is drawn."""
    return " + ".join(f"({h} >= {s})::INT" for s in poisson_steps(mean))


oracle("sample_wr", "SELECT user_id, label FROM (SELECT user_id, label, unnest(range("
       f"{draws_sql(0.30, hash60_sql('user_id', '1'))})) FROM labelled) d")
oracle("sample_wr_lines", "SELECT l_orderkey, l_linenumber, l_quantity FROM (SELECT *, unnest(range("
       + draws_sql(1.7, "h") + ")) FROM (SELECT l_orderkey, l_linenumber, l_quantity, "
       + hash60_sql("concat_ws('-', l_orderkey, l_linenumber)", "5") + " AS h FROM lineitem) a) d")


def undersample_sql(source: str, seed: str) -> str:
    return ("SELECT user_id, label FROM (SELECT user_id, label, "
            "rank() OVER (PARTITION BY label ORDER BY h, user_id) AS r, min(cnt) OVER () AS k "
            f"FROM (SELECT user_id, label, {hash60_sql('user_id', seed)} AS h, "
            f"count(*) OVER (PARTITION BY label) AS cnt FROM {source}) x) y WHERE r <= k")


oracle("undersample", undersample_sql("labelled", "42"))
oracle("undersample_null_keys", undersample_sql(
    "(SELECT CASE WHEN CAST(user_id AS BIGINT) % 9 <> 4 THEN user_id END AS user_id, label FROM labelled) n",
    "42").replace("ORDER BY h, user_id", "ORDER BY h, user_id NULLS FIRST"))
oracle("undersample_copies", undersample_sql(
    "(SELECT a.user_id, CAST(CASE WHEN s.user_id_seed IS NOT NULL THEN 1 ELSE 0 END AS INT) AS label "
    "FROM audience a LEFT JOIN (SELECT * FROM seed UNION ALL SELECT * FROM seed) s "
    "ON a.user_id = s.user_id_seed) fan", "7"))

# -- projections and set operations -----------------------------------------
RULE = ("CAST(CASE WHEN favorite_genre IN ('Comedy','Documentary','Reality TV') AND avg_daily_watch_time > 60 "
        "AND last_login_date >= DATE '2001-02-02' THEN 1 ELSE 0 END AS INT)")
oracle("dedupe_rows", "SELECT DISTINCT user_id, label FROM (SELECT * FROM labelled UNION ALL "
       "SELECT * FROM labelled WHERE label = 1) u")
ALIGNED = (f"SELECT user_id, CAST(NULL AS VARCHAR) AS email, avg_daily_watch_time, num_children, {RULE} AS label "
           "FROM audience UNION ALL SELECT a.user_id, a.email, a.avg_daily_watch_time, a.num_children, l.label "
           "FROM audience a JOIN labelled l USING (user_id)")
oracle("align_union", ALIGNED)
oracle("fill_numeric", "SELECT user_id, email, coalesce(avg_daily_watch_time, 0) AS avg_daily_watch_time, "
       f"coalesce(num_children, 0) AS num_children, coalesce(label, 0) AS label FROM ({ALIGNED}) u")
oracle("map_override", "SELECT user_id, age_group, CASE WHEN "
       f"{md5_bucket_sql('user_id', '12345')} < {SHARE70} AND m IS NOT NULL THEN m ELSE g1 END AS favorite_genre "
       "FROM (SELECT user_id, age_group, CASE WHEN age_group IN ('45-54', '55+') AND favorite_genre <> 'Documentary' "
       "THEN 'Documentary' ELSE favorite_genre END AS g1, CASE age_group WHEN '18-24' THEN 'Action' "
       "WHEN '25-34' THEN 'Comedy' WHEN '55+' THEN 'Drama' END AS m FROM audience) t")
oracle("drop_helpers", "SELECT * FROM audience")
oracle("limit_ordered", "SELECT user_id, avg_daily_watch_time FROM audience "
       "ORDER BY avg_daily_watch_time DESC NULLS LAST, user_id LIMIT 10")
oracle("limit_large", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY "
       "l_extendedprice DESC, l_orderkey, l_linenumber LIMIT (SELECT count(*) // 3 FROM lineitem)")
oracle("limit_large_ties", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 <> 1 THEN "
       "l_quantity END AS quantity FROM lineitem ORDER BY quantity NULLS FIRST, l_linenumber DESC, "
       "l_orderkey LIMIT (SELECT count(*) // 2 FROM lineitem)")
oracle("latest_row", "SELECT * FROM impressions ORDER BY Timestamp DESC, ImpressionID DESC LIMIT 1")

# -- metrics -----------------------------------------------------------------
SCORED = f"(SELECT a.user_id, l.label, {RULE} AS prediction FROM audience a JOIN labelled l USING (user_id))"
oracle("class_counts", "SELECT label, count(*) AS n FROM labelled GROUP BY label")
oracle("confusion_matrix", "SELECT label, count(*) FILTER (WHERE prediction = 0) AS pred_0, "
       f"count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM {SCORED} s GROUP BY label")
oracle("class_metrics", f"""
SELECT round(sum(tp) / sum(act), 10) AS accuracy,
       round(sum(prec * act) / sum(act), 10) AS weighted_precision,
       round(sum(rec * act) / sum(act), 10) AS weighted_recall,
       round(sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END * act) / sum(act), 10) AS f1
FROM (SELECT a.label, a.act, a.tp,
             CASE WHEN coalesce(p.pred, 0) = 0 THEN 0.0 ELSE a.tp / p.pred END AS prec,
             a.tp / a.act AS rec
      FROM (SELECT label, CAST(count(*) AS DOUBLE) AS act,
                   CAST(count(*) FILTER (WHERE label = prediction) AS DOUBLE) AS tp
            FROM {SCORED} s GROUP BY label) a
      LEFT JOIN (SELECT prediction, CAST(count(*) AS DOUBLE) AS pred FROM {SCORED} s GROUP BY prediction) p
      ON a.label = p.prediction) per_class""")

# -- feature preparation -----------------------------------------------------
CAT = ["subscription_type", "favorite_genre", "age_group", "gender"]


def index_sql(col: str) -> str:
    return (f"coalesce((SELECT CAST(i AS DOUBLE) FROM (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS i "
            f"FROM (SELECT {col} AS v, count(*) AS n FROM audience WHERE {col} IS NOT NULL GROUP BY 1) c) r "
            f"WHERE r.v = a.{col}), (SELECT CAST(count(DISTINCT {col}) AS DOUBLE) FROM audience)) AS {col}_index")


oracle("string_index", "SELECT a.user_id, " + ", ".join(index_sql(c) for c in CAT) + " FROM audience a")
NUM = ["avg_daily_watch_time", "subscription_length"]
oracle("impute_mean", "SELECT user_id, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM audience)), 9) AS {c}" for c in NUM) + " FROM audience")
STD = ["avg_daily_watch_time", "subscription_length", "ad_interaction_rate"]
oracle("standardize", "SELECT user_id, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 9) AS {c}" for c in STD)
    + " FROM (SELECT user_id, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM audience)) AS {c}" for c in STD)
    + " FROM audience) imp")

# -- streams and sinks -------------------------------------------------------
oracle("ingest_conformed", f"SELECT {SILVER_COLS} FROM audience")
oracle("ingest_typed", "SELECT ImpressionID, strftime(Timestamp, '%Y-%m-%dT%H:%M:%SZ') AS Timestamp, UserID, "
       "WinningPrice, CAST(ClickThrough AS BIGINT) AS ClickThrough FROM impressions")
oracle("ingest_appended", "SELECT user_id_seed FROM seed UNION ALL SELECT user_id_seed FROM seed")
oracle("rescue_records", "SELECT user_id, avg_daily_watch_time, gender, CASE "
       "WHEN avg_daily_watch_time IS NULL AND gender = 'U' THEN '{\"avg_daily_watch_time\":\"n/a\",\"extra_note\":\"unknown\"}' "
       "WHEN avg_daily_watch_time IS NULL THEN '{\"avg_daily_watch_time\":\"n/a\"}' "
       "WHEN gender = 'U' THEN '{\"extra_note\":\"unknown\"}' END AS _rescued_data FROM audience")
oracle("ingest_repeated_keys", "SELECT user_id, CASE WHEN num_children > 1 THEN "
       "coalesce(gender, 'none') ELSE gender END AS gender, "
       "CASE WHEN num_children > 1 THEN '{\"note\":\"two\"}' END AS _rescued_data FROM audience")
oracle("constrained_write", "SELECT 'kept' AS what, user_id FROM labelled UNION ALL "
       "SELECT 'repeated key', user_id FROM labelled WHERE label = 1 UNION ALL "
       "SELECT 'null label', user_id FROM labelled WHERE CAST(user_id AS BIGINT) % 11 = 3")
oracle("json_roundtrip", "SELECT * FROM audience")
oracle("publish_empty", "SELECT user_id, label, 2 AS version FROM labelled WHERE label = 7")
oracle("publish_latest", "SELECT user_id, label, 2 AS version FROM labelled WHERE label = 1")

# -- end-to-end plans --------------------------------------------------------
oracle("pipeline_features", f"SELECT * FROM {FEATURES} f")
ORACLE["pipeline_kpi"] = ORACLE["kpi"]
oracle("seed_window", "SELECT user_id AS user_id_seed FROM audience WHERE favorite_genre IN ('Comedy','Documentary','Reality TV') AND avg_daily_watch_time > 60 AND last_login_date >= DATE '2001-02-02'")
ORACLE["pct_lineitem"] = (
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "percent_rank() OVER (ORDER BY l_quantity ASC NULLS FIRST) AS quantity_pct, "
    "percent_rank() OVER (ORDER BY l_extendedprice ASC NULLS FIRST) AS price_pct, "
    "percent_rank() OVER (ORDER BY l_discount ASC NULLS FIRST) AS discount_pct FROM lineitem")
ORACLE["pct_bigint"] = (
    "SELECT l_orderkey, l_linenumber, big, percent_rank() OVER (ORDER BY big ASC NULLS FIRST) AS big_pct "
    "FROM (SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS BIGINT) + 9007199254740992 AS big FROM lineitem) t")
ORACLE["pct_date"] = (
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, "
    "percent_rank() OVER (ORDER BY CAST(o_orderdate AS DATE) ASC NULLS FIRST) AS day_pct, "
    "percent_rank() OVER (ORDER BY o_orderpriority ASC NULLS FIRST) AS priority_pct FROM orders")
oracle("random_split_rows", "SELECT user_id, label FROM labelled")
# models: what must hold for every row, whatever was learned
oracle("scores_valid", "SELECT user_id, TRUE AS valid FROM audience")
oracle("reload_equal", "SELECT user_id, TRUE AS same FROM audience")
oracle("columns_score", "SELECT user_id, model, TRUE AS same FROM audience, (VALUES ('Logistic Regression'), "
       "('Decision Tree'), ('Random Forest'), ('SVM'), ('Gradient Boosting')) m(model)")
oracle("columns_positives", "SELECT CAST(0 AS BIGINT) AS different")
oracle("augment_sides", "SELECT user_id, side, CAST(side = 'test' AS INT) AS is_pseudo FROM (SELECT user_id, "
       "CASE WHEN ('0x' || substr(md5('42' || user_id), 1, 8))::BIGINT < CAST(0.7 * 4294967296 AS BIGINT) "
       "THEN 'train' ELSE 'test' END AS side FROM audience) s")
oracle("best_published", "SELECT CAST(0 AS BIGINT) AS not_predicted, CAST(0 AS BIGINT) AS not_published, "
       "CAST(0 AS BIGINT) AS outside")
oracle("ingest_new_column", "SELECT user_id, CAST(label AS BIGINT) AS label, NULL AS coupon, NULL AS _rescued_data "
       "FROM labelled UNION ALL SELECT user_id, label, 'C' || user_id, "
       "'{\"coupon\":\"C' || user_id || '\"}' FROM labelled")
oracle("ingest_type_change", "SELECT user_id, CAST(label AS BIGINT) AS label, NULL AS _rescued_data FROM labelled "
       "UNION ALL SELECT user_id, NULL, '{\"label\":\"' || (label + 0.5) || '\"}' FROM labelled")
# history: label 0 was published as null
oracle("history_as_of", "SELECT user_id, CASE WHEN label = 1 THEN 1 END AS label, 2 AS version FROM labelled "
       "WHERE CAST(user_id AS BIGINT) % 3 <> 1")
oracle("history_changes", "SELECT DISTINCT user_id, CASE WHEN label = 1 THEN 1 END AS label, "
       "CASE CAST(user_id AS BIGINT) % 3 WHEN 0 THEN 'added' WHEN 1 THEN 'removed' ELSE 'kept' END AS change "
       "FROM labelled")
for _name, _least in (("category_index", 1), ("category_index_tail", 30)):
    oracle(_name, "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(i, (SELECT count(*) FROM (SELECT 1 FROM lineitem "
           f"WHERE l_partkey IS NOT NULL GROUP BY l_partkey HAVING count(*) >= {_least}) k)) AS part_index "
           "FROM lineitem LEFT JOIN (SELECT l_partkey, row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS i "
           f"FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY l_partkey HAVING count(*) >= {_least}) d USING (l_partkey)")
# the rings are drawn so that a radial kernel can part them and a line can not
oracle("kernel_svm", "SELECT 'kernel' AS model, TRUE AS separates UNION ALL SELECT 'linear', FALSE")
