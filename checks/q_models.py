"""Association rules, splits and classification queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from vitrine.functions.numeric import half_even
from vitrine.operators import classify, features, metrics, rules, scoring, splits
from vitrine.session import scratch_path, store_table

from .fixtures import baskets, products
from .oracle_views import PRODUCTS, np_round, scored_view
from .q_scores import SCORED, scored
from .registry import query

PAIRS = "pairs AS (SELECT DISTINCT l_orderkey AS g, {item} AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"


def mined(pairs_cte, support, confidence=None, lift=None):
    """CTEs ``sets(m, freq, support)`` and ``found``: subsets as bit masks over the sorted vocabulary."""
    return f"""{pairs_cte}, vocab AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS b FROM (SELECT DISTINCT item FROM pairs)),
masks AS (SELECT g, CAST(SUM(CAST(1 AS BIGINT) << b) AS BIGINT) AS bm FROM pairs JOIN vocab USING (item) GROUP BY g),
grouped AS (SELECT bm, COUNT(*) AS c FROM masks GROUP BY bm), total AS (SELECT SUM(c) AS n FROM grouped),
sets AS (SELECT m, CAST(SUM(c) AS BIGINT) AS freq, CAST(SUM(c) AS DOUBLE) / MAX(n) AS support
  FROM (SELECT unnest(generate_series(1, (SELECT (1 << COUNT(*)) - 1 FROM vocab))) AS m) s
  JOIN grouped ON (bm & m) = m, total GROUP BY m HAVING SUM(c) >= {support} * MAX(n)),
named AS (SELECT m, string_agg(item, ', ' ORDER BY item) AS items, CAST(COUNT(*) AS INTEGER) AS size
  FROM sets JOIN vocab ON (m >> b) & 1 = 1 GROUP BY m)"""


def ruled(confidence, lift):
    return f"""found AS (SELECT na.items AS antecedents, v.item AS consequents, s.support AS support,
  CAST(s.freq AS DOUBLE) / a.freq AS confidence, CAST(s.freq AS DOUBLE) / a.freq / c.support AS lift
  FROM sets s JOIN vocab v ON (s.m >> v.b) & 1 = 1 JOIN sets a ON a.m = s.m - (CAST(1 AS BIGINT) << v.b)
  JOIN sets c ON c.m = CAST(1 AS BIGINT) << v.b JOIN named na ON na.m = a.m
  WHERE CAST(s.freq AS DOUBLE) / a.freq >= {confidence} AND CAST(s.freq AS DOUBLE) / a.freq / c.support >= {lift})"""


TYPES = PAIRS.format(item="p_type")
RULE_COLS = f"antecedents, consequents, {np_round('support', 4)} AS support, {np_round('confidence', 4)} AS confidence, {np_round('lift', 4)} AS lift"


def order_sets(spark, sf):
    return rules.build_baskets(baskets(spark, sf), "l_orderkey", "item")


@query("order_baskets", f"WITH {TYPES} SELECT g AS l_orderkey, string_agg(item, ', ' ORDER BY item) AS items FROM pairs GROUP BY g")
def order_baskets(spark, sf):
    return order_sets(spark, sf).select("l_orderkey", F.array_join("items", ", ").alias("items"))


@query("shop_baskets", f"""WITH {PRODUCTS} SELECT marque_vendeur, string_agg(DISTINCT categorie, ', ' ORDER BY categorie) AS items
FROM products GROUP BY marque_vendeur""")
def shop_baskets(spark, sf):
    return rules.build_baskets(products(spark, sf)).select("marque_vendeur", F.array_join("items", ", ").alias("items"))


KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("basket_onehot", f"WITH {TYPES} SELECT g AS l_orderkey, " + ", ".join(
    f"CAST(MAX(CASE WHEN item = '{k}' THEN 1 ELSE 0 END) AS INTEGER) AS \"{k}\"" for k in KINDS) + " FROM pairs GROUP BY g")
def basket_onehot(spark, sf):
    return rules.basket_onehot(baskets(spark, sf), "l_orderkey", "item", KINDS)


WORDS = """words AS (SELECT DISTINCT l_orderkey AS g, unnest(string_split(p_name, ' ')) AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
vocab AS (SELECT item, row_number() OVER (ORDER BY item) - 1 AS place FROM (SELECT DISTINCT item FROM words))"""


def order_words(spark, sf):
    """(order, word) pairs of the names of the parts sold."""
    pairs = baskets(spark, sf, "p_name")
    return pairs.select("l_orderkey", F.explode(F.split("item", " ")).alias("word"))


@query("basket_vectors", f"""WITH {WORDS} SELECT g AS l_orderkey, CAST(COUNT(*) AS DOUBLE) AS ones,
string_agg(place, ',' ORDER BY place) AS places FROM words JOIN vocab USING (item) GROUP BY g""")
def basket_vectors(spark, sf):
    """Sparse vectors over the words of the names, shown by their places."""
    vectors, _ = rules.basket_vectors(order_words(spark, sf), "l_orderkey", "word")
    x = vector_to_array("items")
    held = F.filter(F.transform(x, lambda v, i: F.when(v == 1.0, i)), lambda i: i.isNotNull())
    return vectors.select("l_orderkey", F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("ones"),
                          F.array_join(held, ",").alias("places"))


@query("basket_vocabulary", f"WITH {WORDS} SELECT item, CAST(place AS INTEGER) AS place FROM vocab")
def basket_vocabulary(spark, sf):
    return rules.basket_vectors(order_words(spark, sf), "l_orderkey", "word")[1]


@query("frequent_itemsets", f"WITH {mined(TYPES, 0.05)} SELECT items, size, freq, {np_round('support', 4)} AS support FROM sets JOIN named USING (m)")
def frequent_itemsets(spark, sf):
    return rules.frequent_itemsets(order_sets(spark, sf), 0.05)


@query("frequent_itemsets_brands", f"""WITH {PAIRS.format(item='p_brand')}, n AS (SELECT COUNT(DISTINCT g) AS n FROM pairs),
one AS (SELECT item AS items, 1 AS size, COUNT(*) AS freq FROM pairs GROUP BY item),
two AS (SELECT a.item || ', ' || b.item AS items, 2 AS size, COUNT(*) AS freq FROM pairs a JOIN pairs b ON a.g = b.g AND a.item < b.item GROUP BY ALL),
three AS (SELECT a.item || ', ' || b.item || ', ' || c.item AS items, 3 AS size, COUNT(*) AS freq FROM pairs a
  JOIN pairs b ON a.g = b.g AND a.item < b.item JOIN pairs c ON c.g = b.g AND b.item < c.item GROUP BY ALL)
SELECT items, size, freq, {np_round('CAST(freq AS DOUBLE) / n', 4)} AS support
FROM (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three), n WHERE freq >= 0.01 * n""")
def frequent_itemsets_brands(spark, sf):
    return rules.frequent_itemsets(rules.build_baskets(baskets(spark, sf, "p_brand"), "l_orderkey", "item"), 0.01)


@query("association_rules", f"WITH {mined(TYPES, 0.05)}, {ruled(0.3, 1.0)} SELECT {RULE_COLS} FROM found")
def association_rules(spark, sf):
    return rules.association_rules(order_sets(spark, sf), 0.05, 0.3, 1.0)


@query("association_analysis", f"WITH {mined(TYPES, 0.05)}, {ruled(0.3, 0.5)} SELECT {RULE_COLS} FROM found")
def association_analysis(spark, sf):
    return rules.run_association_analysis(baskets(spark, sf), "l_orderkey", "item",
                                          sink=scratch_path(spark, "rules"))


@query("top_rules", f"""WITH {mined(TYPES, 0.05)}, {ruled(0.3, 0.5)}, r AS (SELECT {RULE_COLS} FROM found)
SELECT * FROM r ORDER BY lift DESC, antecedents, consequents LIMIT 10""")
def top_rules(spark, sf):
    return rules.top_rules(rules.association_rules(order_sets(spark, sf), 0.05, 0.3, 0.5), 10)


SHOP_PAIRS = PRODUCTS + ", pairs AS (SELECT DISTINCT marque_vendeur AS g, categorie AS item FROM products)"


@query("shop_rules", f"WITH {mined(SHOP_PAIRS, 0.1)}, {ruled(0.5, 1.0)} SELECT {RULE_COLS} FROM found")
def shop_rules(spark, sf):
    return rules.association_rules(rules.build_baskets(products(spark, sf)))


LABELLED = f"""{SCORED}, labelled AS MATERIALIZED (SELECT *, CASE WHEN topk_score >= (SELECT quantile_cont(topk_score, 0.6) FROM scored)
THEN 1 ELSE 0 END AS y, rating / 5e0 AS prob, CASE WHEN rating / 5e0 >= 0.7e0 THEN 1 ELSE 0 END AS pred FROM scored)"""


def labelled(spark, sf):
    df = scoring.quantile_label(scored(spark, sf), "topk_score", 0.6, "y")
    return df.withColumns({"prob": F.col("rating") / 5.0}).withColumn("pred", (F.col("prob") >= 0.7).cast("int")) \
        .select("product_id", "y", "prob", "pred")


HASHED = """hashed AS (SELECT product_id, y, row_number() OVER (PARTITION BY y ORDER BY ('0x' || substr(md5('42|' || product_id), 1, 13))::BIGINT,
product_id) - 1 AS pos, COUNT(*) OVER (PARTITION BY y) AS n FROM labelled)"""


@query("stratified_split", f"WITH {LABELLED}, {HASHED} SELECT product_id, y, CASE WHEN pos * 5 < n THEN 1 ELSE 0 END AS is_test FROM hashed")
def stratified_split(spark, sf):
    return splits.stratified_split(labelled(spark, sf).select("product_id", "y"), "y", "product_id")


@query("stratified_folds", f"WITH {LABELLED}, {HASHED} SELECT product_id, y, CAST(pos * 5 // n AS INTEGER) AS fold FROM hashed")
def stratified_folds(spark, sf):
    return splits.stratified_folds(labelled(spark, sf).select("product_id", "y"), "y", "product_id")


def labelled_text(spark, sf):
    """Products with the text ids that ingestion gives."""
    return labelled(spark, sf).select(F.col("product_id").cast("string").alias("product_id"), "y")


TEXT_HASHED = HASHED.replace("product_id)", "CAST(product_id AS VARCHAR))")


@query("stratified_split_text", f"WITH {LABELLED}, {TEXT_HASHED} SELECT CAST(product_id AS VARCHAR) AS product_id, y, "
       "CASE WHEN pos * 5 < n THEN 1 ELSE 0 END AS is_test FROM hashed")
def stratified_split_text(spark, sf):
    return splits.stratified_split(labelled_text(spark, sf), "y", "product_id")


@query("stratified_folds_text", f"WITH {LABELLED}, {TEXT_HASHED} SELECT CAST(product_id AS VARCHAR) AS product_id, y, "
       "CAST(pos * 5 // n AS INTEGER) AS fold FROM hashed")
def stratified_folds_text(spark, sf):
    return splits.stratified_folds(labelled_text(spark, sf), "y", "product_id")


@query("class_weights", f"""WITH {LABELLED}, c AS (SELECT y AS label, COUNT(*) AS n FROM labelled GROUP BY y)
SELECT label, n, {np_round('(SELECT CAST(SUM(n) AS DOUBLE) FROM c) / ((SELECT COUNT(*) FROM c) * n)', 6)} AS balanced,
{np_round('(SELECT CAST(n AS DOUBLE) FROM c WHERE label = 0) / (SELECT n FROM c WHERE label = 1)', 6)} AS scale_pos_weight FROM c""")
def class_weights(spark, sf):
    df = splits.class_weights(labelled(spark, sf), "y")
    return df.withColumns({c: half_even(F.col(c), 6) for c in ("balanced", "scale_pos_weight")})


@query("confusion_matrix", f"""WITH {LABELLED} SELECT a AS actual, p AS predicted, COUNT(y) AS n FROM
(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(a, p) LEFT JOIN labelled ON y = a AND pred = p GROUP BY a, p""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(labelled(spark, sf))


CELLS = """cells AS (SELECT CAST(COUNT(*) FILTER (y = 0 AND pred = 0) AS DOUBLE) AS tn, CAST(COUNT(*) FILTER (y = 0 AND pred = 1) AS DOUBLE) AS fp,
CAST(COUNT(*) FILTER (y = 1 AND pred = 0) AS DOUBLE) AS fn, CAST(COUNT(*) FILTER (y = 1 AND pred = 1) AS DOUBLE) AS tp FROM labelled),
m AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS acc, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0 FROM cells),
f AS (SELECT *, 2e0 * p1 * r1 / (p1 + r1) AS f1, 2e0 * p0 * r0 / (p0 + r0) AS f0, tn + fp AS s0, tp + fn AS s1 FROM m)"""


@query("binary_metrics", f"""WITH {LABELLED}, {CELLS} SELECT {np_round('acc', 6)} AS accuracy, {np_round('p1', 6)} AS precision,
{np_round('r1', 6)} AS recall, {np_round('f1', 6)} AS f1 FROM f""")
def binary_metrics(spark, sf):
    return metrics.binary_metrics(labelled(spark, sf))


def _row(name, p, r, f, s):
    return (f"SELECT '{name}' AS row, {np_round(p, 6)} AS precision, {np_round(r, 6)} AS recall, {np_round(f, 6)} AS f1, "
            f"CAST({s} AS BIGINT) AS support FROM f")


@query("class_report", f"WITH {LABELLED}, {CELLS} " + " UNION ALL ".join([
    _row("Non-Top", "p0", "r0", "f0", "s0"), _row("Top", "p1", "r1", "f1", "s1"),
    _row("macro avg", "(p0 + p1) / 2e0", "(r0 + r1) / 2e0", "(f0 + f1) / 2e0", "s0 + s1"),
    _row("weighted avg", "(p0 * s0 + p1 * s1) / (s0 + s1)", "(r0 * s0 + r1 * s1) / (s0 + s1)", "(f0 * s0 + f1 * s1) / (s0 + s1)", "s0 + s1")]))
def class_report(spark, sf):
    return metrics.class_report(labelled(spark, sf))


ROC = """steps AS (SELECT prob AS threshold, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM labelled GROUP BY prob),
points AS (SELECT *, SUM(pos) OVER w AS tps, SUM(neg) OVER w AS fps, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n,
lead(pos) OVER w2 AS np, lead(neg) OVER w2 AS nn, row_number() OVER w2 AS rn FROM steps
WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING), w2 AS (ORDER BY threshold DESC))"""
ROC_COLS = f"threshold, {np_round('CAST(fps AS DOUBLE) / n', 6)} AS fpr, {np_round('CAST(tps AS DOUBLE) / p', 6)} AS tpr"


@query("roc_curve", f"WITH {LABELLED}, {ROC} SELECT {ROC_COLS} FROM points UNION ALL SELECT NULL, 0e0, 0e0")
def roc_curve(spark, sf):
    return metrics.roc_curve(labelled(spark, sf))


@query("roc_curve_corners", f"""WITH {LABELLED}, {ROC} SELECT {ROC_COLS} FROM points
WHERE rn = 1 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT NULL, 0e0, 0e0""")
def roc_curve_corners(spark, sf):
    return metrics.roc_curve(labelled(spark, sf), drop_intermediate=True)


@query("auc_exact", f"""WITH {LABELLED}, ranks AS (SELECT y, rank() OVER (ORDER BY prob) + (COUNT(*) OVER (PARTITION BY prob) - 1) / 2e0 AS r FROM labelled),
s AS (SELECT SUM(CASE WHEN y = 1 THEN r END) AS rs, CAST(COUNT(*) FILTER (y = 1) AS DOUBLE) AS p, CAST(COUNT(*) FILTER (y = 0) AS DOUBLE) AS n FROM ranks)
SELECT {np_round('(rs - p * (p + 1e0) / 2e0) / (p * n)', 6)} AS auc FROM s""")
def auc_exact(spark, sf):
    return metrics.auc_exact(labelled(spark, sf))


def training_frame(spark, sf):
    """Catalogue with the collector's label (a function of its features, so learnable)."""
    df = features.encode_labels(scoring.score_collected(products(spark, sf)), ["categorie", "plateforme", "pays_shop"])
    return df


_TRAINED: dict = {}


def once(spark, sf, name, train):
    """What ``train`` returns, trained once for each application and scale."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _TRAINED:
        _TRAINED[key] = train(store_table(training_frame(spark, sf), "training"))
    return _TRAINED[key]


def forest(spark, sf):
    return once(spark, sf, "forest", classify.train_random_forest)


def boosted(spark, sf):
    return once(spark, sf, "boosted", classify.train_boosted_trees)


def folds_of(spark, sf, name, estimator):
    return once(spark, sf, f"folds of {name}",
                lambda df: store_table(classify.cross_validated_f1(df, estimator()), "folds"))


def cross_validated(spark, sf):
    """Five folds of both models, one row each."""
    parts = [folds_of(spark, sf, name, estimator).select(F.lit(name).alias("model"), "*") for name, estimator in
             (("Random Forest", classify.random_forest), ("Boosted Trees", classify.boosted_trees))]
    return parts[0].unionByName(parts[1])


@query("rf_metrics")
def rf_metrics(spark, sf):
    return forest(spark, sf)[1]


@query("gbt_metrics")
def gbt_metrics(spark, sf):
    return boosted(spark, sf)[1]


@query("cv_f1")
def cv_f1(spark, sf):
    return cross_validated(spark, sf)


@query("feature_importance")
def feature_importance(spark, sf):
    model, _, names = forest(spark, sf)
    return classify.feature_importance(spark, model, names)


@query("model_comparison")
def model_comparison(spark, sf):
    """Held-out metrics and cross-validated F1 of both models."""
    rows = [part.select(F.lit(name).alias("model"), "*") for name, part in
            (("Random Forest", forest(spark, sf)[1]), ("Boosted Trees", boosted(spark, sf)[1]))]
    return rows[0].unionByName(rows[1]).join(cross_validated(spark, sf).select("model", "cv_f1_mean"), "model")


@query("class_probability")
def class_probability(spark, sf):
    return forest(spark, sf)[0].predictions.select("product_id", "y", "pred", "prob")


@query("model_artifact")
def model_artifact(spark, sf):
    """Model saved to the shared folder, loaded again, and applied to its test rows."""
    trained, _, _ = forest(spark, sf)
    path = classify.save_model(trained.model, scratch_path(spark, "model"))
    return classify.score(classify.load_model(path), trained.test).select("product_id", "y", "pred", "prob")
