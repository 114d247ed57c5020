"""Every operator as a query over the given tables.

No column of these tables holds a missing value, so queries about missing values hide
some cells by key first; the equivalent SQL hides the same ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions.kinds import col
from ..operators import evaluate as ev
from ..operators import profile
from ..operators.collinear import Collinear
from ..operators.dictionary import map_column
from ..operators.encode import Encoder, LabelEncoder
from ..operators.ensemble import hard_vote, soft_vote
from ..operators.features import GroupTiers, PassengerFeatures
from ..operators.impute import GroupMedianImputer, Imputer
from ..operators.models import FULL_GRIDS, assemble, train
from ..operators.outliers import Outliers
from ..operators.quantiles import exact_quantiles, grouped_quantiles
from ..operators.reduce import Reducer
from ..operators.split import Splitter, add_folds
from ..session import checkpointed, shared_dir
from ..sources.tables import as_records
from ..streaming.records import chain
from .workflow import fit_workflow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hide(name: str, key: str, every: int):
    """The column with the cells of every n-th key missing."""
    return F.when(col(key) % every != 0, col(name)).alias(name)


def masked_lineitem(spark, sf_dir) -> DataFrame:
    k = "l_orderkey"
    return table(spark, sf_dir, "lineitem").select(
        k, "l_linenumber", hide("l_quantity", k, 7), hide("l_extendedprice", k, 11),
        "l_discount", "l_tax", hide("l_returnflag", k, 5), "l_linestatus",
    )


def masked_orders(spark, sf_dir) -> DataFrame:
    k = "o_orderkey"
    return table(spark, sf_dir, "orders").select(
        k, "o_custkey", hide("o_totalprice", k, 7), hide("o_orderstatus", k, 5), hide("o_orderpriority", k, 6)
    )


def masked_customer(spark, sf_dir) -> DataFrame:
    k = "c_custkey"
    return table(spark, sf_dir, "customer").select(
        k, "c_nationkey", hide("c_acctbal", k, 7), hide("c_mktsegment", k, 9)
    )


def document_shape(spark, sf_dir) -> DataFrame:
    text = col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "n_chars",
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).alias("words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("lines"),
    )


def labelled_documents(spark, sf_dir) -> DataFrame:
    return document_shape(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


def training_documents(spark, sf_dir) -> DataFrame:
    """Labelled documents, written once: steps and searches read them many times, their texts only here."""
    return checkpointed(labelled_documents(spark, sf_dir))


def scored_documents(spark, sf_dir) -> DataFrame:
    """Labelled documents with a score in [0, 1) that follows from their length."""
    p = (col("n_chars") % 101) / F.lit(101.0)
    return labelled_documents(spark, sf_dir).select(
        "doc_id", F.col("quality").alias("label"), p.alias("probability"),
        ((col("words") % 53) / F.lit(53.0)).alias("other"),
        (p >= 0.5).cast("int").alias("prediction"), (col("words") % 2).cast("int").alias("second"),
        (col("doc_id") % 5).cast("int").alias("fold"),
    )


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(col(n), digits) for n in names})


# ---- sources, projection, schema ------------------------------------------------


@query
def records_out(spark, sf_dir):
    return as_records(table(spark, sf_dir, "customer"))


@query
def marker_normalize(spark, sf_dir):
    name = (
        F.when(col("p_partkey") % 10 == 0, "?").when(col("p_partkey") % 10 == 1, " N/A ")
        .when(col("p_partkey") % 10 == 2, "null").otherwise(col("p_name"))
    )
    return fn.normalise_markers(table(spark, sf_dir, "part").select("p_partkey", name.alias("p_name"), "p_brand"))


@query
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").drop("c_name", "not_a_column")


@query
def drop_sparse(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rare = F.when(col("o_orderkey") % 10 == 0, col("o_totalprice")).alias("rare")
    return profile.drop_sparse(o.select("o_orderkey", "o_totalprice", rare, hide("o_custkey", "o_orderkey", 2)), 0.8)


@query
def features_only(spark, sf_dir):
    return fn.features_and_target(table(spark, sf_dir, "labels"), "toxic")[0]


@query
def numeric_block_first(spark, sf_dir):
    return fn.numeric_then_categorical(table(spark, sf_dir, "part"), ["p_name"])


@query
def drop_missing_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    marked = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return marked.where(col("quality").isNotNull()).select("doc_id", "lang", "quality")


@query
def derived_columns(spark, sf_dir):
    net = col("l_extendedprice") * (1 - col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(net, 4).alias("net"), (col("l_quantity") > 25).alias("bulk")
    )


# ---- profiling ------------------------------------------------------------------


@query
def missing_report(spark, sf_dir):
    return profile.missing_report(masked_lineitem(spark, sf_dir))


@query
def numeric_summary(spark, sf_dir):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return profile.numeric_summary(masked_lineitem(spark, sf_dir), names)


@query
def categorical_top5(spark, sf_dir):
    return profile.categorical_summary(
        table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_name"]
    )


@query
def correlation_matrix(spark, sf_dir):
    return profile.correlation(
        masked_lineitem(spark, sf_dir), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )


@query
def correlation_embeddings(spark, sf_dir):
    """All 64 dimensions: the wide path, summed per batch instead of per pair."""
    return profile.correlation(embedding_columns(spark, sf_dir).drop("vec_id"))


@query
def target_correlation(spark, sf_dir):
    return profile.target_correlation(
        labelled_documents(spark, sf_dir), "quality", ["n_chars", "words", "lines", "toxic"]
    )


@query
def class_balance(spark, sf_dir):
    return profile.class_balance(table(spark, sf_dir, "orders"), "o_orderstatus")


@query
def class_balance_unlabelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return profile.class_balance(docs.join(table(spark, sf_dir, "labels"), "doc_id", "left"), "quality")


@query
def target_distribution(spark, sf_dir):
    found = profile.info(table(spark, sf_dir, "orders").drop("o_orderdate"), "o_orderstatus")
    return found["target_counts"].select(
        col("value"), col("count"), F.lit(found["rows"]).cast("long").alias("rows"), F.lit(found["features"]).alias("features")
    )


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "lineitem"), "l_linenumber", by_value=True)


@query
def group_median(spark, sf_dir):
    out = grouped_quantiles(masked_lineitem(spark, sf_dir), "l_returnflag", "l_extendedprice", [0.5], ["median"])
    return rounded(out, "median")


@query
def group_terciles(spark, sf_dir):
    out = grouped_quantiles(
        masked_lineitem(spark, sf_dir), "l_linestatus", "l_extendedprice", [0.33, 0.66], ["q33", "q66"]
    )
    return rounded(out, "q33", "q66")


@query
def group_median_many(spark, sf_dir):
    """As many groups as customers."""
    out = grouped_quantiles(masked_orders(spark, sf_dir), "o_custkey", "o_totalprice", [0.5], ["median"])
    return rounded(out, "median")


@query
def group_median_searched(spark, sf_dir):
    """The same with a small budget, so that most groups are narrowed by brackets."""
    out = grouped_quantiles(masked_orders(spark, sf_dir), "o_custkey", "o_totalprice", [0.5], ["median"], inline=3)
    return rounded(out, "median")


@query
def global_median(spark, sf_dir):
    q = exact_quantiles(masked_lineitem(spark, sf_dir), ["l_extendedprice"], [0.5])
    return spark.createDataFrame([(q["l_extendedprice"][0],)], "median double")


@query
def column_spread(spark, sf_dir):
    return profile.spread(masked_orders(spark, sf_dir), "o_totalprice")


# ---- imputation -----------------------------------------------------------------


def _imputed(spark, sf_dir, **strategy) -> DataFrame:
    df = masked_orders(spark, sf_dir)
    out = Imputer(**strategy).fit(df, exclude=["o_orderkey"]).transform(df)
    return rounded(out, "o_totalprice")


@query
def impute_median_unknown(spark, sf_dir):
    return _imputed(spark, sf_dir, num_strategy="median", cat_strategy="unknown")


@query
def impute_mean_mode(spark, sf_dir):
    return _imputed(spark, sf_dir, num_strategy="mean", cat_strategy="most_frequent")


@query
def impute_numeric_mode(spark, sf_dir):
    df = masked_lineitem(spark, sf_dir)
    model = Imputer("most_frequent", "unknown", num_cols=["l_quantity"], cat_cols=[]).fit(df)
    return model.transform(df).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query
def impute_group_median(spark, sf_dir):
    """Fitted without one segment, so that segment gets the global median."""
    df = masked_customer(spark, sf_dir)
    known = df.where(~col("c_mktsegment").eqNullSafe("MACHINERY"))
    out = GroupMedianImputer("c_acctbal", "c_mktsegment").fit(known).transform(df)
    return rounded(out, "c_acctbal")


@query
def impute_knn(spark, sf_dir):
    df = masked_customer(spark, sf_dir)
    out = Imputer("knn", "knn", 5).fit(df, id_col="c_custkey").transform(df)
    return rounded(out, "c_acctbal", "c_nationkey")


# ---- outliers and collinearity --------------------------------------------------


def _bounds(spark, sf_dir, detection):
    return Outliers(detection, cols=["value"]).fit(table(spark, sf_dir, "events"))


@query
def outlier_bounds_iqr(spark, sf_dir):
    return _bounds(spark, sf_dir, "iqr").bounds_frame(spark)


@query
def outlier_bounds_zscore(spark, sf_dir):
    return _bounds(spark, sf_dir, "zscore").bounds_frame(spark)


@query
def outlier_bounds_both(spark, sf_dir):
    return _bounds(spark, sf_dir, ["iqr", "zscore"]).bounds_frame(spark)


@query
def outlier_clip(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", hide("value", "event_id", 7))
    return rounded(Outliers("iqr", cols=["value"]).fit(events).transform(events), "value")


@query
def outlier_report(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return Outliers(["iqr", "zscore"]).fit(events).report(events)


@query
def outlier_modified(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _bounds(spark, sf_dir, "iqr").modified_cells(events)


def _collinear(spark, sf_dir, **kwargs):
    df = document_shape(spark, sf_dir)
    return df, Collinear(columns=["n_chars", "words", "lines"], **kwargs).fit(df)


@query
def collinear_pairs(spark, sf_dir):
    return _collinear(spark, sf_dir, threshold=0.8)[1].pairs_frame(spark)


@query
def collinear_choice(spark, sf_dir):
    return _collinear(spark, sf_dir)[1].dropped_frame(spark)


@query
def collinear_drop(spark, sf_dir):
    df, model = _collinear(spark, sf_dir)
    return model.transform(df)


@query
def collinear_drop_cells(spark, sf_dir):
    """The columns that stay, cell by cell."""
    df, model = _collinear(spark, sf_dir)
    kept = model.transform(df)
    cells = [F.struct(F.lit(c).alias("column"), col(c).cast("double").alias("value")) for c in kept.columns if c not in ("doc_id", "lang")]
    return kept.select("doc_id", F.explode(F.array(*cells)).alias("cell")).select("doc_id", "cell.column", "cell.value")


# ---- derived features -----------------------------------------------------------


@query
def extract_and_map(spark, sf_dir):
    size = fn.extract_group(col("p_name"), r"^(\w+)\s")
    groups = {"small": "compact", "large": "bulky", "red": "coloured", "blue": "coloured"}
    return table(spark, sf_dir, "part").select(
        "p_partkey", size.alias("word"), fn.map_values(size, groups, "Rare").alias("kind")
    )


@query
def row_flags(spark, sf_dir):
    return masked_orders(spark, sf_dir).select(
        "o_orderkey", fn.flag(col("o_orderstatus") == "O").alias("is_open"),
        fn.known(col("o_totalprice")).alias("price_known"),
        fn.first_char(col("o_orderpriority")).alias("priority_code"),
    )


@query
def row_arithmetic(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.sum_columns(["l_linenumber", "l_quantity"], 1).alias("total"),
        F.round(fn.ratio(col("l_extendedprice"), col("l_linenumber") - 1), 4).alias("price_per_line"),
    )


@query
def cut_bins(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", fn.cut(col("p_size"), (1, 12, 17, 35, 45), ("Child", "Teen", "Adult", "Middle")).alias("bin")
    )


@query
def tier_and_score(spark, sf_dir):
    df = masked_lineitem(spark, sf_dir).withColumn("level", col("l_linenumber") % 3 + 1)
    known = df.where("level < 3")  # level 3 is unseen and gets the middle tier
    out = GroupTiers("l_extendedprice", "level").fit(known).transform(df, "tier")
    return out.select(
        "l_orderkey", "l_linenumber", "tier", fn.rank_score(col("level"), col("tier")).alias("score")
    )


def passenger_rows(spark, sf_dir) -> DataFrame:
    """The customer table laid out like a passenger list."""
    k = col("c_custkey")
    titles = F.array(*[F.lit(t) for t in ("Mr", "Mrs", "Miss", "Master", "Dr", "Sir", "Xyz")])
    return table(spark, sf_dir, "customer").select(
        k.alias("id"),
        F.concat(F.lit("Doe, "), F.element_at(titles, (k % 7 + 1).cast("int")), F.lit(". "), col("c_name")).alias("Name"),
        (col("c_nationkey") % 3 + 1).cast("int").alias("Pclass"),
        F.when(k % 4 != 0, (k * 7 % 80).cast("double")).alias("Age"),
        (k % 3).cast("int").alias("SibSp"), (k % 2).cast("int").alias("Parch"),
        F.when(k % 13 != 0, F.abs("c_acctbal")).alias("Fare"),
        F.when(k % 3 == 0, F.concat(F.substring("c_mktsegment", 1, 1), k.cast("string"))).alias("Cabin"),
    )


@query
def passenger_features(spark, sf_dir):
    out = PassengerFeatures(["logreg"]).fit_transform(passenger_rows(spark, sf_dir), "logreg")
    return rounded(out, "FarePerPerson", "Age")


@query
def passenger_report(spark, sf_dir):
    rows = passenger_rows(spark, sf_dir)
    model = PassengerFeatures().fit(rows)
    return model.report(model.transform(rows))


# ---- encoding, projection -------------------------------------------------------


@query
def scale_standard(spark, sf_dir):
    df = masked_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber"]
    return rounded(Encoder("standard").fit_transform(df, keys, keys), "l_quantity", "l_extendedprice")


@query
def scale_minmax(spark, sf_dir):
    df = masked_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    keys = ["l_orderkey", "l_linenumber"]
    return rounded(Encoder("minmax").fit_transform(df, keys, keys), "l_quantity", "l_tax")


@query
def onehot(spark, sf_dir):
    df = masked_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return Encoder("none", "ohe").fit_transform(df, ["o_orderkey"], ["o_orderkey"])


@query
def ordinal(spark, sf_dir):
    """Fitted without one status, which then reads -1."""
    df = masked_orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    model = Encoder("none", "ordinal").fit(df.where(~col("o_orderstatus").eqNullSafe("F")), ["o_orderkey"])
    return model.transform(df, ["o_orderkey"])


@query
def label_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = LabelEncoder.fit(df, "o_orderpriority")
    return model.decode(model.encode(df, "o_orderpriority", "code"), "code", "decoded")


def customer_text(spark, sf_dir) -> DataFrame:
    """As many categories as customers."""
    key = F.when(col("o_custkey") % 11 != 4, col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("customer"))


@query
def ordinal_many(spark, sf_dir):
    """Fitted without every fifth order, so that customers only seen there read -1."""
    df = customer_text(spark, sf_dir)
    return Encoder("none", "ordinal").fit(df.where("o_orderkey % 5 <> 0"), ["o_orderkey"]).transform(df, ["o_orderkey"])


@query
def label_many(spark, sf_dir):
    df = customer_text(spark, sf_dir)
    model = LabelEncoder.fit(df, "customer")
    return model.decode(model.encode(df, "customer", "code"), "code", "decoded")


@query
def map_many(spark, sf_dir):
    """The segment of each customer of an even number."""
    segments = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(col("c_custkey").cast("string"), "c_mktsegment")
    return map_column(customer_text(spark, sf_dir), col("customer"), segments, "segment", "none")


@query
def prepare_table(spark, sf_dir):
    """Impute, clip, scale and one-hot encode one mixed table."""
    keys = ["l_orderkey", "l_linenumber"]
    df = masked_lineitem(spark, sf_dir)
    filled = Imputer("median", "unknown").fit(df, exclude=keys).transform(df)
    clipped = Outliers("iqr", cols=["l_extendedprice"]).fit(filled).transform(filled)
    out = Encoder().fit_transform(clipped, keys, keys)
    return rounded(out, "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def embedding_columns(spark, sf_dir) -> DataFrame:
    cells = [F.get(col("embedding"), i).cast("double").alias(f"e{i}") for i in range(64)]
    return table(spark, sf_dir, "embeddings").select("vec_id", *cells)


@query
def pca_fixed(spark, sf_dir):
    df = embedding_columns(spark, sf_dir)
    return Reducer(3).fit_transform(df, df.columns[1:], ["vec_id"])


@query
def pca_variance(spark, sf_dir):
    df = embedding_columns(spark, sf_dir)
    return Reducer(0.95).fit_transform(df, df.columns[1:], ["vec_id"])


@query
def pca_two_columns(spark, sf_dir):
    """Two columns, whose axes have a closed form."""
    df = document_shape(spark, sf_dir).select("doc_id", (col("n_chars") / 1000.0).alias("a"), (col("words") / 100.0).alias("b"))
    return rounded(Reducer(2).fit_transform(df, ["a", "b"], ["doc_id"]), "PC1", "PC2")


# ---- splits and folds -----------------------------------------------------------


def _sizes(df: DataFrame, *names: str) -> DataFrame:
    return df.groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))


@query
def split_stratified(spark, sf_dir):
    return _sizes(Splitter().assign(table(spark, sf_dir, "labels"), "doc_id", "quality"), "quality", "is_test")


@query
def split_plain(spark, sf_dir):
    return _sizes(Splitter(stratify=False).assign(table(spark, sf_dir, "orders"), "o_orderkey"), "is_test")


@query
def folds_in_order(spark, sf_dir):
    out = add_folds(table(spark, sf_dir, "labels"), "quality", "doc_id", 5)
    return out.select("doc_id", "quality", "fold")


@query
def folds_shuffled(spark, sf_dir):
    folds = add_folds(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", 5, shuffle=True)
    return _sizes(folds, "o_orderstatus", "fold")


@query
def folds_many(spark, sf_dir):
    """As many classes as customers."""
    return add_folds(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey", 5)


@query
def folds_text_ids(spark, sf_dir):
    """In the order of ids that are text."""
    df = table(spark, sf_dir, "orders").select(col("o_orderkey").cast("string").alias("order_id"), "o_orderpriority")
    return add_folds(df, "o_orderpriority", "order_id", 5)


@query
def folds_repeated_ids(spark, sf_dir):
    """Lines by order: an order in which a fold ends is parted by its rows."""
    folds = add_folds(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_orderkey", 5)
    return _sizes(folds, "l_orderkey", "l_returnflag", "fold")


# ---- evaluation and voting on given scores --------------------------------------


@query
def confusion(spark, sf_dir):
    return ev.confusion(scored_documents(spark, sf_dir))


@query
def class_report(spark, sf_dir):
    return rounded(ev.class_report(scored_documents(spark, sf_dir)), "precision", "recall", "f1")


@query
def binary_metrics(spark, sf_dir):
    out = ev.metrics(scored_documents(spark, sf_dir))
    return rounded(out, *out.columns)


@query
def threshold_scan(spark, sf_dir):
    return ev.threshold_scan(scored_documents(spark, sf_dir))


@query
def best_threshold(spark, sf_dir):
    best = ev.best_threshold(ev.threshold_scan(scored_documents(spark, sf_dir), scoring="f1_weighted"))
    return spark.createDataFrame([best], "threshold double, score double")


@query
def fold_accuracy(spark, sf_dir):
    return rounded(ev.fold_accuracy(scored_documents(spark, sf_dir)), "mean", "std")


@query
def vote_soft(spark, sf_dir):
    vote = soft_vote({"probability": 2.0, "other": 1.0}, 0.5)
    return scored_documents(spark, sf_dir).select("doc_id", vote.alias("vote"))


@query
def vote_hard(spark, sf_dir):
    vote = hard_vote({"prediction": 1.0, "second": 1.0})
    return scored_documents(spark, sf_dir).select("doc_id", vote.alias("vote"))


@query
def leaderboard(spark, sf_dir):
    """Accuracy of each language's score columns, ranked; the best column per language is flagged."""
    d = scored_documents(spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    hits = F.array(
        *[
            F.struct(F.lit(i).alias("seq"), F.lit(c).alias("model"), (col("label") == col(c)).cast("double").alias("hit"))
            for i, c in enumerate(("prediction", "second"))
        ]
    )
    scores = (
        d.select("lang", F.explode(hits).alias("h")).groupBy(col("lang").alias("base"), "h.seq", "h.model")
        .agg(F.round(F.avg("h.hit"), 6).alias("score"))
    )
    return ev.leaderboard(scores)


# ---- models ---------------------------------------------------------------------


def training_frame(spark, sf_dir, folds: int = 5) -> DataFrame:
    """Standardised document shape with one-hot language, label and fold."""
    df = add_folds(training_documents(spark, sf_dir).drop("toxic"), "quality", "doc_id", folds)
    meta = ["doc_id", "quality", "fold"]
    encoded = Encoder().fit_transform(df, meta, meta)
    data = encoded.withColumn("label", col("quality").cast("double")).drop("quality")
    return assemble(data, [c for c in data.columns if c not in ("doc_id", "label", "fold")], ["doc_id", "label", "fold"])


def _trained(name: str, grid=None):
    def run(spark, sf_dir):
        data = training_frame(spark, sf_dir)
        return train(name, data, grid=grid).score(data).drop("features")

    run.__name__ = f"train_{name}"
    return run


for _name in ("logreg", "decision_tree", "random_forest", "svm"):
    query(_trained(_name))
_boosted = _trained("xgboost")
_boosted.__name__ = "train_boosted_trees"
query(_boosted)
_kernel = _trained("svm", [p for p in FULL_GRIDS["svm"] if p["kernel"] == "rbf"])
_kernel.__name__ = "train_svm_rbf"
query(_kernel)


@query
def oof_report(spark, sf_dir):
    data = training_frame(spark, sf_dir)
    return train("decision_tree", data).oof_report(data, reuse=True)


@query
def tuned_threshold(spark, sf_dir):
    data = training_frame(spark, sf_dir)
    return train("logreg", data).tune_threshold(data, reuse=True)[1]


def small_frame(spark, sf_dir) -> DataFrame:
    """Labelled documents with one column of seven values, and folds by id: models of it can be written out in SQL."""
    d = labelled_documents(spark, sf_dir).select(
        "doc_id", (col("words") % 7).cast("double").alias("x"), col("quality").cast("double").alias("label"), (col("doc_id") % 5).cast("int").alias("fold"))
    return assemble(d, ["x"], ["doc_id", "label", "fold"])


@query
def tree_one_split(spark, sf_dir):
    data = small_frame(spark, sf_dir)
    out = train("decision_tree", data, grid=[{"max_depth": 1}]).score(data)
    return rounded(out.select("doc_id", "probability", "prediction"), "probability", digits=6)


@query
def oof_one_split(spark, sf_dir):
    """Every document scored by the tree that did not see its fold."""
    data = small_frame(spark, sf_dir)
    out = train("decision_tree", data, grid=[{"max_depth": 1}]).out_of_fold(data, reuse=True)
    return rounded(out.select("doc_id", "fold", "probability", "prediction"), "probability", digits=6)


@query
def boost_one_round(spark, sf_dir):
    data = small_frame(spark, sf_dir)
    grid = [{"n_estimators": 1, "max_depth": 1, "learning_rate": 0.3, "min_child_weight": 1}]
    out = train("xgboost", data, grid=grid).score(data)
    return rounded(out.select("doc_id", "probability"), "probability", digits=6)


@query
def search_one_split(spark, sf_dir):
    """Accuracy of the search: mean over folds of trees that did not see them, and the number of folds."""
    model = train("decision_tree", small_frame(spark, sf_dir), scoring="accuracy", grid=[{"max_depth": 1}])
    return spark.createDataFrame([(round(model.best_score, 6), len(model.fold_models))], "score double, folds int")


@lru_cache(maxsize=1)
def document_spec() -> dict:
    return {
        "loader": {"target_col": "quality", "id_col": "doc_id", "drop_cols": ["toxic"]},
        "cleaner": {"num_strategy": "median", "cat_strategy": "most_frequent"},
        "outliers": {"detection": ["iqr", "zscore"], "apply_to": ["logreg"]},
        "multicollinearity": {"threshold": 0.85, "apply_to": ["logreg"]},
        "pca": {"n_components": 0.95, "apply_to": ["logreg"]},
        "encoder": {"num_strategy": "standard", "cat_strategy": "ohe"},
        "models": {"active": ["logreg", "decision_tree", "random_forest", "xgboost", "svm"], "cv": 5, "scoring": "f1_weighted"},
        "ensemble": {"enabled": True, "voting": "soft", "weights": "auto"},
    }


@query
def ranked_models(spark, sf_dir):
    return fit_workflow(document_spec(), training_documents(spark, sf_dir)).leaderboard(spark)


@query
def scored_table(spark, sf_dir):
    """Train on the labelled documents, score all documents with the vote."""
    fitted = fit_workflow(document_spec(), training_documents(spark, sf_dir))
    return fitted.score(document_shape(spark, sf_dir), "ensemble")


# ---- records as they arrive -----------------------------------------------------


@query
def stream_prepared(spark, sf_dir):
    """Steps fitted on the events table, applied to the events as a stream."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    bounds = Outliers("iqr", cols=["value"]).fit(events)
    encoder = Encoder("standard", "ordinal").fit(bounds.transform(events), ["event_id"])
    arriving = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events*.parquet")
    steps = [bounds.transform, lambda d: encoder.transform(d, ["event_id"])]
    run = f"{shared_dir(spark)}/tabloom-{uuid.uuid4().hex}"
    out, state = f"{run}/rows", f"{run}/state"
    done = (
        chain(arriving.select("event_id", "event_type", "value"), steps).writeStream.format("parquet")
        .outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start(out)
    )
    done.awaitTermination()
    return rounded(spark.read.parquet(out), "value")
