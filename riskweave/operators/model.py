"""Risk classifiers on Spark ML.

The forests are Spark ML models, grown level by level from counts of binned
rows (``growing``; by Spark ML's rules, in packed bytes). They will
not reproduce another library's exact numbers (different RNG and binned
splits), so their queries are row-count checked; the evaluation operators
they feed are exact and oracle-checked on deterministic scorers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dense import numbered
from .evaluate import with_class_weights
from .growing import grow_forest
from .kernels import JvmForest

# The model's features in the report's order.
CAT_COLS = ("country", "device_type", "traffic_source", "payment_method", "product_category")
NUM_COLS = ("customer_age_days", "previous_orders", "avg_order_value_eur", "order_value_eur",
            "quantity", "discount_rate", "shipping_distance_km", "delivery_days_estimated",
            "late_delivery_risk", "address_mismatch", "high_risk_ip",
            "customer_support_contacts", "review_score")
MAX_VOCABULARY = 10_000  # distinct values of a column whose codes are constants
FEATURE_COLS = tuple(f"{c}_enc" for c in CAT_COLS) + NUM_COLS


def label_encode(df: DataFrame, cols: Sequence[str] = CAT_COLS, suffix: str = "_enc",
                 max_vocabulary: int = MAX_VOCABULARY) -> DataFrame:
    """L1 (DataFrame form): code = rank of the value among the column's sorted
    distinct values, 0-based; NULL for NULL.

    One scan counts the distinct values of all columns, one reads the vocabularies
    of those with at most ``max_vocabulary``; their codes are positions in a constant
    array, so no row is exchanged. A larger column is joined to its code table, whose
    values are numbered in range partitions."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    short = [c for c in cols if sizes[c] <= max_vocabulary]
    out = df
    if short:
        vocab = df.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in short]).first()
        for c in short:
            codes = F.array(*[F.lit(v) for v in vocab[c]]) if vocab[c] else F.array(F.lit(None).cast(df.schema[c].dataType))
            out = out.withColumn(f"{c}{suffix}", (F.array_position(codes, F.col(c)) - 1).cast("int"))
    for c in cols:
        if c not in short:
            words = df.select(c).where(F.col(c).isNotNull()).distinct()
            words = numbered(words, c, f"{c}{suffix}").withColumn(f"{c}{suffix}", F.col(f"{c}{suffix}").cast("int"))
            out = out.join(words, c, "left")
    return out.select(*df.columns, *[f"{c}{suffix}" for c in cols])


def label_indexers(cols: Sequence[str] = CAT_COLS, suffix: str = "_enc") -> list[StringIndexer]:
    """L1 (ML form): StringIndexer with alphabetical codes, as LabelEncoder does."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}{suffix}", stringOrderType="alphabetAsc",
                          handleInvalid="keep") for c in cols]


def assembler(features: Sequence[str] = FEATURE_COLS) -> VectorAssembler:
    """L2: the 18 features as one vector column."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def _forest(label_col: str, num_trees: int, max_depth: int, seed: int, max_bins: int) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol=label_col, featuresCol="features", weightCol="weight",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed,
                                  featureSubsetStrategy="sqrt", maxBins=max_bins)


def _encoders(train: DataFrame) -> list:
    """Encode categoricals inside the pipeline unless ``<c>_enc`` codes are
    already present (``label_encode`` on the whole table before the split, the
    reference's order: the codes are then plain numbers to the forest)."""
    return [] if all(f"{c}_enc" in train.columns for c in CAT_COLS) else label_indexers()


def _fit(stages: list, weighted: DataFrame, forest: RandomForestClassifier) -> PipelineModel:
    before = Pipeline(stages=stages).fit(weighted)
    return PipelineModel([*before.stages, grow_forest(before.transform(weighted), forest)])


def fit_risk_model(train: DataFrame, label: str = "risk_label", num_trees: int = 300, max_depth: int = 10,
                   seed: int = 42, max_bins: int = 64) -> PipelineModel:
    """(encode) -> assemble -> balanced-weight forest for the 3-class label.
    Class codes are alphabetical, so classes are reported in sorted order."""
    weighted = with_class_weights(train, label)
    target = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")
    return _fit(_encoders(train) + [assembler(), target], weighted, _forest("label_idx", num_trees, max_depth, seed, max_bins))


def _scored(model: PipelineModel, test: DataFrame) -> DataFrame:
    """What ``model.transform`` adds, with the forest's trees walked by ``kernels``: Spark ML's nodes are objects
    that lie apart in memory, and it walks them several times as long."""
    forest = model.stages[-1]
    if forest.isSet("thresholds"):
        return model.transform(test)
    out = PipelineModel(model.stages[:-1]).transform(test)
    votes = JvmForest.of_model(test.sparkSession, forest).votes(F.col(forest.getFeaturesCol()))
    out = out.withColumn("__votes", votes).withColumn("__total", F.aggregate("__votes", F.lit(0.0), lambda s, v: s + v))
    share = F.transform("__votes", lambda v: F.coalesce(F.try_divide(v, F.col("__total")), F.lit(0.0)))
    best = F.array_position("__votes", F.array_max("__votes")) - 1
    return (out.withColumn(forest.getRawPredictionCol(), array_to_vector("__votes"))
            .withColumn(forest.getProbabilityCol(), array_to_vector(share))
            .withColumn(forest.getPredictionCol(), best.cast("double")).drop("__votes", "__total"))


def predict(model: PipelineModel, test: DataFrame, label: str = "risk_label", spark_ml: bool = False) -> DataFrame:
    """Adds ``predicted`` (class name) to the test rows; with ``spark_ml`` by Spark ML's own scorer."""
    labels = model.stages[-2].labels  # the fitted label indexer's class list (bounded by #classes)
    out = model.transform(test) if spark_ml else _scored(model, test)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels)
    return back.transform(out)


def fit_fraud_model(train: DataFrame, label: str = "is_fraud", num_trees: int = 300, max_depth: int = 10,
                    seed: int = 42, max_bins: int = 64) -> PipelineModel:
    """The same forest for the binary fraud flag."""
    weighted = with_class_weights(train, label).withColumn("label_num", F.col(label).cast("double"))
    return _fit(_encoders(train) + [assembler()], weighted, _forest("label_num", num_trees, max_depth, seed, max_bins))


def fraud_probability(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Adds ``score`` = P(fraud)."""
    return _scored(model, test).withColumn("score", vector_to_array("probability")[1])


def feature_importance(model: PipelineModel, features: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """``(feature, importance)`` descending. The importance vector has one
    entry per feature (18), so it is built on the driver as a small table."""
    forest = model.stages[-1]
    imp = forest.featureImportances.toArray().tolist()
    s = SparkSession.active()
    return (s.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], ["feature", "importance"])
            .orderBy(F.desc("importance"), "feature"))


def top_drivers(importance: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most important features (a top-k report)."""
    return importance.orderBy(F.desc("importance"), "feature").limit(n)
