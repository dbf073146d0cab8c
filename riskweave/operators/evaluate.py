"""Splits and evaluation from predictions (A14, L3, L4, L9-L11; W3, W4).

Everything here works on counts: confusion counts, class counts, score
histograms. Row-level data never meets a window without a partition key:
the exact split ranks rows inside (class, hash bucket) groups and adds bucket
offsets; the exact AUC ranks distinct scores inside equi-depth buckets and
adds bucket offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import zero_if_null_ratio
from ..functions.quantile import fractions_array, small, with_bucket
from ..session import materialize

MIN_BUCKETS = 64
BUCKET_ROWS = 1_000_000  # rows of a split's bucket, on average
BROADCAST_PLAN = 200_000  # rows of a split's plan (classes x buckets) that are broadcast


def default_order_key(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.25, seed: int = 42,
                     key: str = "order_id", order_key: Column | None = None,
                     buckets: int | None = None) -> DataFrame:
    """Exact stratified train/test split; adds ``split`` in {train, test}.

    Test size ``ceil(test_frac * n)`` shared by class by largest remainder
    (ties by class value); a null label is a class of its own. Inside a class,
    rows are taken in pseudo-random order ``(pmod(h, buckets), h, key)`` with
    ``h = xxhash64(key, seed)``. Class and bucket decide a row but for one bucket a
    class, the one that its quota cuts: only that is ranked. ``buckets`` follows the
    number of rows (64 at least)."""
    h = order_key if order_key is not None else default_order_key(key, seed)
    n = df.count()
    buckets = buckets or max(MIN_BUCKETS, -(-n // BUCKET_ROWS))
    d = df.withColumn("__h", h).withColumn("__b", F.pmod(F.col("__h"), F.lit(buckets)))
    lab = F.col(label)
    counts = d.groupBy(lab.alias("__label"), F.col("__b").alias("__bucket")).agg(F.count(F.lit(1)).alias("__nb"))
    wl = Window.partitionBy("__label").orderBy("__bucket")
    counts = counts.withColumn("__off", F.sum("__nb").over(wl) - F.col("__nb"))

    classes = counts.groupBy("__label").agg(F.sum("__nb").alias("__nc"))
    n_test = F.ceil(F.lit(float(test_frac)) * n)
    exact = F.col("__nc") * n_test / n
    classes = classes.withColumn("__base", F.floor(exact)).withColumn("__rem", exact - F.floor(exact))
    # the class table has one row per class value
    wall = Window.orderBy(F.desc("__rem"), F.col("__label"))
    classes = classes.select(F.col("__label").alias("__class"), (F.col("__base") + F.when(
        F.row_number().over(wall) <= n_test - F.sum("__base").over(Window.partitionBy(F.lit(1))), 1).otherwise(0))
        .alias("__quota"))
    plan = materialize(counts.join(classes, F.col("__label").eqNullSafe(F.col("__class"))).select(
        "__label", "__bucket", "__off", "__quota", (F.col("__off") + F.col("__nb") <= F.col("__quota")).alias("__all"),
        (F.col("__off") >= F.col("__quota")).alias("__none")))
    # classes x buckets rows, broadcast after counting
    ranked = d.join(small(plan, BROADCAST_PLAN), lab.eqNullSafe(F.col("__label")) & (F.col("__b") == F.col("__bucket")))
    whole = ranked.filter(F.col("__all") | F.col("__none")).withColumn(
        "split", F.when(F.col("__all"), "test").otherwise("train"))
    wb = Window.partitionBy("__label", "__b").orderBy("__h", key)
    cut = ranked.filter(~F.col("__all") & ~F.col("__none")).withColumn(
        "split", F.when(F.col("__off") + F.row_number().over(wb) <= F.col("__quota"), "test").otherwise("train"))
    return whole.unionByName(cut).select(*df.columns, "split")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """L4: balanced weights ``n / (k * n_c)`` per class: ``(label, weight)``."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    all_ = Window.partitionBy(F.lit(1))
    return c.select(label, (F.sum("n_c").over(all_) / (F.count(F.lit(1)).over(all_) * F.col("n_c"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Each row's class weight, by a join with the counted class table (no
    row is exchanged); a null label is a class too."""
    weights = materialize(class_weights(df, label).select(F.col(label).alias("__class"), F.col("weight").alias(name)))
    return df.join(small(weights), F.col(label).eqNullSafe(F.col("__class"))).drop("__class")


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A14 long form: ``(actual, predicted, count)``."""
    return (pred.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("count")))


def confusion_matrix(pred: DataFrame, classes: Sequence, label: str = "label",
                     prediction: str = "prediction", other: str | None = None) -> DataFrame:
    """Rows actual, one column per predicted class, in class order;
    every class appears as a row even if absent. ``other`` names a column for predictions outside
    of ``classes`` (missing ones too), which are left out of the matrix otherwise."""
    spark = pred.sparkSession
    cls = spark.createDataFrame([(c, i) for i, c in enumerate(classes)], ["actual", "__pos"])
    wide = (pred.groupBy(F.col(label).alias("actual"))
            .pivot(prediction, list(classes)).agg(F.count(F.lit(1))))
    out = cls.join(wide, "actual", "left").na.fill(0, [str(c) for c in classes])
    if other:
        known = F.coalesce(F.col(prediction).isin(list(classes)), F.lit(False))
        rest = pred.groupBy(F.col(label).alias("actual")).agg(F.count_if(~known).alias(other))
        out = out.join(rest, "actual", "left").na.fill(0, [other])
    return out.orderBy("__pos").drop("__pos")


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(class, precision, recall, f1_score, support)`` per class, then
    ``accuracy``, ``macro avg``, ``weighted avg`` rows; 0/0 counts as 0. The confusion counts are read
    several times, so they are made once: predictions cost more than all the rest."""
    cc = materialize(confusion_counts(pred, label, prediction))
    actual = cc.groupBy(F.col("actual").alias("class")).agg(F.sum("count").alias("support"))
    predicted = cc.groupBy(F.col("predicted").alias("class")).agg(F.sum("count").alias("n_pred"))
    tp = cc.filter(F.col("actual") == F.col("predicted")).select(F.col("actual").alias("class"),
                                                                  F.col("count").alias("tp"))
    per = (actual.join(predicted, "class", "full").join(tp, "class", "left")
           .na.fill(0, ["support", "n_pred", "tp"]))
    p = zero_if_null_ratio(F.col("tp"), F.col("n_pred"))
    r = zero_if_null_ratio(F.col("tp"), F.col("support"))
    per = per.select(F.col("class").cast("string").alias("class"), p.alias("precision"), r.alias("recall"),
                     "support", "tp")
    per = per.withColumn("f1_score", zero_if_null_ratio(
        F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    tot = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"))
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("n")).alias("f1_score"),
                 F.col("n").alias("support"), F.lit(1).alias("__o")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1_score"), F.col("n").alias("support"), F.lit(2).alias("__o")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"), F.col("n").alias("support"),
                 F.lit(3).alias("__o")))))
    rows = per.select("class", "precision", "recall", "f1_score", "support", F.lit(0).alias("__o"))
    return rows.unionByName(summary).orderBy("__o", "class").drop("__o")


def roc_auc(pred: DataFrame, label: str = "label", score: str = "score",
            buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC (ties count one half), one row ``auc``; NULL if a class
    is missing.

    AUC = sum over distinct scores s of pos(s) * (neg_below(s) + neg(s)/2) / (P N).
    neg_below is a prefix sum over sorted distinct scores: distinct scores are
    put in equi-depth buckets (approximate quantiles + code-generated
    search), prefix sums of bucket totals give offsets, and only inside a
    bucket are scores ranked -- no unpartitioned window over the data. Products of
    counts are taken in double, which cannot overflow. Missing scores go once the counts are made:
    a filter before them would work out a model's score again."""
    y = F.col(label).cast("int")
    s = materialize(pred.filter(F.col(label).isNotNull())
                    .groupBy(F.col(score).cast("double").alias("s"))
                    .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))).filter("s is not null")
    buckets = buckets or (1_024 if s.count() <= 1_024 * BUCKET_ROWS else 9_216)
    bounds = s.select(F.percentile_approx("s", fractions_array(buckets), buckets * 32)).scalar()
    b = with_bucket(s.withColumn("__bounds", bounds), "__bounds", "s", buckets).drop("__bounds")
    tot = b.groupBy("bucket").agg(F.sum("neg").alias("bneg"))
    tot = tot.withColumn("off", F.sum("bneg").over(Window.partitionBy(F.lit(1)).orderBy("bucket")) - F.col("bneg"))
    wb = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    b = b.join(F.broadcast(tot.select("bucket", "off")), "bucket").withColumn(
        "neg_below", (F.col("off") + F.sum("neg").over(wb) - F.col("neg")).cast("double"))
    num = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") * F.lit(0.5)))
    return b.agg(F.try_divide(num, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))
