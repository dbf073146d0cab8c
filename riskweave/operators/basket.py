"""Attribute "baskets", frequent itemsets and association rules (M1-M7).

Each order is a transaction of at most ``len(cats) + len(flags)`` items (10
with the default schema), so expanding one order into its itemsets of size
<= 3 emits at most C(10,1)+C(10,2)+C(10,3) = 175 rows -- a bound fixed by the
schema, not by the data. The expansion and the partial aggregate run in the
same stage, so hot itemsets collapse on the map side.

Size bounds used for broadcasts: the supports of all items sum to the mean
basket size (<= 10), so at most ``10 / min_support`` items can be frequent;
likewise at most ``175 / min_support`` frequent itemsets of size <= 3.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .itemsets import frequent_by_level

MAX_COLUMNS = 5_000  # of a one-hot matrix
# The report's attributes.
BASKET_CATS = ("country", "payment_method", "product_category", "traffic_source", "device_type")
BASKET_FLAGS = ("high_risk_ip", "address_mismatch", "late_delivery_risk", "is_fraud", "is_returned")


def item_array(cats: Sequence[str] = BASKET_CATS, flags: Sequence[str] = BASKET_FLAGS) -> Column:
    """M1: ``column_value`` for each categorical (a missing value becomes the
    text ``nan``, as string-casting a missing cell does in pandas) plus the
    names of the flags that equal 1; sorted."""
    parts = [F.concat(F.lit(f"{c}_"), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in cats]
    parts += [F.when(F.col(f) == 1, F.lit(f)) for f in flags]
    return F.array_sort(F.filter(F.array(*parts), lambda x: x.isNotNull()))


def order_items(df: DataFrame, cats: Sequence[str] = BASKET_CATS, flags: Sequence[str] = BASKET_FLAGS,
                key: str = "order_id") -> DataFrame:
    """M1: ``(order_id, items ARRAY<STRING>)``."""
    return df.select(key, item_array(cats, flags).alias("items"))


def one_hot(df: DataFrame, cats: Sequence[str] = BASKET_CATS, flags: Sequence[str] = BASKET_FLAGS,
            key: str = "order_id", vocabulary: Sequence[str] | None = None) -> DataFrame:
    """M2: boolean one-hot view (one column per item). Unless given, the item
    vocabulary is read from the data, while the plan is built (a distinct over
    categorical values; more than ``MAX_COLUMNS`` is an error, not a matrix); the
    matrix itself stays distributed."""
    if vocabulary is not None:
        items = item_array(cats, flags)
        return df.select(key, *[F.array_contains(items, F.lit(n)).alias(n) for n in vocabulary],
                         *[(F.col(f) == 1).alias(f) for f in flags])
    vocab = (df.select(F.explode(F.array(*[
        F.concat(F.lit(f"{c}_"), F.coalesce(F.col(c).cast("string"), F.lit("nan"))) for c in cats])).alias("i"))
        .distinct().orderBy("i"))
    names = [r["i"] for r in vocab.limit(MAX_COLUMNS + 1).collect()]
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} items: use order_items")
    return one_hot(df, cats, flags, key, names)


def _subsets(items: Column, max_len: int) -> Column:
    """All non-empty subsets of size <= max_len of a sorted array, as sorted arrays."""
    n = F.size(items)
    idx = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    one = F.transform(items, lambda x: F.array(x))
    out = [one]
    if max_len >= 2:
        two = F.flatten(F.transform(idx, lambda i: F.transform(
            F.filter(idx, lambda j: j > i), lambda j: F.array(F.get(items, i), F.get(items, j)))))
        out.append(two)
    if max_len >= 3:
        three = F.flatten(F.flatten(F.transform(idx, lambda i: F.transform(
            F.filter(idx, lambda j: j > i), lambda j: F.transform(
                F.filter(idx, lambda k: k > j),
                lambda k: F.array(F.get(items, i), F.get(items, j), F.get(items, k)))))))
        out.append(three)
    arr = F.concat(*out)
    return F.when(n > 0, arr).otherwise(F.array().cast("array<array<string>>"))


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.004, max_len: int = 3,
                      items: str = "items", method: str = "expand") -> DataFrame:
    """M3: ``(itemset ARRAY<STRING> sorted, size, count, support)`` with
    ``support = count / n_transactions >= min_support``.

    ``method="expand"``: drop infrequent items, expand each basket into its
    subsets of size <= max_len, count. ``method="fpgrowth"``: Spark ML's
    parallel FP-growth (for wide baskets), cut to ``max_len``. ``method="levels"``: grown
    level by level, for any length; what ``"expand"`` does beyond three items, too."""
    n = baskets.select(F.count(F.lit(1))).scalar()
    if method == "fpgrowth":
        from pyspark.ml.fpm import FPGrowth
        model = FPGrowth(itemsCol=items, minSupport=min_support).fit(baskets.select(items))
        fs = model.freqItemsets.select(F.array_sort("items").alias("itemset"), F.col("freq").alias("count"))
        fs = fs.filter(F.size("itemset") <= max_len)
    elif method == "levels" or max_len > 3:
        fs = frequent_by_level(baskets, min_support, max_len, items, n)
    else:
        # baskets repeat: there are at most as many as combinations of values
        distinct = materialize(baskets.groupBy(F.col(items).alias("items")).agg(F.count(F.lit(1)).alias("times")))
        single = (distinct.select(F.explode("items").alias("item"), "times")
                  .groupBy("item").agg(F.sum("times").alias("c"))
                  .filter(F.col("c") / n >= F.lit(float(min_support))))
        # at most 10 / min_support items can be frequent: a proven bound for the scalar
        frequent = single.select(F.array_sort(F.collect_list("item"))).scalar()
        pruned = (distinct.select(F.sort_array(F.array_intersect("items", frequent)).alias("items"), "times")
                  .groupBy("items").agg(F.sum("times").alias("times")))
        fs = (pruned.select(F.explode(_subsets(F.col("items"), max_len)).alias("itemset"), "times")
              .groupBy("itemset").agg(F.sum("times").alias("count")))
    fs = fs.withColumn("support", F.col("count") / n).filter(F.col("support") >= F.lit(float(min_support)))
    return fs.select("itemset", F.size("itemset").alias("size"), "count", "support")


def association_rules(itemsets: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """M4: every split of every frequent itemset (size >= 2) into a non-empty
    antecedent X and consequent Y = S \\ X:
    ``(antecedents, consequents, antecedent_support, consequent_support,
    support, confidence, lift)`` with lift >= min_lift.

    X and Y are frequent by downward closure; their supports come from two
    equi-joins with the itemset table (at most 175 / min_support rows, so
    AQE broadcasts it)."""
    # The itemset table is read three times (splits, antecedent and consequent
    # supports) and Catalyst pushes a different filter into each read, so no
    # exchange is shared; it is small (<= 175 / min_support rows): keep it once.
    itemsets = materialize(itemsets)
    multi = itemsets.filter(F.col("size") >= 2)
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("size")).cast("int") - 2)
    splits = multi.select("itemset", "support", F.explode(masks).alias("mask"))
    pick = lambda keep: F.filter(
        F.col("itemset"), lambda x, i: ((F.col("mask") / F.pow(F.lit(2), i)).cast("int") % 2 == 1) == F.lit(keep))
    splits = splits.select(pick(True).alias("antecedents"), pick(False).alias("consequents"), "support")
    sup = itemsets.select("itemset", "support")
    a = sup.withColumnRenamed("itemset", "antecedents").withColumnRenamed("support", "antecedent_support")
    c = sup.withColumnRenamed("itemset", "consequents").withColumnRenamed("support", "consequent_support")
    rules = splits.join(a, "antecedents").join(c, "consequents")
    rules = rules.withColumn("confidence", F.col("support") / F.col("antecedent_support"))
    rules = rules.withColumn("lift", F.col("confidence") / F.col("consequent_support"))
    return (rules.filter(F.col("lift") >= F.lit(float(min_lift)))
            .select("antecedents", "consequents", "antecedent_support", "consequent_support",
                    "support", "confidence", "lift"))


def outcome_rules(rules: DataFrame, outcome: str) -> DataFrame:
    """M5/M6: rules whose consequent contains ``outcome``; both sides as
    sorted comma-joined text; lift descending (ties broken by the text)."""
    return (rules.filter(F.array_contains("consequents", F.lit(outcome)))
            .select(F.array_join(F.array_sort("antecedents"), ", ").alias("antecedents"),
                    F.array_join(F.array_sort("consequents"), ", ").alias("consequents"),
                    "support", "confidence", "lift")
            .orderBy(F.desc("lift"), "antecedents", "consequents"))


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """M7: the ``n`` strongest rules by lift (a top-k report: the limit is the feature)."""
    return rules.orderBy(F.desc("lift"), "antecedents", "consequents").limit(n)


def plot_order(rules: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` strongest rules with ``position`` 1 for the weakest of them, as a horizontal bar
    chart draws them from the bottom up."""
    weakest = Window.orderBy("lift", F.desc("antecedents"), F.desc("consequents"))  # over n rows
    return top_rules(rules, n).withColumn("position", F.row_number().over(weakest)).orderBy("position")


def rules_for_outcomes(df: DataFrame, outcome: str, min_support: float = 0.004, max_len: int = 3,
                       min_lift: float = 1.0, method: str = "expand") -> DataFrame:
    """M1 -> M5 end to end for one outcome flag."""
    fs = frequent_itemsets(order_items(df), min_support, max_len, method=method)
    return outcome_rules(association_rules(fs, min_lift), outcome)
