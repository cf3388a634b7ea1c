"""Spark ML models over the feature tables: segments, churn, ratings, search terms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewtide.operators.features import RFM
from viewtide.operators.products import best_items
from viewtide.session import discard, freed_shuffles, materialise, release, scratch_path, shared_dir

CHURN_NUMBERS = (
    "sessions", "watch_minutes", "avg_progress", "completed_sessions", "days_since_last",
    "monthly_spend",
)
CHURN_CATEGORIES = ("country", "subscription_plan")


def _scaled(columns: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True),
    ]


def segment_model(features: DataFrame, k: int = 4, columns: Sequence[str] = RFM, seed: int = 42) -> PipelineModel:
    """K-means over standardised features of the users that have sessions."""
    fit_on = features.filter("has_sessions") if "has_sessions" in features.columns else features
    stages = [*_scaled(columns), KMeans(k=k, seed=seed, predictionCol="segment")]
    return Pipeline(stages=stages).fit(fit_on)


def with_segments(model: PipelineModel, features: DataFrame) -> DataFrame:
    """All users with their ``segment``; NULL for those without sessions, who are given none."""
    if "has_sessions" not in features.columns:
        return model.transform(features).drop("raw_features", "features")
    found = model.transform(features.filter("has_sessions")).drop("raw_features", "features")
    rest = features.filter("NOT has_sessions").withColumn("segment", F.lit(None).cast("int"))
    return found.unionByName(rest)


def user_segments(
    features: DataFrame, k: int = 4, columns: Sequence[str] = RFM, seed: int = 42
) -> DataFrame:
    """Users with their K-means ``segment`` over standardised features."""
    return with_segments(segment_model(features, k, columns, seed), features)


def nearest_centre(model: PipelineModel, columns: Sequence[str] = RFM) -> Column:
    """The centre closest to a row's features, worked out from the model's numbers."""
    scaler, centres = model.stages[-2], model.stages[-1].clusterCenters()
    scaled = [(F.col(c) - F.lit(float(m))) / F.lit(float(s) or 1.0) for c, m, s in zip(columns, scaler.mean, scaler.std)]
    distances = [
        F.struct(sum((x - F.lit(float(v))) ** 2 for x, v in zip(scaled, centre)).alias("d"), F.lit(k).alias("k"))
        for k, centre in enumerate(centres)
    ]
    return F.array_min(F.array(*distances))["k"]


def churn_model(
    features: DataFrame,
    numbers: Sequence[str] = CHURN_NUMBERS,
    categories: Sequence[str] = CHURN_CATEGORIES,
    label: str = "churned",
    forest: bool = False,
    trees: int = 20,
    bins: int = 32,
) -> PipelineModel:
    """Logistic regression or a random forest over user features.

    Each value of a category is an input of its own, so no order is read into them.
    Categories must be few: their distinct values are indexed on the driver. ``trees``
    and ``bins`` shape a forest. Rows without a label teach nothing.
    """
    features = features.filter(F.col(label).isNotNull())
    indexed = [f"{c}_index" for c in categories]
    encoded = [f"{c}_value" for c in categories]
    stages = []
    if categories:
        stages += [
            StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
        ]
    stages += _scaled([*numbers, *encoded])
    if forest:
        stages.append(RandomForestClassifier(labelCol=label, numTrees=trees, seed=42, maxBins=bins))
    else:
        stages.append(LogisticRegression(labelCol=label, regParam=0.01))
    return Pipeline(stages=stages).fit(features)


def churn_scores(model: PipelineModel, features: DataFrame, label: str = "churned") -> DataFrame:
    """``user_id``, its label and the modelled probability of churn; NULL where it was never seen."""
    risk = vector_to_array("probability")[1]
    if "seen_before" not in features.columns:
        return model.transform(features).select("user_id", label, risk.alias("churn_probability"))
    found = model.transform(features.filter("seen_before")).select("user_id", label, risk.alias("churn_probability"))
    none = F.lit(None).cast("double").alias("churn_probability")
    return found.unionByName(features.filter("NOT seen_before").select("user_id", label, none))


def churn_quality(scored: DataFrame, base_rate: float, label: str = "churned") -> tuple[float, float]:
    """Mean log loss of the modelled probabilities, and of the constant ``base_rate``."""

    def loss(chance: Column) -> Column:
        sure = F.least(F.greatest(chance, F.lit(1e-9)), F.lit(1 - 1e-9))
        return F.avg(-F.log(F.when(F.col(label) == 1, sure).otherwise(1 - sure)))

    row = scored.agg(loss(F.col("churn_probability")).alias("own"), loss(F.lit(base_rate)).alias("base")).first()
    return row["own"], row["base"]


def dense_ids(values: DataFrame, column: str, into: str) -> DataFrame:
    """The distinct values of a column, numbered 0, 1, ... without a gap; NULL is none.

    Values are sorted in ranges, each numbered on its own, and a range starts after the rows
    of those before it: one row per range is gathered, never the values.
    """
    single = values.select(column).filter(F.col(column).isNotNull()).distinct()
    placed = (
        single.repartitionByRange(column)
        .sortWithinPartitions(column)
        .withColumn("__part", F.spark_partition_id())
        # The lower 33 bits of the generated id count the rows of a partition.
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    )
    placed = materialise(placed, "ids")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = offsets.select("__part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__offset"))
    numbered = placed.join(F.broadcast(offsets), "__part")
    # A factorisation holds ids as ints; more values are an error rather than wrong ids.
    number = F.col("__offset") + F.col("__row")
    checked = F.when(number < (1 << 31) - 1, number.cast("int")).otherwise(
        F.raise_error(F.lit(f"more values of {column} than an int numbers"))
    )
    return numbered.select(column, checked.alias(into))


@dataclass(frozen=True)
class RatingModel:
    """A factorisation, and the numbers that stand for ids of any type."""

    factors: ALSModel
    users: DataFrame
    items: DataFrame
    mean: float

    def _of(self, side: str) -> DataFrame:
        """The factors of the users or items, under their own ids; NULL where they have none."""
        named, number, found = {
            "user": (self.users, "__user", self.factors.userFactors),
            "item": (self.items, "__item", self.factors.itemFactors),
        }[side]
        found = found.select(F.col("id").alias(number), F.col("features").alias(f"__of_{side}"))
        return named.join(found, number, "left").drop(number)


def rating_model(ratings: DataFrame, rank: int = 10, iterations: int = 10, reg: float = 0.1) -> RatingModel:
    """Matrix factorisation of ``user_id``, ``movie_id``, ``user_rating``.

    Ids are of any type that can be sorted. What is factorised is the distance from the mean
    rating. Long lineages are cut in the shared checkpoint folder, and every step's shuffle files
    go before the next: an iteration's exchanges of factors are removed at its checkpoint, and
    the factors are read back from a table.
    """
    spark = ratings.sparkSession
    shared_dir(spark)
    rated = ratings.filter("user_rating IS NOT NULL AND user_id IS NOT NULL AND movie_id IS NOT NULL")
    table, stored = scratch_path(spark, "rated"), scratch_path(spark, "factors")
    with freed_shuffles(spark):
        users = materialise(dense_ids(rated, "user_id", "__user"), "users")
        items = materialise(dense_ids(rated, "movie_id", "__item"), "items")
        mean = rated.agg(F.avg("user_rating")).first()[0] or 0.0
        numbered = rated.join(users, "user_id").join(items, "movie_id")
        numbered = numbered.select("__user", "__item", (F.col("user_rating") - mean).alias("__over"))
        numbered.write.parquet(table)
    als = ALS(
        userCol="__user",
        itemCol="__item",
        ratingCol="__over",
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        checkpointInterval=1,
        coldStartStrategy="nan",
        seed=42,
    )
    als.fit(spark.read.schema(numbered.schema).parquet(table)).save(stored)
    discard(spark, table)
    release(spark)
    return RatingModel(ALSModel.load(stored), users, items, mean)


def predicted_ratings(model: RatingModel, pairs: DataFrame) -> DataFrame:
    """All given pairs with a prediction; NULL for unseen users or items.

    Ids meet their factors first, so that the pairs, known and unknown, go through two joins.
    """
    found = pairs.join(model._of("user"), "user_id", "left").join(model._of("item"), "movie_id", "left")
    # The sum of products in single precision and in order, as the factorisation's own prediction.
    products = [F.get("__of_user", k) * F.get("__of_item", k) for k in range(model.factors.rank)]
    prediction = sum(products, F.lit(0.0).cast("float"))
    over = F.when(~F.isnan(prediction), prediction.cast("double") + model.mean)
    return found.select(*pairs.columns, over.alias("predicted_rating"))


def recommendations(model: RatingModel, n: int = 10) -> DataFrame:
    """The ``n`` items with the highest prediction for each known user, under their own ids.

    Bounds by cells of similar users leave out most pairs, and no item of a list. The lists are
    written, so that nothing that reads them multiplies again.
    """
    factors = model.factors
    with freed_shuffles(factors.userFactors.sparkSession):
        best = materialise(best_items(factors.userFactors, factors.itemFactors, factors.rank, n), "recommended")
    ranked = best.select(F.col("user").alias("__user"), F.posexplode("best").alias("__at", "__of")).select(
        "__user",
        (F.col("__at") + 1).alias("position"),
        F.col("__of.item").alias("__item"),
        (F.col("__of.rating").cast("double") + model.mean).alias("predicted_rating"),
    )
    named = ranked.join(model.users, "__user").join(model.items, "__item")
    return named.select("user_id", "position", "movie_id", "predicted_rating")


def rating_errors(predicted: DataFrame, mean: float) -> tuple[float, float]:
    """Root mean square error of the predictions, and of the constant ``mean`` on the same rows."""
    known = predicted.filter("predicted_rating IS NOT NULL AND user_rating IS NOT NULL")
    own = F.sqrt(F.avg((F.col("predicted_rating") - F.col("user_rating")) ** 2))
    constant = F.sqrt(F.avg((F.lit(mean) - F.col("user_rating")) ** 2))
    row = known.agg(own.alias("own"), constant.alias("constant")).first()
    return row["own"], row["constant"]


def search_terms(queries: DataFrame, keys: Sequence[str], text: str = "query") -> DataFrame:
    """Rows (*keys, ``term``, ``uses``, ``weight``): exact TF-IDF of every word of every query.

    Words are runs of letters and digits in lower case. The weight is the uses times
    ``ln((n + 1) / (queries with the word + 1))`` with n all queries, wordless ones included;
    such a query has no row here. Counting and weighing are groupings and a join on the word,
    so no vocabulary is gathered, and words never share a weight.
    """
    n = queries.select(*keys).distinct().count()
    words = F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    uses = (
        queries.select(*keys, words.alias("term"))
        .filter("term <> ''")
        .groupBy(*keys, "term")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    known = uses.groupBy("term").agg(F.count(F.lit(1)).alias("queries"))
    weight = F.col("uses") * F.log(F.lit(n + 1.0) / (F.col("queries") + 1))
    return uses.join(known, "term").select(*keys, "term", "uses", weight.alias("weight"))
