"""A chronological baseline: multinomial logistic regression on the product's features, and class metrics."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_by_time(df: DataFrame, time: str, train_share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Earlier rows train, later rows test; rows of one moment stay together."""
    cut = df.select(F.percentile(F.unix_micros(F.col(time).cast("timestamp")), train_share).alias("c")).first()["c"]
    at = F.unix_micros(F.col(time).cast("timestamp"))
    return df.where(at <= cut), df.where(at > cut)


#: Hours after kick-off when a result counts as known.
KNOWN_AFTER = 3
CLASSES = ("AWAY_WIN", "DRAW", "HOME_WIN")


def chronological_split(df: DataFrame, label: str, train_before: datetime, test_before: datetime, now: datetime, time: str = "utc_kickoff", key: str = "match_id", history: Sequence[str] = ("audit_home_history_last_available_at", "audit_away_history_last_available_at"), classes: Sequence[str] = CLASSES) -> tuple[DataFrame, DataFrame]:
    """Matches whose result was known before train_before, and known ones that began from then to test_before.

    A match of the last hours before the cut is in neither. Naive moments are UTC. Refused (ValueError): cuts in
    the wrong order, a repeated key, history that wasn't known before kick-off, an empty part, a class that no
    training row has. One aggregation decides on all but the repeated keys.
    """
    start, end, until = (F.lit(m.isoformat()).cast("timestamp") for m in (train_before, test_before, now))
    if train_before >= test_before:
        raise ValueError("train_before must be earlier than test_before")
    at = F.col(time).cast("timestamp")
    known = at + F.expr(f"INTERVAL {KNOWN_AFTER} HOURS")
    completed = F.col(label).isin(*classes) & (known < until)
    train, test = F.coalesce(completed & (known < start), F.lit(False)), F.coalesce(completed & (at >= start) & (at < end), F.lit(False))
    leak = F.lit(False)
    for c in history:
        leak = leak | F.coalesce(F.col(c).cast("timestamp") >= at, F.lit(False))
    told = df.agg(F.count_if(leak).alias("leaks"), F.count_if(test).alias("tests"), F.collect_set(F.when(train, F.col(label))).alias("classes")).first()
    if told["leaks"]:
        raise ValueError("history that was not known before kick-off")
    if not told["classes"] or not told["tests"]:
        raise ValueError("both periods need completed matches")
    if set(told["classes"]) != set(classes):
        raise ValueError("the training period must have every class")
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError("a key is repeated")
    return df.where(train), df.where(test)


def save_experiment(folder: str, model: PipelineModel, predictions: DataFrame, metrics: DataFrame) -> None:
    """folder/model, folder/predictions (CSV with a header), folder/metrics (JSON). A folder that exists is refused.

    Predictions' maps become one column for each class, so that CSV can hold them.
    """
    spark = predictions.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileExistsError(folder)
    names = model.stages[0].labels
    flat = [c for c in predictions.columns if c != "probabilities"]
    predictions.select(*flat, *[F.col("probabilities")[n].alias(f"prob_{n.lower()}") for n in names]).write.option("header", True).csv(f"{folder}/predictions")
    model.write().save(f"{folder}/model")
    metrics.coalesce(1).write.json(f"{folder}/metrics")


def fit(train: DataFrame, label: str, numeric: Sequence[str], categories: Sequence[str] = ()) -> PipelineModel:
    """Median-imputed, standardised features; unseen categories are all zero; strength of one over the rows."""
    typed = train.where(F.col(label).isNotNull())
    n = max(1, typed.count())
    stages = [
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        Imputer(inputCols=list(numeric), outputCols=[f"_i_{c}" for c in numeric], strategy="median"),
        VectorAssembler(inputCols=[f"_i_{c}" for c in numeric], outputCol="_numbers"),
        StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
    ]
    inputs = ["_scaled"]
    if categories:
        stages.append(StringIndexer(inputCols=list(categories), outputCols=[f"_x_{c}" for c in categories], handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"_x_{c}" for c in categories], outputCols=[f"_h_{c}" for c in categories], handleInvalid="keep", dropLast=True))
        inputs += [f"_h_{c}" for c in categories]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features"))
    stages.append(LogisticRegression(labelCol="_label", featuresCol="_features", probabilityCol="_p", predictionCol="_y", rawPredictionCol="_raw", family="multinomial", regParam=1.0 / n, standardization=False, maxIter=200))
    return Pipeline(stages=stages).fit(as_numbers(typed, numeric))


def as_numbers(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def predict(model: PipelineModel, df: DataFrame, label: str, numeric: Sequence[str]) -> DataFrame:
    """df's labelled rows with `label` and `probabilities`, a map from class to probability."""
    names = model.stages[0].labels
    out = PipelineModel(model.stages[1:]).transform(as_numbers(df.where(F.col(label).isNotNull()), numeric))
    return out.select(F.col(label).alias("label"), F.map_from_arrays(F.array(*map(F.lit, names)), vector_to_array("_p")).alias("probabilities"))


def prior(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """The training shares of the classes as everybody's prediction."""
    shares = train.where(F.col(label).isNotNull()).groupBy(label).count()
    one = shares.agg(F.map_from_entries(F.collect_list(F.struct(F.col(label), F.col("count") / F.lit(shares.agg(F.sum("count")).first()[0])))).alias("probabilities"))
    return test.where(F.col(label).isNotNull()).select(F.col(label).alias("label")).join(F.broadcast(one))


def class_metrics(scored: DataFrame) -> DataFrame:
    """n, accuracy, macro_f1, log_loss and brier (summed over classes) of label and probabilities, in one row."""
    best = F.aggregate(F.map_entries("probabilities"), F.struct(F.lit("").alias("key"), F.lit(-1.0).alias("value")), lambda a, e: F.when((e["value"] > a["value"]) | ((e["value"] == a["value"]) & (e["key"] > a["key"])), F.struct(e["key"].alias("key"), e["value"].alias("value"))).otherwise(a))
    own = F.greatest(F.coalesce(F.try_element_at("probabilities", F.col("label")), F.lit(0.0)), F.lit(1e-15))
    square = F.aggregate(F.map_entries("probabilities"), F.lit(0.0), lambda s, e: s + F.pow(e["value"] - F.when(e["key"] == F.col("label"), 1.0).otherwise(0.0), 2))
    rows = scored.select("label", best["key"].alias("guess"), F.log(own).alias("ll"), square.alias("sq"))
    total = rows.agg(F.count("*").alias("n"), F.round(F.avg((F.col("guess") == F.col("label")).cast("int")), 6).alias("accuracy"), F.round(F.avg("sq"), 6).alias("brier"), F.round(-F.avg("ll"), 6).alias("log_loss"))
    return total.join(F.broadcast(macro_f1(rows)))


def confusion(rows: DataFrame) -> DataFrame:
    return rows.groupBy("label", "guess").agg(F.count("*").alias("n"))


def macro_f1(rows: DataFrame) -> DataFrame:
    """Mean over the classes that occur as label or guess; a class without a hit has 0."""
    hits = confusion(rows)
    side = lambda c, name: hits.groupBy(F.col(c).alias("class")).agg(F.sum("n").alias(name))
    both = side("label", "real").join(side("guess", "said"), "class", "full").join(hits.where("label = guess").select(F.col("label").alias("class"), F.col("n").alias("hit")), "class", "left")
    f1 = 2 * F.coalesce("hit", F.lit(0)) / (F.coalesce("real", F.lit(0)) + F.coalesce("said", F.lit(0)))
    return both.agg(F.round(F.avg(f1), 6).alias("macro_f1"))
