"""Label prediction, thresholds and calibration (survey E9, I1-I18, H60, H61)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.functions.blocks import running
from assayloom.functions.stats import avg_rank, with_scalars


def hash_ranked(rows: DataFrame, key: str, label: str, seed: int, name: str) -> DataFrame:
    """`rows` with their place, from 0, within their class in a hash order of the key (rows of equal keys by the key).

    The hash's range is cut into 256 parts; a part of a class is ranked by itself and goes on from the parts before it, so
    no task sees a whole class.
    """
    hashed = rows.withColumn("_h", F.xxhash64(key, F.lit(seed))).withColumn("_part", F.shiftright("_h", 56))
    sizes = hashed.groupBy(F.col(label).alias("_l"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_l").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_l", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(label, "_part").orderBy("_h", key))
    placed = hashed.withColumn("_own", own).join(F.broadcast(offsets), (F.col("_part") == F.col("_p")) & F.col(label).eqNullSafe(F.col("_l")))
    return placed.withColumn(name, F.col("_before") + F.col("_own") - 1).drop("_h", "_part", "_l", "_p", "_before", "_own")


def stratified_folds(rows: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """`rows` with fold 1..k, dealt within each class in a hash order of the key."""
    return hash_ranked(rows, key, label, seed, "_place").withColumn("fold", F.col("_place") % k + 1).drop("_place")


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """label, weight: half the inverse share of each class."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    return with_scalars(counts, counts.agg(F.sum("n").alias("_t"))).select(label, (0.5 * F.col("_t") / F.col("n")).alias("weight"))


def confusion_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """threshold, tp, fp, fn, tn at every distinct score, rows with score >= threshold being positive."""
    return _curve(scored, score, label).drop("_p", "_n")


def _curve(scored: DataFrame, score: str, label: str) -> DataFrame:
    """`confusion_curve` with _p and _n, the positives and negatives of exactly that score."""
    steps = scored.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    total = steps.agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn"))
    out = with_scalars(running(steps, "threshold", "_p", "_n", descending=True), total)
    tp, fp = F.col("run__p"), F.col("run__n")
    return out.select("threshold", tp.alias("tp"), fp.alias("fp"), (F.col("_tp") - tp).alias("fn"), (F.col("_tn") - fp).alias("tn"), "_p", "_n")


def precision_recall(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """threshold, precision, recall by descending score."""
    c = confusion_curve(scored, score, label)
    return c.select("threshold", F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"), F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"))


def pr_auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """pr_auc: the area under precision by recall; between two thresholds false positives grow in proportion to true ones,
    so the area of a step has a closed form."""
    steps = _curve(scored, score, label).withColumns({"_t": F.col("tp") - F.col("_p"), "_f": F.col("fp") - F.col("_n")}).filter(F.col("_p") > 0)
    rise = 1 + (F.col("fp") - F.col("_f")) / (F.col("tp") - F.col("_t"))
    start = F.col("_f") - (rise - 1) * F.col("_t")
    bend = F.when(F.col("_t") + F.col("_f") > 0, start / (rise * rise) * F.ln((F.col("tp") + F.col("fp")) / (F.col("_t") + F.col("_f")))).otherwise(0.0)
    area = (F.col("tp") - F.col("_t")) / rise - bend
    return steps.agg((F.sum(area) / F.max(F.col("tp") + F.col("fn"))).alias("pr_auc"))


def youden(scored: DataFrame, score: str = "score", label: str = "label", step: float = 0.01) -> DataFrame:
    """The threshold, from a grid 0.05 to 0.95 and the scores themselves, with the largest J; ties by F1, then the least."""
    spark = scored.sparkSession
    n = round(0.9 / step)
    grid = spark.range(n + 1).select(F.round(F.lit(0.05) + F.col("id") * step, 4).alias("threshold"))
    cells = scored.groupBy(F.col(score).alias("threshold")).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n"))
    # scores and thresholds on one line: what stands at or above a threshold is a running sum
    line = cells.unionByName(grid.withColumns({"_p": F.lit(0).cast("long"), "_n": F.lit(0).cast("long")})).groupBy("threshold").agg(F.sum("_p").alias("_p"), F.sum("_n").alias("_n"))
    total = cells.agg(F.sum("_p").alias("_tp"), F.sum("_n").alias("_tn"))
    at = with_scalars(running(line, "threshold", "_p", "_n", descending=True).withColumnsRenamed({"run__p": "tp", "run__n": "fp"}), total)
    j = F.try_divide("tp", "_tp") + 1 - F.try_divide("fp", "_tn") - 1
    f1 = F.try_divide(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("_tp"))
    return at.select("threshold", F.round(j, 12).alias("j"), F.round(f1, 12).alias("f1")).orderBy(F.desc_nulls_last("j"), F.desc_nulls_last("f1"), "threshold").limit(1)


def calibration(scored: DataFrame, score: str = "score", label: str = "label", bins: int = 10) -> DataFrame:
    """ece over equal bins (the last closed) and brier."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1))
    per = scored.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("p"), F.avg(F.col(label).cast("double")).alias("y"), F.sum((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("_sq"))
    return per.agg((F.sum(F.col("n") * F.abs(F.col("p") - F.col("y"))) / F.sum("n")).alias("ece"), (F.sum("_sq") / F.sum("n")).alias("brier"))


def separation(scored: DataFrame, score: str = "score", label: str = "label", gap: float = 0.3, overlap: float = 0.5) -> DataFrame:
    """mean_gap, overlap (share of scores between the classes' extremes), needs_calibration."""
    one, zero = F.when(F.col(label) == 1, F.col(score)), F.when(F.col(label) == 0, F.col(score))
    s = scored.agg(F.avg(one).alias("_m1"), F.avg(zero).alias("_m0"), F.min(one).alias("_low"), F.max(zero).alias("_high"))
    out = with_scalars(scored, s).agg(F.abs(F.first("_m1") - F.first("_m0")).alias("mean_gap"), F.avg(F.col(score).between(F.col("_low"), F.col("_high")).cast("int")).alias("overlap"))
    return out.withColumn("needs_calibration", (F.col("mean_gap") < gap) | (F.col("overlap") > overlap))


def mismatch(rows: DataFrame, p: str, label: str, threshold: float, mode: str = "all") -> DataFrame:
    """strict: the 0.5 label differs from the recorded one (1 = predicted positive); by_threshold: a negative at or over
    the threshold or a positive under it; outlier: what `mode` (all or strict_only) takes."""
    strict = (F.col(p) >= 0.5).cast("int") != F.col(label)
    by_threshold = F.when(F.col(label) == 0, F.col(p) >= threshold).otherwise(F.col(p) < threshold)
    out = rows.withColumns({"strict_mismatch": strict, "threshold_mismatch": by_threshold})
    only = F.col("threshold_mismatch") & ~F.col("strict_mismatch")
    return out.withColumn("outlier", F.col("strict_mismatch") if mode == "strict_only" else F.col("strict_mismatch") | only)


def feature_ranking(long: DataFrame, label: str, top: int) -> DataFrame:
    """feature, mean_rank: average of the ranks by |t|, |Cohen's d|, |r| with the label and variance; the best `top`."""
    a, b = F.when(F.col(label) == 1, F.col("value")), F.when(F.col(label) == 0, F.col("value"))
    n1, n0, v1, v0 = F.count(a), F.count(b), F.var_samp(a), F.var_samp(b)
    gap = F.avg(a) - F.avg(b)
    agg = long.groupBy("feature").agg(
        F.abs(F.try_divide(gap, F.sqrt(v1 / n1 + v0 / n0))).alias("t"),
        F.abs(F.try_divide(gap, F.sqrt(((n1 - 1) * v1 + (n0 - 1) * v0) / F.greatest(F.lit(1), n1 + n0 - 2)))).alias("d"),
        F.abs(F.corr("value", F.col(label).cast("double"))).alias("r"),
        F.var_samp("value").alias("v"),
    )
    m = F.count("*").over(Window.partitionBy())  # one row a feature
    ranks = [m + 1 - avg_rank(c) for c in ("t", "d", "r", "v")]
    return agg.select("feature", ((ranks[0] + ranks[1] + ranks[2] + ranks[3]) / 4).alias("mean_rank")).orderBy("mean_rank", "feature").limit(top)


def ordered_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in a hash order of the key: the same ones on every run."""
    return rows.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def inject_errors(people: DataFrame, per_category: int, seed: int = 42) -> DataFrame:
    """Ground truth of injected errors (sample, label 0/1) -> sample, category, source, new_label.

    In a hash order: the first `per_category` of each label trade measurements in a ring (category 1), the next flip
    their label (2), the next of one label trade with those of the other (3); the rest are clean.
    """
    r = F.col("_place") + 1
    placed = hash_ranked(people.select("sample", "label"), "sample", "label", seed, "_place")
    placed = placed.withColumn("category", F.when(r <= 3 * per_category, F.ceil(r / per_category).cast("int")).otherwise(0))
    traded = placed.filter("category > 0")  # a few by design; the clean rows are in no window
    ring = Window.partitionBy("label", "category").orderBy("_place")
    nxt = F.coalesce(F.lead("sample").over(ring), F.first("sample").over(ring))
    across = Window.partitionBy("category", F.col("_place") % per_category).orderBy("label").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.when(F.col("label") == F.min("label").over(across), F.last("sample").over(across)).otherwise(F.first("sample").over(across))
    source = F.when(F.col("category") == 1, nxt).when(F.col("category") == 3, other).otherwise(F.col("sample"))
    new = F.when(F.col("category") == 2, 1 - F.col("label")).otherwise(F.col("label"))
    wrong = traded.select("sample", "category", source.alias("source"), new.alias("new_label"))
    return wrong.unionByName(placed.filter("category = 0").select("sample", "category", F.col("sample").alias("source"), F.col("label").alias("new_label")))


def detection_metrics(truth: DataFrame, flagged: DataFrame) -> DataFrame:
    """category, n, detected, rate of injected errors; category 0 gives the false alarms."""
    hit = truth.join(flagged.select("sample").distinct().withColumn("_f", F.lit(1)), "sample", "left")
    return hit.groupBy("category").agg(F.count("*").alias("n"), F.count("_f").alias("detected"), (F.count("_f") / F.count("*")).alias("rate"))


def platt(scored: DataFrame, score: str = "score", label: str = "label", least: int = 10) -> DataFrame:
    """`scored` with calibrated: a logistic fit of the label on the score, kept only where it lowers both ECE and Brier."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=[score], outputCol="_x", handleInvalid="skip").transform(scored)
    if rows.limit(least).count() < least:
        return scored.withColumn("calibrated", F.col(score))
    model = LogisticRegression(featuresCol="_x", labelCol=label, regParam=0.0).fit(rows)
    fitted = scored.withColumn("calibrated", 1 / (1 + F.exp(-(F.col(score) * float(model.coefficients[0]) + float(model.intercept)))))
    before, after = calibration(scored, score, label).head(), calibration(fitted, "calibrated", label).head()
    return fitted if after["ece"] < before["ece"] and after["brier"] < before["brier"] else scored.withColumn("calibrated", F.col(score))


def wide_vectors(long: DataFrame, *keep: str) -> DataFrame:
    """sample, keep, features: the values of a sample in feature order as one vector; null where a sample lacks one."""
    from pyspark.ml.functions import array_to_vector

    rows = long.groupBy("sample", *keep).agg(F.transform(F.sort_array(F.collect_list(F.struct("feature", "value"))), lambda x: x["value"]).alias("_v"))
    return rows.select("sample", *keep, array_to_vector("_v").alias("features"))


def complete_vectors(long: DataFrame) -> DataFrame:
    """sample, features: every feature of the table in order, a missing value or absent row as the feature's median, 0 where
    it has none. The features with their medians are one row that goes to all tasks, a number or two a feature."""
    from pyspark.ml.functions import array_to_vector

    medians = long.groupBy("feature").agg(F.coalesce(F.median("value"), F.lit(0.0)).alias("m"))
    every = medians.agg(F.sort_array(F.collect_list(F.struct("feature", "m"))).alias("_f"))
    own = long.groupBy("sample").agg(F.map_from_entries(F.collect_list(F.struct("feature", "value"))).alias("_v"))
    filled = F.transform("_f", lambda f: F.coalesce(F.try_element_at("_v", f["feature"]), f["m"]))
    return with_scalars(own, every).select("sample", array_to_vector(filled).alias("features"))


def probability(c: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.get(vector_to_array(c), F.lit(1))


def elastic_net_cv(vectors: DataFrame, label: str, alphas: list[float], strengths: int | list[float] = 30, folds: int = 5, inner: int = 5, seed: int = 42) -> DataFrame:
    """sample, label, fold, score: out-of-fold probabilities of the model whose mean AUC over inner folds is best."""
    return elastic_net_folds(vectors, label, alphas, strengths, folds, inner, seed)[0]


def elastic_net_folds(vectors: DataFrame, label: str, alphas: list[float], strengths: int | list[float] = 30, folds: int = 5, inner: int = 5, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The scores of `elastic_net_cv`, and fold, at (place in the vector), weight of every outer fold's model."""
    from assayloom.operators.netpath import nested

    return nested(vectors, label, alphas, strengths, folds, inner, seed)[:2]


def top_features(fits: DataFrame, most: int = 20, least: int = 5) -> list:
    """The features of the `most` least p among the significant ones (feature, p, significant); none under `least`."""
    names = [r["feature"] for r in fits.filter("significant").orderBy("p", "feature").limit(most).collect()]
    return names if len(names) >= least else []


def top_predictor(long: DataFrame, people: DataFrame, label: str, names: list, covariates: tuple[str, ...] = ("age", "bmi", "smoking")) -> DataFrame:
    """sample, label, probability, predicted (1 from 0.5), mismatch of an unpenalised logistic model on some features and
    covariates, fitted to complete labelled rows. people: sample, label (0/1 or null), covariates. Samples with a gap have
    null predictions; without names there is no model, and all are null."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    from assayloom.operators.genetics import settled

    if not names:
        seen = people.select("sample", label).join(long.select("sample").distinct(), "sample", "left_semi")
        return seen.select("sample", label, F.lit(None).cast("double").alias("probability"), F.lit(None).cast("int").alias("predicted"), F.lit(False).alias("mismatch"))
    cells = long.select("sample", "feature", F.when(F.col("feature").isin(names), F.col("value")).alias("value"))
    values = F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("feature", "value"))))
    wide = cells.groupBy("sample").agg(F.transform(values, lambda x: x["value"]).alias("_v"))
    rows = people.select("sample", F.col(label).alias("_y"), *covariates).join(wide, "sample")
    ready = F.size("_v") == len(names)
    for c in covariates:
        ready = ready & F.col(c).isNotNull()
    whole = rows.filter(ready).select("sample", F.col("_y").alias(label), array_to_vector(F.concat("_v", F.array(*[F.col(c).cast("double") for c in covariates]).cast("array<double>"))).alias("features"))
    whole = settled(whole)  # the fit and the prediction read it several times
    rows = rows.select("sample", F.col("_y").alias(label))
    model = LogisticRegression(labelCol=label, regParam=0.0, maxIter=200, tol=1e-10).fit(whole.filter(F.col(label).isNotNull()))
    fitted = model.transform(whole).select("sample", probability("probability").alias("probability"))
    predicted = (F.col("probability") >= 0.5).cast("int")
    return rows.select("sample", label).join(fitted, "sample", "left").withColumns({"predicted": predicted, "mismatch": F.coalesce(predicted != F.col(label), F.lit(False))})


def label_accuracy(long: DataFrame, people: DataFrame, label: str, names: list, least_batch: int = 50, least: int = 100) -> DataFrame:
    """accuracy on its own rows of a logistic model of the label on the features `names`, over all batches together; null
    where a batch has under `least_batch` labelled samples or one class, or under `least` complete rows are left.
    people: sample, batch, label."""
    known = people.filter(F.col(label).isNotNull())
    named = F.col("feature").isin(names)
    full = long.groupBy("sample").agg(F.count_if(named & F.col("value").isNotNull()).alias("_n"))
    seen = known.join(full, "sample").withColumn("_f", F.when(F.col("_n") == len(names), True))
    per = seen.groupBy("batch").agg(F.count("*").alias("n"), F.count("_f").alias("whole"), F.count_distinct(F.when(F.col("_f"), F.col(label))).alias("classes"))
    facts = per.agg(F.min("n").alias("n"), F.min("classes").alias("classes"), F.sum("whole").alias("whole")).head()
    if facts["n"] is None or facts["n"] < least_batch or facts["classes"] < 2 or facts["whole"] < least:
        return long.sparkSession.createDataFrame([(None,)], "accuracy double")
    fitted = top_predictor(long.filter(named), known.select("sample", label), label, names, ())
    return fitted.filter("predicted IS NOT NULL").agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("accuracy"))


def model_zoo(vectors: DataFrame, label: str, folds: int = 5, trees: int = 300, boosts: int = 100, layers: tuple[int, ...] = (128, 64), seed: int = 42, at_once: int = 4) -> DataFrame:
    """sample, label, fold, model, score: every row scored by models that were fitted to the other folds, and their mean as
    "ensemble": elastic net, ridge, lasso, forest, boosted trees, perceptron. Vectors are standardised by each fold's
    training rows; rows weigh in by their class, where the kind of model takes weights."""
    from multiprocessing.pool import ThreadPool

    from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
    from pyspark.ml.feature import StandardScaler

    from assayloom.operators.genetics import settled

    known = vectors.filter(F.col(label).isNotNull())
    width = len(known.select("features").head()["features"])
    net = lambda a: LogisticRegression(labelCol=label, weightCol="_w", elasticNetParam=a, regParam=0.01, standardization=False)
    zoo = {
        "enet": net(0.5),
        "ridge": net(0.0),
        "lasso": net(1.0),
        "forest": RandomForestClassifier(labelCol=label, numTrees=trees, featureSubsetStrategy="sqrt", seed=seed),
        "boost": GBTClassifier(labelCol=label, weightCol="_w", maxDepth=4, maxIter=boosts, stepSize=0.05, subsamplingRate=0.7, minInstancesPerNode=5, seed=seed),
        "mlp": MultilayerPerceptronClassifier(labelCol=label, layers=[width, *layers, 2], maxIter=30, blockSize=64, seed=seed),
    }
    dealt = settled(stratified_folds(known, "sample", label, folds, seed))

    def out_of_fold(job: tuple[int, str]) -> DataFrame:
        fold, name = job
        train, held = sets[fold]
        return zoo[name].fit(train).transform(held).select("sample", label, F.lit(fold).alias("fold"), F.lit(name).alias("model"), probability("probability").alias("score"))

    sets = {}
    for fold in range(1, folds + 1):
        rest = dealt.filter(F.col("fold") != fold)
        scaler = StandardScaler(inputCol="features", outputCol="_z", withMean=True).fit(rest)
        scale = lambda df, scaler=scaler: scaler.transform(df).drop("features").withColumnRenamed("_z", "features")
        train = rest.join(F.broadcast(class_weights(rest, label).withColumnRenamed("weight", "_w")), label)
        sets[fold] = settled(scale(train)), scale(dealt.filter(F.col("fold") == fold))
    with ThreadPool(at_once) as pool:
        parts = pool.map(out_of_fold, [(fold, name) for fold in sets for name in zoo], chunksize=1)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = settled(out)
    mean = out.groupBy("sample", label, "fold").agg(F.avg("score").alias("score")).select("sample", label, "fold", F.lit("ensemble").alias("model"), "score")
    return out.unionByName(mean)


def mean_imputed(train: DataFrame, rows: DataFrame) -> DataFrame:
    """`rows` (feature, value) with missing values as the training rows' feature mean, 0 where there is none."""
    means = train.groupBy("feature").agg(F.avg("value").alias("_mean"))
    return rows.join(means, "feature", "left").withColumn("value", F.coalesce("value", "_mean", F.lit(0.0))).drop("_mean")


def standardised(train: DataFrame, rows: DataFrame) -> DataFrame:
    """`rows` centred and scaled by the training rows' feature mean and sd; an sd of 0 or none counts as 1."""
    facts = train.groupBy("feature").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    sd = F.when(F.coalesce(F.col("_s"), F.lit(0.0)) > 0, F.col("_s")).otherwise(1.0)
    return rows.join(facts, "feature").withColumn("value", (F.col("value") - F.col("_m")) / sd).drop("_m", "_s")


def lasso_features(vectors: DataFrame, label: str, names: list[str], strength: float) -> list[str]:
    """Names of the features that a lasso of the given strength leaves with a weight."""
    from pyspark.ml.classification import LogisticRegression

    weights = LogisticRegression(labelCol=label, elasticNetParam=1.0, regParam=strength).fit(vectors).coefficients.toArray()
    return [n for n, w in zip(names, weights, strict=True) if w]


def selection_frequency(chosen: DataFrame, cohorts: int, least: float = 0.5) -> DataFrame:
    """feature, n, frequency of features that at least that share of the cohorts chose; rows are (cohort, feature)."""
    out = chosen.distinct().groupBy("feature").agg(F.count("*").alias("n")).withColumn("frequency", F.col("n") / cohorts)
    return out.filter(F.col("frequency") >= least)


def best_model(scores: DataFrame, main: str) -> str:
    """The model of the largest AUC in (model, label, score); ties go to `main`, then by name."""
    from assayloom.operators.association import rank_sum

    names = [r[0] for r in scores.select("model").distinct().collect()]  # a handful
    auc = {n: rank_sum(scores.filter(F.col("model") == n).withColumn("label", F.col("label") == 1), "score", "label").head()["auc"] for n in names}
    return max(sorted(auc), key=lambda n: (auc[n], n == main))


def evidence(p: Column) -> tuple[Column, Column]:
    """How sure a probability is, from 0 to 1, and whether that is high."""
    sure = F.abs(p - 0.5) * 2
    return sure, sure > 0.95


def trained_k(scored: DataFrame, value: str, label: str) -> DataFrame:
    """k, k_mad: how many sd (or MADs) over the clean rows' centre the best cut by Youden's J lies."""
    cut = youden(scored, value, label).select(F.col("threshold").alias("_c"))
    clean = scored.filter(F.col(label) == 0)
    from assayloom.functions.stats import center_and_mad

    facts = clean.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"))
    out = with_scalars(with_scalars(cut, facts), center_and_mad(clean, value))
    return out.select(F.try_divide(F.col("_c") - F.col("_m"), "_s").alias("k"), F.try_divide(F.col("_c") - F.col("median"), "mad").alias("k_mad"))


def model_importance(vectors: DataFrame, label: str, kind: str, top: int = 20, trees: int = 300, seed: int = 42) -> DataFrame:
    """feature (place in the vector), weight, size of a model of all rows, the `top` largest: of an elastic net ("enet", "ridge",
    "lasso") its coefficients, of a "forest" or "boost" the share of the splits' gain."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier

    from assayloom.operators.netpath import one_error

    mixing = {"enet": 0.5, "ridge": 0.0, "lasso": 1.0}
    if kind in mixing:
        found = one_error(vectors, label, mixing[kind], seed=seed)[1]
    else:
        models = {"forest": lambda: RandomForestClassifier(labelCol=label, numTrees=trees, featureSubsetStrategy="sqrt", seed=seed), "boost": lambda: GBTClassifier(labelCol=label, maxDepth=4, maxIter=100, stepSize=0.05, subsamplingRate=0.7, seed=seed)}
        if kind not in models:
            raise ValueError(f"no importances for {kind}; there are {', '.join([*mixing, *models])}")
        found = models[kind]().fit(vectors.filter(F.col(label).isNotNull())).featureImportances.toArray()
    return importance(vectors.sparkSession.createDataFrame([(i, float(w)) for i, w in enumerate(found)], "feature int, weight double"), top)


def importance(weights: DataFrame, top: int = 20) -> DataFrame:
    """The `top` rows of (feature, weight) by size."""
    return weights.withColumn("size", F.abs("weight")).orderBy(F.desc("size"), "feature").limit(top)
