"""Who a sample is: mapping, classes, covariates, batch unions (survey B10-B15, C, E4, F5, J3-J7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayloom.sources.tables import to_bool


def sample_mapping(samples: DataFrame, meta: DataFrame, bridges: DataFrame | None = None) -> DataFrame:
    """sample, person, has_metadata, sample_type: Control, Bridging, Person or Unknown. meta: sample, person."""
    out = samples.select("sample").distinct().join(meta.select("sample", "person", F.lit(True).alias("_m")), "sample", "left")
    if bridges is not None:
        out = out.join(bridges.select("person", F.lit(True).alias("_b")).distinct(), "person", "left")
    else:
        out = out.withColumn("_b", F.lit(None).cast("boolean"))
    control = F.col("sample").cast("string").rlike("(?i)control")
    kind = F.when(control, "Control").when(F.col("_b"), "Bridging").when(F.col("person").isNotNull(), "Person").otherwise("Unknown")
    return out.select("sample", "person", F.coalesce("_m", F.lit(False)).alias("has_metadata"), kind.alias("sample_type"))


def repeated_people(mapping: DataFrame) -> DataFrame:
    """person, n of people with more than one sample."""
    return mapping.filter("person IS NOT NULL").groupBy("person").agg(F.count("*").alias("n")).filter("n > 1")


def first_sample_per_person(mapping: DataFrame) -> DataFrame:
    """person, sample: the least sample id."""
    return mapping.filter("person IS NOT NULL").groupBy("person").agg(F.min("sample").alias("sample"))


def replicate_pairs(mapping: DataFrame) -> DataFrame:
    """person, first, second: the first two samples of everyone who has two."""
    r = F.row_number().over(Window.partitionBy("person").orderBy("sample"))
    firsts = mapping.filter("person IS NOT NULL").withColumn("_r", r).filter("_r <= 2")
    return firsts.groupBy("person").agg(F.max(F.when(F.col("_r") == 1, F.col("sample"))).alias("first"), F.max(F.when(F.col("_r") == 2, F.col("sample"))).alias("second")).filter("second IS NOT NULL")


def add_person(df: DataFrame, mapping: DataFrame) -> DataFrame:
    return df.join(mapping.select("sample", "person"), "sample", "left")


def rekey(long: DataFrame, mapping: DataFrame, excluded: DataFrame) -> DataFrame:
    """person, feature, value: excluded samples go, the others take their person's id; samples without one go."""
    kept = long.join(excluded.select("sample").distinct(), "sample", "left_anti")
    return kept.join(mapping.filter("person IS NOT NULL").select("sample", "person"), "sample").select("person", "feature", "value")


def batch_union(newer: DataFrame, older: DataFrame, least_features: int = 100) -> DataFrame:
    """Both batches on their common features; people in both keep the newer batch's rows."""
    common = newer.select("feature").distinct().intersect(older.select("feature").distinct())
    if (n := common.count()) < least_features:
        raise ValueError(f"{n} common features; {least_features} are needed")
    rest = older.join(newer.select("person").distinct(), "person", "left_anti")
    return newer.unionByName(rest).join(F.broadcast(common) if n <= 100_000 else common, "feature", "left_semi")


def sex_code(c: Column) -> Column:
    """0/1, male/female in any spelling -> 1/2; anything else null."""
    s = F.lower(F.trim(c.cast("string")))
    return F.when(s.isin("0", "male", "m"), 1).when(s.isin("1", "female", "f"), 2)


def covariates(samples: DataFrame, main: DataFrame, supplement: DataFrame | None = None, young: float = 20.0) -> DataFrame:
    """`samples` (person, collected) with age at collection (or the baseline age), sex, whether complete and young.

    main and supplement: person, sex, birth, baseline_age; the supplement stands in for people main lacks.
    """
    columns = ["person", "sex", "birth", "baseline_age"]
    known = main.select(*columns)
    if supplement is not None:
        known = known.unionByName(supplement.select(*columns).join(known.select("person"), "person", "left_anti"))
    out = samples.join(known, "person", "left")
    age = F.coalesce(F.datediff("collected", "birth") / 365.25, F.col("baseline_age"))
    out = out.withColumns({"age": age, "sex": sex_code(F.col("sex"))})
    return out.withColumns({"complete": F.col("age").isNotNull() & F.col("sex").isNotNull(), "young": F.coalesce(F.col("age") <= young, F.lit(False))}).drop("birth", "baseline_age")


def union_of_lists(*lists: DataFrame) -> DataFrame:
    """The distinct samples of several lists."""
    return reduce(lambda a, b: a.union(b), [x.select("sample") for x in lists]).distinct()


def cross_reference(flags: DataFrame, predictions: DataFrame) -> DataFrame:
    """Flagged samples with their label prediction; false where there is none."""
    return flags.join(predictions.select("sample", to_bool(F.col("mismatch")).alias("mismatch")), "sample", "left").fillna(False, ["mismatch"])


def stage_counts(stages: dict[str, DataFrame], column: str = "sample") -> DataFrame:
    """stage, n distinct samples."""
    rows = [df.agg(F.countDistinct(column).alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)


def coalesce_update(df: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nulls of `columns` filled from the other table's row of the same key."""
    new = other.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return df.join(new, key, "left").withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}).drop(*[f"_{c}" for c in columns])


def quintile(value: str) -> Column:
    """Q1..Q5 between exact quantiles, right-closed, ties together."""
    w = Window.partitionBy()
    cuts = F.percentile(value, F.array(*[F.lit(q) for q in (0.2, 0.4, 0.6, 0.8)])).over(w)
    over = F.size(F.filter(cuts, lambda c: F.col(value) > c))
    return F.when(F.col(value).isNotNull(), F.concat(F.lit("Q"), (over + 1).cast("string")))


def person_components(scores: DataFrame, people: DataFrame, flagged: DataFrame) -> DataFrame:
    """Every row of scores (a row a person) with the columns of the person's least sample in `people` (null: no sample) and
    is_outlier: whether any sample of the person is flagged."""
    rest = [c for c in people.columns if c not in ("person", "sample")]
    one = people.groupBy("person").agg(F.min_by(F.struct("sample", *rest), "sample").alias("_one")).select("person", *[F.col("_one")[c].alias(c) for c in ("sample", *rest)])
    bad = people.join(flagged.select("sample"), "sample", "left_semi").select("person").distinct().withColumn("_bad", F.lit(True))
    out = scores.join(one, "person", "left").join(bad, "person", "left")
    return out.withColumn("is_outlier", F.coalesce("_bad", F.lit(False))).drop("_bad")
