"""Variants chosen by lassos over cohorts of injected errors."""

import numpy as np
import pytest

from assayloom.operators import genetics, variants


@pytest.fixture(scope="module")
def study(spark):
    """Ten variants of which three move their feature strongly; the rest say nothing."""
    r = np.random.default_rng(12)
    dosage = r.integers(0, 3, (160, 10))
    value = r.normal(size=(160, 10)) + dosage * np.where(np.arange(10) < 3, 6.0, 0.0)
    long = [(f"s{i:03d}", f"f{j}", float(value[i, j])) for i in range(160) for j in range(10)]
    geno = [(f"s{i:03d}", f"f{j}", f"v{j}", int(2 - dosage[i, j]), 6.0 if j < 3 else 0.0) for i in range(160) for j in range(10)]
    make = spark.createDataFrame
    return make(long, "sample string, feature string, value double").repartition(3), make(geno, "sample string, feature string, variant string, dosage int, beta double").repartition(3)


def test_telling_variants_are_chosen(study):
    long, genotypes = study
    chosen, cuts = variants.trained_variants(long, genotypes, 40, cohorts=2, folds=3, strengths=8, signed=False)
    found = {r["variant"]: (r["n"], r["frequency"]) for r in chosen.collect()}
    assert found.keys() >= {"v0", "v1", "v2"} and found["v0"] == (2, 1.0)
    row = cuts.head()
    assert row["n_cohorts"] == 2 and row["k"] is not None


def test_vectors_fill_gaps(spark):
    rows = spark.createDataFrame([("a", "v1", 1.0), ("a", "v1", 3.0), ("b", "v2", None), ("b", "v9", 5.0)], "sample string, variant string, std_residual double")
    got = {r["sample"]: list(r["features"]) for r in variants.residual_vectors(rows, ["v1", "v2"]).collect()}
    assert got == {"a": [2.0, 0.0], "b": [0.0, 0.0]}


def test_signed_residuals_by_default(spark):
    rows = spark.createDataFrame([("a", "v1", -1.0), ("b", "v1", 2.0)], "sample string, variant string, std_residual double")
    got = lambda **kw: {r["sample"]: list(r["features"]) for r in variants.residual_vectors(rows, ["v1"], **kw).collect()}
    assert got() == {"a": [-1.0], "b": [2.0]} and got(signed=False) == {"a": [1.0], "b": [2.0]}


def test_no_choice_without_both_classes(spark, study):
    long, genotypes = study
    one = long.filter("feature = 'f0'"), genotypes.filter("feature = 'f0'")
    chosen, cuts = variants.trained_variants(*one, 5, cohorts=1)
    assert chosen.count() == 0 and cuts.head()["k"] is None


def test_few_samples_set_no_cut_off(spark):
    rows = lambda n: spark.createDataFrame([(i, 100.0 if i == 0 else 1.0 + i / 100, 1.0, 1.0, 20) for i in range(n)], "sample int, mean_abs_z double, median_abs_z double, median_abs_residual double, n_residuals int")
    flagged = lambda n: [r["sample"] for r in genetics.genotype_flags(rows(n), k=1.0).filter("is_outlier").collect()]
    assert flagged(4) == [] and flagged(6) == [0]
