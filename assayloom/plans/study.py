"""A study from measurements to export as lazy plans (survey J2, J4-J7): every batch is a partition of one table.

`StudyPlan` names the steps in order; each takes the tables made so far and adds its own. Other tables run as they
are written; `only`, `first` and `last` pick
steps as a rerun needs them; tables of `SETTLED` are computed once, as their step is reached. Steps of `NEEDS` run only where their side tables are given.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayloom.functions.blocks import normal_ranks
from assayloom.operators import association, genetics, identity, normalize, pca, prediction, qc, variants
from assayloom.sources import tables

Tables = dict[str, DataFrame]
Step = Callable[[Tables, tables.Settings], Tables]


def load(t: Tables, s: tables.Settings) -> Tables:
    """Controls and samples with too many gaps go."""
    long = tables.drop_controls(t["measurements"])
    quality = qc.sample_missingness(long, s.max_missing)
    return {"quality": quality, "long": long.join(quality.filter("qc_pass").select("sample"), "sample", "left_semi")}


def technical(t: Tables, s: tables.Settings) -> Tables:
    stats = qc.sample_technical_stats(t["long"], s.mean_mads, s.sd_mads, s.technical_missing)
    return {"technical_stats": stats, "technical": stats.filter("is_outlier").select("sample")}


def extremes(t: Tables, s: tables.Settings) -> Tables:
    out = qc.zscore_outliers(t["long"], s.z, s.z_share)
    return {"zscore_stats": out, "zscore": out.filter("is_outlier").select("sample")}


def components(t: Tables, s: tables.Settings) -> Tables:
    """Samples outside the cascade over four components, row median and row IQR."""
    scores = pca.pca(t["long"], 4).scores
    names = ("pc1", "pc2", "pc3", "pc4")
    wide = scores.groupBy("sample").agg(*[F.max(F.when(F.col("pc") == i, F.col("score"))).alias(c) for i, c in enumerate(names, 1)])
    out = qc.outlier_cascade(wide, t["long"], names, s.pca_sd)
    return {"components": wide, "pca_stats": out, "pca": out.filter("is_outlier").select("sample")}


def label_check(t: Tables, s: tables.Settings) -> Tables:
    """Samples whose recorded label (labels: sample, label 0/1 or null) the out-of-fold elastic net contradicts."""
    known = t["labels"].filter("label IS NOT NULL").select("sample", "label")
    vectors = prediction.complete_vectors(t["long"]).join(known, "sample")
    scored = genetics.settled(prediction.elastic_net_cv(vectors, "label", list(s.alphas), s.strengths if isinstance(s.strengths, int) else list(s.strengths), s.folds, s.inner_folds))
    out = prediction.mismatch(scored, "score", "label", prediction.youden(scored).head()["threshold"])
    return {"label_stats": out, "label": out.filter("outlier").select("sample")}


def _consistency(long: DataFrame, genotypes: DataFrame) -> DataFrame:
    return genetics.genotype_sample_stats(genetics.genotype_z(long.join(genotypes, ["sample", "feature"])))


def training(t: Tables, s: tables.Settings) -> Tables:
    """Variants that cohorts of passed-round measurements choose, and how many sd the genotype cut-off lies over the mean
    (training: sample, feature, variant, dosage, beta)."""
    chosen, cuts = variants.trained_variants(t["long"], t["training"], s.injected, s.cohorts, s.folds, s.variant_frequency)
    return {"variants": chosen, "trained": cuts}


def _cut(t: Tables) -> float:
    """The trained number of sd, or 4 where none was trained or it isn't over the mean."""
    k = t["trained"].head()["k"] if "trained" in t else None
    return k if k is not None and k > 0 else 4.0


def _agreed(t: Tables) -> DataFrame:
    """The genotypes of the variants that training agreed on; of all where there was none or it chose none."""
    if "variants" not in t or t["variants"].isEmpty():
        return t["genotypes"]
    return t["genotypes"].join(t["variants"].select("variant"), "variant", "left_semi")


def genotype(t: Tables, s: tables.Settings) -> Tables:
    """Samples whose values don't go with their dosages (genotypes: sample, feature, variant, dosage, beta)."""
    out = genetics.genotype_flags(_consistency(t["long"], _agreed(t)), _cut(t))
    return {"genotype_stats": out, "genotype": out.filter("is_outlier").select("sample")}


def provenance(t: Tables, s: tables.Settings) -> Tables:
    """How many injected errors the two checks find: swaps within a label, flipped labels, swaps across labels, by category;
    category 0 gives the false alarms."""
    people = t["label_stats"].select("sample", "label")
    errors = genetics.settled(prediction.inject_errors(people, s.injected))
    by_value = genetics.genotype_flags(_consistency(variants.moved(t["long"], errors), _agreed(t)), _cut(t)).filter("is_outlier").select("sample")
    scores = t["label_stats"].select(F.col("sample").alias("source"), "score")
    by_label = errors.join(scores, "source").filter((F.col("score") >= 0.5).cast("int") != F.col("new_label")).select("sample")
    return {"injected": errors, "provenance": prediction.detection_metrics(errors.select("sample", "category"), by_value.unionByName(by_label))}


def flags(t: Tables, s: tables.Settings) -> Tables:
    """All flags side by side, and the matrix without flagged samples. Lists that are absent count as empty."""
    samples = t["measurements"].select("sample").distinct()
    failed = t["quality"].filter("NOT qc_pass").select("sample")
    table = qc.comprehensive_qc(samples, {"initial": failed} | {n: t[n] for n in ("technical", "zscore", "pca", "label", "genotype") if n in t})
    return {"flags": table, "clean": t["long"].join(table.filter("qc_flag = 1").select("sample"), "sample", "left_anti")}


def scale(t: Tables, s: tables.Settings) -> Tables:
    return {"normal": normalize.median_scale(t["clean"]).drop("factor")}


def bridge(t: Tables, s: tables.Settings) -> Tables:
    """The batch moved onto the reference batch (reference: person, feature, value) by the people in both."""
    own = identity.add_person(t["normal"], t["mapping"]).filter("person IS NOT NULL").select("person", "feature", "value")
    factors = normalize.bridge_factors(t["reference"], own, s.least_bridges)
    return {"unbridged": t["normal"], "normal": normalize.bridge_additive(t["normal"], factors)}


def agreement(t: Tables, s: tables.Settings) -> Tables:
    """How people in both batches agree with the reference: by person after the shift, by feature before and after."""
    ref = t["reference"].select("person", "feature", F.col("value").alias("x"))

    def pairs(long: DataFrame) -> DataFrame:
        return ref.join(identity.add_person(long, t["mapping"]).select("person", "feature", F.col("value").alias("y")), ["person", "feature"])

    before, after = pairs(t["unbridged"]), pairs(t["normal"])
    return {"agreement": association.pair_agreement(after, 3), "feature_agreement": association.concordance_change(before, after)}


def adjust(t: Tables, s: tables.Settings) -> Tables:
    """Values without what the covariates (sample and numeric columns) explain."""
    names = [c for c in t["covariates"].columns if c != "sample"]
    out = normalize.covariates_residualise(t["normal"].join(t["covariates"], "sample", "left"), names)
    return {"normal": out.drop(*names)}


def people(t: Tables, s: tables.Settings) -> Tables:
    """One sample a person, under the person's id."""
    first = identity.first_sample_per_person(t["mapping"].join(t["normal"].select("sample").distinct(), "sample", "left_semi"))
    return {"persons": t["normal"].join(first, "sample").select("person", "feature", "value")}


def kinship(t: Tables, s: tables.Settings) -> Tables:
    """Related people (edges: id1, id2, kinship) go until no pair is left, those with most relatives first."""
    known = t["persons"].select(F.col("person").alias("id")).distinct()
    missing = known.join(t["mapping"].join(t["quality"], "sample").groupBy(F.col("person").alias("id")).agg(F.min("missing_rate").alias("missing_rate")), "id", "left")
    edges = genetics.related_pairs(t["edges"], s.kinship)
    edges = edges.join(known.withColumnRenamed("id", "id1"), "id1", "left_semi").join(known.withColumnRenamed("id", "id2"), "id2", "left_semi").select("id1", "id2")
    gone = genetics.greedy_unrelated(edges, missing.select("id", F.coalesce("missing_rate", F.lit(0.0)).alias("missing_rate"), F.col("id").alias("ordinal")))
    return {"related": gone, "persons": t["persons"].join(gone.withColumnRenamed("id", "person"), "person", "left_anti")}


def ranks(t: Tables, s: tables.Settings) -> Tables:
    return {"ranked": normal_ranks(t["persons"].select(F.col("person").alias("sample"), "feature", "value"), "value", "feature")}


STEPS: tuple[tuple[str, Step], ...] = (
    ("load", load), ("pca", components), ("technical", technical), ("zscore", extremes), ("label", label_check),
    ("training", training), ("genotype", genotype), ("provenance", provenance), ("flags", flags), ("scale", scale), ("bridge", bridge), ("agreement", agreement), ("covariates", adjust), ("people", people), ("kinship", kinship), ("ranks", ranks),
)
#: Tables that several later steps read: computed once, in the session's checkpoint folder.
SETTLED = {"long", "pca", "technical", "zscore", "label", "trained", "variants", "genotype", "clean", "normal", "persons", "related"}
#: Steps that run only where the tables are given.
NEEDS = {
    "label": ("labels",), "training": ("training",), "genotype": ("genotypes",), "provenance": ("genotypes", "labels"), "bridge": ("reference",),
    "agreement": ("reference",), "covariates": ("covariates",), "kinship": ("edges",),
}


class MissingTable(ValueError):
    """A step lacks a table that it needs."""


@dataclass
class StudyPlan:
    settings: tables.Settings = field(default_factory=tables.Settings)
    steps: tuple[tuple[str, Step], ...] = STEPS

    def chosen(self, only: str | None = None, first: str | None = None, last: str | None = None) -> list[str]:
        """Names of the steps that would run."""
        names = [n for n, _ in self.steps]
        for n in (only, first, last):
            if n is not None and n not in names:
                raise ValueError(f"no step {n}; there are {', '.join(names)}")
        if only:
            return [only]
        return names[names.index(first) if first else 0 : names.index(last) + 1 if last else len(names)]

    def run(self, given: Tables, only: str | None = None, first: str | None = None, last: str | None = None) -> Tables:
        """The given tables and those of the chosen steps; a step whose inputs are absent says which. A step of `NEEDS` without
        its side tables is passed over, unless `only` asks for it."""
        wanted, have = self.chosen(only, first, last), dict(given)
        for name, step in self.steps:
            if name in wanted and (only or all(n in have for n in NEEDS.get(name, ()))):
                try:
                    have |= {n: genetics.settled(df) if n in SETTLED else df for n, df in step(have, self.settings).items()}
                except KeyError as e:
                    raise MissingTable(f"step {name} needs the table {e.args[0]}") from e
        return have


def several(plan: StudyPlan, batches: dict[str, Tables], reference: str, union: bool = True, least_features: int = 100, bridged: bool = False) -> dict[str, Tables]:
    """Every batch through the plan, the reference first; a batch that lacks a table is left out with a warning, the reference may
    not. Any other error ends the run. With `bridged`, the others are moved onto the reference batch's people.

    With `union`, the result `all` has the people of all batches on common features, later batches taking precedence.
    """
    out = {reference: plan.run(batches[reference])}
    for name in batches:
        if name != reference:
            try:
                out[name] = plan.run(batches[name] | ({"reference": out[reference]["persons"]} if bridged and batches[name] else {}))
            except MissingTable as e:
                warnings.warn(f"batch {name} is left out: {e}", stacklevel=2)
    if union and len(out) > 1:
        merged = None
        for name in out:
            merged = out[name]["persons"] if merged is None else identity.batch_union(out[name]["persons"], merged, least_features)
        out["all"] = {"persons": merged} | ranks({"persons": merged}, plan.settings)
    return out


def save(spark: SparkSession, made: dict[str, Tables], base: str, names: tuple[str, ...] = ("flags", "ranked")) -> list[str]:
    """Tables of every batch as Parquet, the batch a partition folder; the paths written."""
    paths = []
    for batch, t in made.items():
        for i, n in enumerate(names):
            if n in t:
                paths.append(tables.artifact(base, i, n, batch))
                tables.write_table(t[n], paths[-1])
    return paths
