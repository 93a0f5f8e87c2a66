"""Readers and writers of measurement data and its side tables (survey A1-A18), on any path Spark opens."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.functions.stats import no_nan

SAMPLE_ALIASES = ("SampleID", "SAMPLE_ID", "sample_id", "Sample_ID", "ID", "id")
LONG_FEATURE, LONG_VALUE = ("Assay", "OlinkID"), ("NPX", "PCNormalizedNPX")
CONTROLS = r"(?i)(incubation|extension|amplification) control"
MISSING_EXPORT = -9


@dataclass(frozen=True)
class Settings:
    """Thresholds of the steps; a nested mapping overrides what it names."""

    max_missing: float = 0.10
    z: float = 4.0
    z_share: float = 0.10
    pca_sd: float = 5.0
    mean_mads: float = 5.0
    sd_mads: float = 4.0
    technical_missing: float = 0.05
    least_bridges: int = 10
    kinship: float = 0.0884
    alphas: tuple[float, ...] = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
    strengths: int | tuple[float, ...] = 30
    folds: int = 5
    inner_folds: int = 5
    cohorts: int = 5
    variant_frequency: float = 0.5
    injected: int = 50
    extra: dict = field(default_factory=dict)

    @classmethod
    def of(cls, given: dict | None) -> Settings:
        known = {k: v for k, v in (given or {}).items() if k in cls.__dataclass_fields__ and v is not None}
        return cls(**known | {"extra": {k: v for k, v in (given or {}).items() if k not in cls.__dataclass_fields__}})

    def items(self) -> dict:
        return asdict(self)


def detect_format(path: str) -> str:
    """parquet, csv or tsv by the path's ending; anything else is tsv."""
    name = path.lower().removesuffix(".gz")
    return "parquet" if name.endswith(".parquet") else "csv" if name.endswith(".csv") else "tsv"


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table of whatever format; the separator of text is taken from its first line, gzip is read as it is."""
    if detect_format(path) == "parquet":
        return spark.read.parquet(path)
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    sep = max(("\t", ",", ";"), key=line.count)
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", "NA")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def sample_column(df: DataFrame) -> str:
    """The column that names samples: the first alias there is, else the first column."""
    return next((a for a in SAMPLE_ALIASES if a in df.columns), df.columns[0])


def is_long(df: DataFrame) -> bool:
    return any(c in df.columns for c in LONG_FEATURE) and any(c in df.columns for c in LONG_VALUE)


def to_long(df: DataFrame) -> DataFrame:
    """sample, feature, value of a wide or long measurement table: NaN as null, repeated cells averaged."""
    key = sample_column(df)
    if is_long(df):
        feature, value = next(c for c in LONG_FEATURE if c in df.columns), next(c for c in LONG_VALUE if c in df.columns)
        rows = df.select(F.col(key).cast("string").alias("sample"), F.col(feature).alias("feature"), no_nan(F.col(value).cast("double")).alias("value"))
    else:
        wide = df.select(F.col(key).cast("string").alias("sample"), *[no_nan(F.col(f"`{c}`").cast("double")).alias(c) for c in df.columns if c != key])
        rows = wide.unpivot(["sample"], [f"`{c}`" for c in wide.columns if c != "sample"], "feature", "value")
    return rows.groupBy("sample", "feature").agg(F.avg("value").alias("value"))


def drop_controls(long: DataFrame) -> DataFrame:
    return long.filter(~F.col("feature").rlike(CONTROLS))


def to_wide(long: DataFrame, fill: float | None = None, features: list[str] | None = None) -> DataFrame:
    """One row a sample, one column a feature; for export. The features are read once unless given."""
    out = long.groupBy("sample").pivot("feature", features).agg(F.first("value"))
    return out if fill is None else out.fillna(fill)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of `schema` in its order and types; those that are absent come as typed nulls."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def first_column(df: DataFrame, *names: str) -> Column:
    """The first of these columns that the table has."""
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        raise ValueError(f"none of {', '.join(names)} in {', '.join(df.columns)}")
    return F.col(f"`{found}`")


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    df = scan(spark, path)
    return df.withColumnRenamed(sample_column(df), "sample")


def bridging(spark: SparkSession, path: str, person: str, pattern: str) -> DataFrame:
    """People with boolean in_* flags, those whose id fits `pattern`."""
    df = scan(spark, path)
    return df.select(first_column(df, person).alias("person"), *[to_bool(F.col(c)).alias(c) for c in df.columns if c.startswith("in_")]).filter(F.col("person").rlike(pattern))


def id_map(spark: SparkSession, path: str, samples: tuple[str, ...], people: tuple[str, ...], pattern: str) -> DataFrame:
    """sample, person of a map whose columns go by one of these names, without nulls and ids that don't fit."""
    df = scan(spark, path)
    return df.select(first_column(df, *samples).alias("sample"), first_column(df, *people).alias("person")).dropna().filter(F.col("person").rlike(pattern))


def kinship_edges(spark: SparkSession, path: str) -> DataFrame:
    df = scan(spark, path)
    return df.select(first_column(df, "IID1", "ID1").alias("id1"), first_column(df, "IID2", "ID2").alias("id2"), first_column(df, "KINSHIP", "Kinship").cast("double").alias("kinship"))


def genotypes_long(raw: DataFrame) -> DataFrame:
    """iid, variant, dosage of a wide dosage table; the allele at the end of a column's name goes."""
    fixed = {"FID", "IID", "PAT", "MAT", "SEX", "PHENOTYPE"}
    names = [c for c in raw.columns if c not in fixed]
    long = raw.select(F.col("IID").alias("iid"), *[F.col(f"`{c}`").cast("int").alias(c) for c in names]).unpivot(["iid"], [f"`{c}`" for c in names], "variant", "dosage")
    return long.withColumn("variant", F.regexp_replace("variant", "_[ACGT]+$", ""))


def select_variants(genotypes: DataFrame, variants: DataFrame, people: DataFrame) -> DataFrame:
    """Rows of wanted variants and people: two semi joins that reach the scan as filters."""
    return genotypes.join(variants.select("variant").distinct(), "variant", "left_semi").join(people.select("iid").distinct(), "iid", "left_semi")


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """path, length, modified of files in a folder of any store, without their content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", "modificationTime")


def content_key(ids: DataFrame, column: str) -> DataFrame:
    """key: a digest of the distinct ids whatever their order, made from sums so that no list is collected."""
    h = ids.select(F.col(column).cast("string").alias("x")).distinct()
    a, b = (F.sum(F.pmod(F.xxhash64("x", F.lit(s)), F.lit(1 << 53)).cast("decimal(38,0)")) for s in (1, 2))
    return h.agg(F.md5(F.concat_ws(",", F.count("*").cast("string"), a.cast("string"), b.cast("string"))).alias("key"))


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(path)


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet; with `by`, a folder for each value, so a batch is a partition and not a name."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def plink_table(long: DataFrame, features: list[str] | None = None) -> DataFrame:
    """FID, IID and a column a feature, missing values as -9."""
    wide = to_wide(long, features=features)
    return wide.select(F.col("sample").alias("FID"), F.col("sample").alias("IID"), *[F.coalesce(F.col(f"`{c}`"), F.lit(float(MISSING_EXPORT))).alias(c) for c in wide.columns if c != "sample"])


def to_bool(c: Column) -> Column:
    """TRUE, T, true, 1, yes, y -> true; everything else false, null stays null."""
    return F.when(c.isNotNull(), F.lower(F.trim(c.cast("string"))).isin("true", "t", "1", "yes", "y"))


def artifact(base: str, step: int, name: str, batch: str | None = None) -> str:
    """Where a step's table goes: step and name in the path, the batch as a partition folder."""
    return f"{base.rstrip('/')}/{step:02d}_{name}" + (f"/batch_id={batch}" if batch else "")
