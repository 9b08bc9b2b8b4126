"""Files in: CV documents as binary rows, checked reference CSVs; JSON archives out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import id_of_path, trimmed


class ReferenceDataError(ValueError):
    """A reference file that cannot be used."""


def documents(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(submission_id, cv_file_path, content_hash, content) of a folder's files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(
        id_of_path(F.col("path")).alias("submission_id"), F.col("path").alias("cv_file_path"), F.sha2("content", 256).alias("content_hash"), "content"
    )


def listed(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(submission_id, cv_file_path, modified_at, length) of the files below a folder; their contents are not read.

    A folder that is not there has none. A file's id is its name, whatever folder it lies in.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "submission_id string, cv_file_path string, modified_at timestamp, length bigint")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select(id_of_path(F.col("path")).alias("submission_id"), F.col("path").alias("cv_file_path"), F.col("modificationTime").alias("modified_at"), "length")


def pending(specs: DataFrame, recorded: DataFrame, files: DataFrame) -> DataFrame:
    """``specs`` (id, filename and others) still to make: neither recorded by id nor there as a file of that name."""
    there = files.select(F.element_at(F.split("cv_file_path", "/"), -1).alias("filename")).distinct()
    return specs.join(recorded.select("id").distinct(), "id", "left_anti").join(there, "filename", "left_anti").select(*specs.columns)


def without_file(recorded: DataFrame, files: DataFrame) -> DataFrame:
    """``recorded`` (filename and others) whose file is missing."""
    there = files.select(F.element_at(F.split("cv_file_path", "/"), -1).alias("filename")).distinct()
    return recorded.join(there, "filename", "left_anti").select(*recorded.columns)


def cv_filename(number, role, seniority) -> Column:
    """The file name of a document to make, such as cv_001_data_engineer_senior.pdf."""
    return F.concat(F.lit("cv_"), number, F.lit("_"), F.replace(F.lower(role), F.lit(" "), F.lit("_")), F.lit("_"), F.lower(seniority), F.lit(".pdf"))


def extracted(files: DataFrame, extract: Callable[[bytes], str]) -> DataFrame:
    """Texts by an injected extractor, with an error column: one bad file does not stop the others."""

    def run(batches: Iterator):
        for frame in batches:
            texts, errors = [], []
            for content in frame["content"]:
                try:
                    texts.append(extract(bytes(content)))
                    errors.append(None)
                except Exception as e:  # any parser's failure is that file's
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield frame.drop(columns=["content"]).assign(raw_text=texts, error=errors)

    kinds = ", ".join(f"{n} {t}" for n, t in files.dtypes if n != "content")
    return files.mapInPandas(run, f"{kinds}, raw_text string, error string")


def _headed(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A headed CSV as it stands; raises on an empty file and on missing columns."""
    try:
        rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            raise ReferenceDataError("the file is empty") from e
        raise
    if not rows.columns:
        raise ReferenceDataError("the file is empty")
    missing = sorted(set(required) - set(rows.columns))
    if missing:
        raise ReferenceDataError(f"missing columns: {', '.join(missing)}")
    return rows


def _refuse(rows: DataFrame, why: str, column: str) -> None:
    """Raises with up to five values if there are rows."""
    found = [r[0] for r in rows.select(column).limit(5).collect()]
    if found:
        raise ReferenceDataError(f"{why}: {', '.join(map(str, found))}")


def reference_rows(spark: SparkSession, path: str, required: list[str], key: str) -> DataFrame:
    """The required columns of a headed CSV, trimmed; raises on an empty file, missing columns, blank or repeated keys, no rows."""
    names = list(dict.fromkeys([*required, key]))
    rows = _headed(spark, path, names).select(*[trimmed(F.coalesce(c, F.lit(""))).alias(c) for c in names])
    _refuse(rows.where(F.col(key) == ""), f"blank {key}", key)
    _refuse(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1"), f"repeated {key}", key)
    if rows.limit(1).count() == 0:
        raise ReferenceDataError("no rows")
    return rows.select(*required)


def aliases(rows: DataFrame) -> DataFrame:
    """(alias, canonical_skill) of rows whose aliases are separated by bars."""
    each = rows.select("canonical_skill", F.explode(F.split("aliases", r"\|")).alias("alias"))
    return each.select(trimmed(F.col("alias")).alias("alias"), "canonical_skill").where("alias <> ''")


def skills_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical_skill); raises on a blank name, a row without aliases, a declared count that is wrong, an alias of two skills."""
    raw = _headed(spark, path, ["canonical_skill", "aliases"])
    count = F.col("alias_count") if "alias_count" in raw.columns else F.lit(None).cast("string")
    rows = raw.select(
        trimmed(F.coalesce("canonical_skill", F.lit(""))).alias("canonical_skill"),
        F.coalesce("aliases", F.lit("")).alias("aliases"),
        trimmed(F.coalesce(count, F.lit(""))).alias("declared"),
    )
    listed = F.size(F.filter(F.transform(F.split("aliases", r"\|"), trimmed), lambda x: x != ""))
    _refuse(rows.where("canonical_skill = ''"), "blank canonical_skill beside", "aliases")
    _refuse(rows.where(listed == 0), "no aliases", "canonical_skill")
    declared = F.col("declared").try_cast("int")
    _refuse(rows.where((F.col("declared") != "") & ~declared.eqNullSafe(listed)), "alias_count is wrong", "canonical_skill")
    out = aliases(rows)
    _refuse(out.groupBy("alias").agg(F.count_distinct("canonical_skill").alias("n")).where("n > 1"), "alias of more than one skill", "alias")
    if out.limit(1).count() == 0:
        raise ReferenceDataError("no aliases")
    return out


def job_titles(spark: SparkSession, path: str) -> DataFrame:
    """(job_title, seniority_level); a blank level is null."""
    rows = reference_rows(spark, path, ["job_title", "seniority_level"], "job_title")
    return rows.withColumn("seniority_level", F.nullif("seniority_level", F.lit("")))


def location_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(location_token, country); raises where a country is blank."""
    rows = reference_rows(spark, path, ["location_token", "country"], "location_token")
    _refuse(rows.where("country = ''"), "no country", "location_token")
    return rows


GROUND_TRUTH = "id string, folder string, role string, seniority string, years string, location string, github string, inconsistency_types string, filename string"


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """The recorded documents with their planted flaws as a list and the submission_id of their file.

    A missing file has no documents; a folder of such files is one.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        rows = spark.createDataFrame([], GROUND_TRUTH)
    else:
        rows = _headed(spark, path, [c.split(" ")[0] for c in GROUND_TRUTH.split(", ")])
    kinds = F.filter(F.split(F.coalesce("inconsistency_types", F.lit("")), r"\|"), lambda x: x != "")
    return rows.withColumns({"inconsistency_types": kinds, "submission_id": id_of_path(F.col("filename"))})


def recorded_ids(spark: SparkSession, path: str) -> DataFrame:
    return ground_truth(spark, path).select("id").distinct()


def record(rows: DataFrame, path: str) -> None:
    """Adds documents to the ground truth at ``path``, a folder of headed CSV files; flaws are joined by bars.

    Missing columns are left blank.
    """
    kinds = dict(rows.dtypes)
    columns = []
    for name in (c.split(" ")[0] for c in GROUND_TRUTH.split(", ")):
        value = F.col(name) if name in kinds else F.lit(None)
        columns.append((F.array_join(value, "|") if kinds.get(name, "").startswith("array") else value.cast("string")).alias(name))
    rows.select(*columns).write.mode("append").option("header", True).option("escape", '"').csv(path)


def archive(df: DataFrame, path: str, buckets: int = 64) -> None:
    """One JSON object for each submission_id, dates and times as text, under ``path``; a later one takes the earlier one's place.

    Objects lie in buckets by id, and only the buckets of ``df`` are read and written again. Of
    rows that share an id in ``df`` one stays.
    """
    spark = df.sparkSession
    rows = df.dropDuplicates(["submission_id"]).withColumn("_bucket", F.pmod(F.xxhash64("submission_id"), F.lit(buckets)).cast("int"))
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
        told = T.StructType([*df.schema.fields, T.StructField("_bucket", T.IntegerType())])
        old = spark.read.schema(told).json(path).where(F.col("_bucket").isin(touched))
        rows = old.join(rows.select("submission_id"), "submission_id", "left_anti").unionByName(rows)
    rows.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").json(path)
