"""Landing files: CSV and JSON scans with declared schemas, discovery and lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom import schemas
from claimloom.functions.fields import ladder

CORRUPT = "_malformed"


def read_dataset(spark: SparkSession, name: str, path: str, *, keep_malformed: bool = False) -> DataFrame:
    """Headered CSV under its declared schema. With ``keep_malformed`` the raw text of a line that
    does not fit the schema is kept in a column of its own instead of being read shifted."""
    declared = schemas.schema(name)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_malformed:
        declared = declared.add(CORRUPT, "string")
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(declared).csv(path)


def read_events(spark: SparkSession, path: str, *, array_file: bool = False) -> DataFrame:
    """Status events as JSON: one object per line (splittable), or one array per file."""
    reader = spark.read.schema(schemas.schema("claim_status_events", streaming=True))
    return reader.option("multiLine", array_file).json(path)


# A file goes to the first dataset whose token its name contains.
_ROUTES = (
    ("claims", "claims"),
    ("members", "members"),
    ("providers", "providers"),
    ("diagnosis", "diagnosis_ref"),
    ("procedure", "procedure_ref"),
)


def route(file_name: Column) -> Column:
    return ladder(((file_name.contains(t), target) for t, target in _ROUTES), F.lit("payer_ref"))


def list_landing(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """One row per landing file. The content column is never selected, so no file is opened."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(
        name.alias("file_name"),
        route(F.col("path")).alias("dataset"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
        "path",
    )


def ingest_log(landing: DataFrame, run_id: str, as_of: Column) -> DataFrame:
    """Log rows of the files a run takes in."""
    return landing.select(
        "file_name",
        "dataset",
        "file_size",
        F.lit(run_id).alias("pipeline_run_id"),
        as_of.alias("ingested_at"),
    )


def with_lineage(df: DataFrame, run_id: str, as_of: Column, source: Column | None = None) -> DataFrame:
    """Ingestion time, source file and run id. Without ``source`` the scan's own file name is used."""
    return df.withColumns(
        {
            "ingestion_timestamp": as_of,
            "source_file_name": F.col("_metadata.file_name") if source is None else source,
            "pipeline_run_id": F.lit(run_id),
        }
    )


def split_malformed(lines: DataFrame, columns: list[str], text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Three-column reference lines with unquoted commas: the first field is the key, the last the
    category, whatever lies between is the description. Lines with fewer fields are rejected."""
    parts = F.split(text, ",")
    n = F.size(parts)
    middle = F.concat_ws(",", F.slice(parts, F.lit(2), F.greatest(n - F.lit(2), F.lit(0))))
    good = lines.filter(n >= 3).select(
        F.trim(parts[0]).alias(columns[0]),
        F.trim(middle).alias(columns[1]),
        F.trim(F.element_at(parts, -1)).alias(columns[2]),
    )
    return good, lines.filter(~(n >= 3))
