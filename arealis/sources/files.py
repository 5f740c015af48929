"""Finding input files and reading keys from their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the published files and the positions of their keys.
DATA_PREFIX, DATA_SUFFIX = "2021Census_", ".csv"
METADATA_PREFIX, METADATA_SUFFIX = "Metadata_", ".xlsx"
TABLE_PART, BOUNDARY_PART = 1, 3


def name_matches(name: Column, prefix: str, suffix: str) -> Column:
    """Case-insensitive prefix and suffix match on a file name."""
    low = F.lower(name)
    return low.startswith(prefix.lower()) & low.endswith(suffix.lower())


def discover(spark: SparkSession, directory: str, prefix: str = DATA_PREFIX, suffix: str = DATA_SUFFIX) -> DataFrame:
    """Recursive file listing as ``path, name``; file contents are not read."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory).select("path")
    )
    named = listing.withColumn("name", F.url_decode(F.substring_index("path", "/", -1)))
    return named.filter(name_matches(F.col("name"), prefix, suffix))


def discover_metadata(spark: SparkSession, directory: str, prefix: str = METADATA_PREFIX, suffix: str = ".xls") -> DataFrame:
    """Workbooks, old or new suffix (``.xls`` or ``.xlsx``)."""
    both = discover(spark, directory, prefix, "")
    low = F.lower("name")
    return both.filter(low.endswith(suffix.lower()) | low.endswith(suffix.lower() + "x"))


def with_file_keys(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Add ``table`` and ``boundary`` taken from the parts of the file name."""
    low = F.lower(F.col(name_col))
    parts = F.split(F.substring_index(low, ".", 1), "_")
    return df.withColumns(
        {
            "table": F.get(parts, F.lit(TABLE_PART)),
            "boundary": F.when(low.contains("_aus."), F.lit("aust")).otherwise(
                F.get(parts, F.lit(BOUNDARY_PART))
            ),
        }
    )
