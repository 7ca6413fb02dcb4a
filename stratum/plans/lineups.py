"""Silver: one row per match and team from the bronze lineup files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import files
from ..operators.columns import project, with_file_value
from ..operators.rows import require_rows, unique_by
from ..sinks.parquet import write_table
from .ingest import read_bronze
from .spec import FILE_KEY, dataset

# Fixed value: the file names that count as lineups, letter case aside.
LINEUP_FILE = r"(?i)lineups_(\d+)\.parquet$"

COLUMNS = ["team_id", "team_name", "lineup"]
KEYS = ["match_id", "team_id"]


def lineups_by_match(bronze: DataFrame, file_name: Column) -> DataFrame:
    """Project, key by the match number in the file name, and drop duplicate teams of a match.

    Rows of files with other names are left out; of two rows for one team the smaller stays.
    """
    keyed = with_file_value(bronze, "match_id", file_name, LINEUP_FILE)
    kept = project(keyed.where(F.col("match_id").isNotNull()), [*COLUMNS, "match_id"])
    return unique_by(kept, KEYS)


def build_lineups(spark: SparkSession, base: str) -> str:
    """Run the silver job below one base folder; returns the path of the table."""
    lineups = dataset("open_data", "lineups").below(base)
    target = f"{base.rstrip('/')}/silver/open_data/lineups/lineups_by_match"
    if not files.exists(spark, lineups.bronze):
        raise RuntimeError(f"no lineup files found in {lineups.bronze}")
    bronze = read_bronze(spark, lineups)
    file_name = F.concat(F.col(FILE_KEY), F.lit(".parquet"))
    require_rows(bronze.where(file_name.rlike(LINEUP_FILE)), f"no lineup files found in {lineups.bronze}")
    write_table(lineups_by_match(bronze, file_name), target, compression="zstd")
    return target
