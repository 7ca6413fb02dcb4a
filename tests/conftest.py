from __future__ import annotations

import json
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stratum import read_bronze  # noqa: E402
from stratum.plans.spec import BY_FILE, Dataset  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stratum-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Landing:
    """A landing folder and the table made from it."""

    def __init__(self, spark, root: Path, layout: str = BY_FILE, pattern: str = "*.json", prefix: str = "", **options):
        self.spark, self.root, self.options = spark, root, options
        self.dataset = Dataset(
            "", "table", str(root / "in"), str(root / "table"), pattern, prefix=prefix, layout=layout,
            state=str(root / "state"), format=options.get("format", "json"),
            serialize_lists=options.get("serialize_lists", True),
        )
        (root / "in").mkdir(parents=True, exist_ok=True)
        self.clock = 1_700_000_000

    def put(self, name: str, content, mtime: int | None = None) -> Path:
        path = self.root / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), "utf-8")
        self.clock += 10
        os.utime(path, (mtime or self.clock, mtime or self.clock))
        return path

    def run(self, **options) -> dict[str, int]:
        from stratum import ingest_dataset

        summary = ingest_dataset(self.spark, self.dataset, **options)
        return {row.status: row.n_files for row in summary.collect()}

    def table(self):
        return read_bronze(self.spark, self.dataset)

    def rows(self, *columns: str) -> list[tuple]:
        df = self.table()
        return sorted((tuple(row) for row in df.select(*[f"`{c}`" for c in columns]).collect()), key=repr)

    def columns(self) -> dict[str, str]:
        return {name: kind for name, kind in self.table().dtypes if name != "file_key"}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


@pytest.fixture
def make_landing(spark, tmp_path):
    count = iter(range(100))
    return lambda **options: Landing(spark, tmp_path / f"tree{next(count)}", **options)
