"""What a dataset is, and the datasets of the two known sources."""

from __future__ import annotations

from dataclasses import dataclass, replace

FILE_KEY = "file_key"
INGEST_BATCH = "ingest_batch"

# One partition per landing file: replacing a file replaces its partition. Right up to some
# tens of thousands of files.
BY_FILE = "file"
# One partition per ingest batch, the file key as a column: the number of partitions does not
# grow with the number of files.
BY_BATCH = "batch"


@dataclass(frozen=True)
class Dataset:
    """One kind of landing files and the table made from them."""

    source: str
    name: str
    landing: str
    bronze: str
    pattern: str = "*.json"
    format: str = "json"  # json, jsonl or csv
    prefix: str = ""
    serialize_lists: bool = True
    layout: str = BY_FILE
    schema: str | None = None  # DDL to start from, before the first files are seen
    state: str = ""
    grace: float = 0.0  # seconds for which rows that were replaced or moved stay, for readers that have opened them

    @property
    def lines(self) -> bool:
        return self.format == "jsonl"

    @property
    def partition(self) -> str:
        return FILE_KEY if self.layout == BY_FILE else INGEST_BATCH

    def below(self, base: str) -> Dataset:
        """The same dataset with paths below one base folder."""
        base = base.rstrip("/")
        return replace(
            self,
            landing=f"{base}/landing/{self.landing}",
            bronze=f"{base}/bronze/{self.bronze}",
            state=f"{base}/state/{self.source}/{self.name}",
        )


LAYERS = ("landing", "bronze", "silver", "gold")

# Source names, dataset names, landing folders, file patterns and prefixes.
_OPEN = "open_data/data"
DATASETS = (
    Dataset("open_data", "competitions", _OPEN, f"{_OPEN}/competitions", "competitions.json"),
    Dataset("open_data", "matches", f"{_OPEN}/matches", f"{_OPEN}/matches", "*/*.json", prefix="matches", layout=BY_BATCH),
    Dataset("open_data", "lineups", f"{_OPEN}/lineups", f"{_OPEN}/lineups", prefix="lineups", layout=BY_BATCH),
    Dataset("open_data", "events", f"{_OPEN}/events", f"{_OPEN}/events", prefix="events", layout=BY_BATCH),
    Dataset(
        "open_data", "three-sixty", f"{_OPEN}/three-sixty", f"{_OPEN}/three-sixty", prefix="events_three_sixty",
        layout=BY_BATCH,
    ),
    Dataset("j1_league", "matches", "j1_league/sb-matches", "j1_league/matches", "sb_matches.json"),
    Dataset("j1_league", "events", "j1_league/sb-events", "j1_league/events", "sb_events.json"),
    Dataset("j1_league", "physical", "j1_league/hudl-physical", "j1_league/physical", "hudl_physical.json"),
    Dataset("j1_league", "mappings", "j1_league/mappings", "j1_league/mappings", "*.csv", format="csv"),
)
SOURCES = tuple(dict.fromkeys(dataset.source for dataset in DATASETS))


def datasets_of(source: str) -> list[Dataset]:
    found = [dataset for dataset in DATASETS if dataset.source == source]
    if not found:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(SOURCES)}")
    return found


def dataset(source: str, name: str) -> Dataset:
    for candidate in datasets_of(source):
        if candidate.name == name:
            return candidate
    raise ValueError(f"unknown dataset {name!r} of source {source!r}")
