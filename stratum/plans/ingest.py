"""Landing files to bronze tables: incremental, per dataset, with per-file outcomes."""

from __future__ import annotations

import logging
import math
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from .. import files
from ..functions.paths import decoded_path, output_name, without_extension
from ..operators.columns import (
    SCALAR_PART, ColumnCollisionError, check_names, flat_columns, flatten_structs, lists_as_text, normalize_column_names,
    normalized_names, quoted,
)
from ..operators.freshness import FRESH, NEW, SOURCE_MISSING, STALE, freshness_plan
from ..operators.rows import concat_vertical
from ..operators.schema import leaf_paths, name_clashes, with_mixed, without_fields, without_paths
from ..operators.summary import batch_summary
from ..session import larger_tasks, opening_paths, session_conf, shared_dir, small_files
from ..sinks.parquet import drop_partitions, finish_replacement, write_new_partitions, write_partitions, write_pending, write_table
from ..sources.delimited import CsvLayout, layout_of, layout_table, survey
from ..sources.documents import (
    CORRUPT, LARGEST_CHECKED_FILE, SOURCE_PATH, check_documents, infer_documents, mixed_fields,
    open_texts, records, scan_documents,
)
from ..sources.structure import check_structure
from ..sources.listing import LISTING_CONF, hidden_files, list_files, open_folder, zero_byte_files
from .commits import RunLog
from .manifest import (
    EMPTY, ERROR, MOVED, PROCESSED, append_manifest, batch_counts, checkpoint_manifest, current_entries, current_outputs, load_schema, read_manifest,
    replaced_outputs, save_schema, stage,
)
from .reconcile import TEXT_LIKE, field_names, reconcile, text_like_names
from .spec import BY_BATCH, BY_FILE, FILE_KEY, INGEST_BATCH, Dataset

log = logging.getLogger(__name__)

SKIPPED = "skipped"

# Bounds of one ingest batch. The driver holds the paths of one batch at a time, never of the
# whole landing area; a crash repeats one batch.
MAX_FILES = 50_000
MAX_BYTES = 2**40

# A batch is compacted when this share of the files ever read into it has been read again since.
DEAD_SHARE = 0.25

# Layouts written at a time, and the column that deals their rows out by file.
CSV_JOBS = 8
CSV_FILE = "__csv_file"

# Spark never cuts files up to its opening cost, 4 MB.
SMALL_FILE = 4 * 2**20
TASK_BYTES = 2**30


class ConcurrentRunError(RuntimeError):
    """Another run is writing what this one would have to convert."""


class SchemaDriftError(RuntimeError):
    """New files do not fit the dataset's schema, and the run was asked not to widen it."""


@dataclass
class Run:
    """One run over one dataset."""

    spark: SparkSession
    dataset: Dataset
    overwrite: bool = False
    strict: bool = False
    max_files: int = MAX_FILES
    max_bytes: int = MAX_BYTES
    on_progress: Callable[[dict[str, int]], None] | None = None
    id: int = field(default_factory=lambda: time.time_ns() // 1_000)
    good: tuple[int, list[tuple[str, int]]] | None = None
    texts: tuple[list[str], DataFrame] | None = None

    def __post_init__(self) -> None:
        self.scratch = shared_dir(self.spark, f"{self.dataset.source}-{self.dataset.name}")
        self.root = files.path_part(self.spark, self.dataset.landing)
        self.log = RunLog(self.spark, self.dataset.state, self.id)
        self.apart: set[int] = set()

    def key_of(self, path: Column) -> Column:
        """File key of a decoded path below the landing folder."""
        relative = F.substring(path, len(self.root) + 2, 2**31 - 1)
        return output_name(without_extension(relative, self.dataset.pattern), self.dataset.prefix)

    def make_plan(self) -> None:
        """Compare landing files with the manifest once; later steps read the stored result."""
        spark, dataset = self.spark, self.dataset
        folder = open_folder(spark, dataset.landing, dataset.pattern)
        with session_conf(spark, **LISTING_CONF):
            listed = stage(list_files(spark, dataset.landing, dataset.pattern, folder), f"{self.scratch}/listing")
        blank = zero_byte_files(spark, dataset.landing, dataset.pattern, folder, listed)
        for more in (blank, hidden_files(spark, dataset.landing, dataset.pattern)):
            listed = listed if more is None else listed.unionByName(more)
        sources = listed.withColumn("file_key", output_name(F.col("file_key"), dataset.prefix))
        outputs = current_outputs(spark, dataset).withColumnRenamed("run", "out_run")
        self.plan = stage(freshness_plan(sources, outputs, self.overwrite), f"{self.scratch}/plan")
        self.todo = self.plan.where(F.col("action").isin(NEW, STALE))
        size = self.todo.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
        self.n_files = size["n"]
        self.n_batches = max(math.ceil(size["n"] / self.max_files), math.ceil(size["bytes"] / self.max_bytes))

    def batch(self, number: int) -> DataFrame:
        slot = F.pmod(F.xxhash64("file_key"), F.lit(self.n_batches))
        return self.todo.where(slot == number)

    def tell(self) -> None:
        """After each batch: what the manifest holds of this run so far."""
        if self.on_progress:
            rows = run_progress(self.spark, self.dataset, self.id).collect()
            self.on_progress({row.status: row.n_files for row in rows})

    def summary(self) -> DataFrame:
        untouched = self.plan.where(F.col("action").isin(FRESH, SOURCE_MISSING)).select(
            F.when(F.col("action") == FRESH, SKIPPED).otherwise(SOURCE_MISSING).alias("status"),
            F.lit(None).cast("bigint").alias("n_rows"),
        )
        entries = read_manifest(self.spark, self.dataset).where((F.col("run") == self.id) & (F.col("status") != MOVED))
        done = entries.select("status", "n_rows")
        return batch_summary(untouched.unionByName(done).withColumn("dataset", F.lit(self.dataset.name)))


def run_progress(spark: SparkSession, dataset: Dataset, run: int | None = None) -> DataFrame:
    """``run, status, n_files, n_rows`` noted so far by a run, or by all runs that hold a lease now; a run notes each batch when it is done."""
    entries = read_manifest(spark, dataset).where(F.col("status") != MOVED)
    runs = [run] if run is not None else RunLog(spark, dataset.state, 0).live_runs()
    chosen = entries.where(F.col("run").isin(runs)) if runs else entries.limit(0)
    return chosen.groupBy("run", "status").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


def ingest_dataset(
    spark: SparkSession,
    dataset: Dataset,
    overwrite: bool = False,
    strict: bool = False,
    max_files: int = MAX_FILES,
    max_bytes: int = MAX_BYTES,
    on_progress: Callable[[dict[str, int]], None] | None = None,
) -> DataFrame:
    """Read the new and changed landing files of a dataset into its bronze table.

    Returns ``dataset, status, n_files, n_rows``. A malformed file is recorded as ``error`` and
    keeps its last good output; it never stops the others, and neither does one whose field names clash with the dataset's.
    ``overwrite`` reads all files again; ``strict`` refuses to change the table's schema. Runs of one dataset may overlap:
    each adds what it read, and of a file that two have read the later run's rows count. ``on_progress`` is called with the files per
    status so far whenever a batch of at most ``max_files`` has been noted; ``run_progress`` tells the same to anyone who asks during a run.
    """
    run = Run(spark, dataset, overwrite, strict, max_files, max_bytes, on_progress)
    with run.log.lease():
        if dataset.format == "csv":
            run.make_plan()
            _ingest_csv(run)
        else:
            _ingest_json(run)
        return run.summary()


# --- JSON ---------------------------------------------------------------------------------


def _ingest_json(run: Run) -> None:
    spark, dataset = run.spark, run.dataset
    with run.log.commit():
        known, unseen, version = load_schema(spark, dataset)
        _recover(run, version)
    run.make_plan()
    if not run.n_files:
        return
    for number in range(run.n_batches):
        _check_batch(run, number)
    schema = _batch_schemas(run, known, unseen)
    fresh_table = not files.exists(spark, dataset.bronze)
    if schema.fields and (schema != known or unseen):
        # Until the run is through, no column counts as never having had a value.
        schema = _adopt_schema(run, known, schema)
    state = _Columns(schema, unseen, known)
    for number in range(run.n_batches):
        _ingest_batch(run, number, state, lone_batch=fresh_table and run.n_batches == 1)
    with run.log.commit():
        # A field that another run may have filled meanwhile counts as seen.
        if state.unseen and not _others_wrote(run):
            save_schema(spark, dataset, time.time_ns() // 1_000, state.schema, state.unseen)
        batches = _compact(run) if dataset.layout == BY_BATCH else []
        checkpoint_manifest(spark, dataset, {b.ingest_batch for b in batches}, run.id)


def _others_wrote(run: Run) -> bool:
    others = [other for other in run.log.live_runs() if other != run.id]
    if others:
        return True
    since = F.timestamp_micros(F.lit(run.id))
    entries = read_manifest(run.spark, run.dataset).where((F.col("run") != run.id) & (F.col("recorded_at") >= since))
    return entries.limit(1).count() > 0


@dataclass
class _Columns:
    """The dataset's schema and which of its text-like fields never had a value."""

    schema: T.StructType
    known_unseen: set[str]
    known: T.StructType | None

    def __post_init__(self) -> None:
        before = field_names(self.known) if self.known else set()
        self.unseen = {n for n in self.names() if n in self.known_unseen or n not in before}

    def fields(self) -> list[tuple[str, str, T.DataType]]:
        """Dotted name, table name and type of the columns whose content has to be watched."""
        dotted = [name for name, _ in flat_columns(self.schema)]
        table = _table_schema_of(self.schema)
        columns = zip(dotted, table.fields, strict=True)
        return [(d, f.name, f.dataType) for d, f in columns if f.dataType in TEXT_LIKE]

    def names(self) -> set[str]:
        return {dotted for dotted, _, _ in self.fields()}

    def levels(self) -> list[Column]:
        """Per watched column: 0 never a value, 1 values, 2 values that look like objects."""
        measures = []
        for _, name, kind in self.fields():
            value = quoted(name)
            if isinstance(kind, T.ArrayType):
                level = F.when(F.exists(value, lambda item: item.isNotNull()), 1)
            else:
                level = F.when(value.startswith("{") & value.endswith("}"), 2).when(value.isNotNull(), 1)
            measures.append(F.max(F.coalesce(level, F.lit(0))).alias(name))
        return measures


def _table_schema_of(schema: T.StructType) -> T.StructType:
    """Schema of the flat table for a record schema; planning only, no data is touched."""
    check_names(schema)
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    return normalize_column_names(flatten_structs(spark.createDataFrame([], schema))).schema


def _check_batch(run: Run, number: int) -> None:
    """Store the state of every file of one batch: ok, empty or error."""
    batch = run.batch(number)
    size = F.col("length")
    small = (size > 0) if run.dataset.lines else (size > 0) & (size <= LARGEST_CHECKED_FILE)
    found = []
    paths = [r.path for r in batch.where(small).select("path").toLocalIterator()]
    if paths:
        run.texts = sorted(paths), open_texts(run.spark, paths, run.dataset.lines)
        found.append(check_documents(run.texts[1], run.dataset.lines))
    # The same question by pieces, for documents that no text value holds.
    large = [r.path for r in batch.where((size > 0) & ~small).select("path").toLocalIterator()]
    if large:
        found.append(check_structure(run.spark, large))
    if found:
        states = concat_vertical(*found).select(run.key_of(F.col("path_part")).alias("file_key"), "state")
        batch = batch.join(states, "file_key", "left")
    else:
        batch = batch.withColumn("state", F.lit(None).cast("string"))
    write_table(batch.withColumn("state", F.coalesce("state", F.lit("error"))), f"{run.scratch}/checked-{number}")


def _checked(run: Run, number: int) -> DataFrame:
    return run.spark.read.parquet(f"{run.scratch}/{'apart' if number in run.apart else 'checked'}-{number}")


def _good_files(run: Run, number: int) -> list[tuple[str, int]]:
    """Path and length of the readable files of one batch; only one batch is kept at a time."""
    if run.good is None or run.good[0] != number:
        good = _checked(run, number).where("state = 'ok'").select("path", "length")
        run.good = number, [(row.path, row.length) for row in good.toLocalIterator()]
    return run.good[1]


def _good_paths(run: Run, number: int, large: bool) -> list[str]:
    unchecked = LARGEST_CHECKED_FILE if not run.dataset.lines else float("inf")
    return [path for path, length in _good_files(run, number) if large == (length > unchecked)]


def _task_sizes(run: Run, number: int) -> dict[str, str]:
    """Scan settings for one batch: large tasks, and no file cut into several.

    Tasks may take up to 1 GB of landing text, so that the Parquet files they write are not
    tiny; Spark still makes smaller ones as long as cores are free. A whole document is one
    record: a second task on it would only read on to the end of the file to find no record
    start, so tasks are at least as large as the largest file.
    """
    lengths = [length for _, length in _good_files(run, number)]
    if run.dataset.lines or not lengths or max(lengths) <= SMALL_FILE:
        return {"spark__sql__files__maxPartitionBytes": str(TASK_BYTES)}
    largest = max(lengths) + SMALL_FILE
    return {
        "spark__sql__files__maxPartitionBytes": str(max(largest, TASK_BYTES)),
        "spark__sql__files__minPartitionNum": str(max(1, min(sum(lengths) // largest, _cores(run.spark)))),
    }


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _batch_schemas(run: Run, known: T.StructType | None, unseen: set[str]) -> T.StructType:
    dataset = run.dataset
    declare = lists_as_text if dataset.serialize_lists else lambda schema: schema
    parts = [(number, large) for number in range(run.n_batches) for large in (False, True)]
    inferred = _inferred(run, parts)
    apart = _set_clashes_apart(run, known, [schema for _, schema in inferred])
    if apart:
        # Files with other names are errors now; what is left has at most nulls under those names.
        inferred = [(part, without_paths(schema, apart)) for part, schema in _inferred(run, parts)]
    seen = []
    for part, schema in inferred:

        def second_look(schema: T.StructType, names: list[str], part: tuple[int, bool] = part) -> T.StructType:
            paths = _good_paths(run, *part)
            valued = field_names(_infer(run, paths, part[1], drop_null=True))
            schema = without_fields(schema, set(names) - valued)
            texts = [name for name, _, _ in _Columns(schema, set(), None).fields() if name in names and name in valued]
            return with_mixed(schema, _probe(run, part, schema, texts)) if texts else schema

        seen.append((declare(schema), second_look))
    return reconcile(known, unseen, seen)


def _inferred(run: Run, parts: list[tuple[int, bool]]) -> list[tuple[tuple[int, bool], T.StructType]]:
    return [(part, _infer(run, paths, part[1])) for part in parts if (paths := _good_paths(run, *part))]


def _set_clashes_apart(run: Run, known: T.StructType | None, schemas: list[T.StructType]) -> set[tuple[str, ...]]:
    """Make the files errors whose field names clash with the dataset's; returns the leaves that the dataset does without.

    Of names that would be one column, that of the stored schema counts, else the one with values in most files, then the
    first in order. Files with values under another of them are set aside, and only those: what a file's names are is found by one
    scan of the doubtful fields, one row per file.
    """
    spark = run.spark
    held = set(leaf_paths(known)) if known else set()
    reserved = {FILE_KEY, INGEST_BATCH}
    groups = name_clashes(held.union(*map(leaf_paths, schemas)), reserved)
    if not groups:
        return set()
    paths = [path for group in groups for path in group]
    tops = T.StructType([T.StructField(name, T.StringType()) for name in sorted({path[0] for path in paths})])
    flags = []
    with session_conf(spark, spark__sql__caseSensitive="true"):
        for number in range(run.n_batches):
            small, large = _good_paths(run, number, False), _good_paths(run, number, True)
            if small or large:
                scan = scan_documents(spark, small, tops, run.dataset.lines, large)
                has = [F.max(_value_at(path).isNotNull()).alias(f"v{i}") for i, path in enumerate(paths)]
                flags.append(scan.groupBy(run.key_of(F.col(SOURCE_PATH)).alias("file_key")).agg(*has))
        marks = stage(concat_vertical(*flags), f"{run.scratch}/names")
    counts = marks.agg(*[F.count_if(f"v{i}").alias(f"v{i}") for i in range(len(paths))]).first()
    files_with = {path: counts[f"v{i}"] for i, path in enumerate(paths)}
    losers = set()
    for group in groups:
        best = min(group, key=lambda path: (path not in held, -files_with[path], path))
        is_reserved = ".".join(group[0]).replace(".", "_").lower() in reserved
        losers |= {path for path in group if is_reserved or path != best}
    log.warning("field names that clash with the dataset's: %s", ", ".join(sorted(".".join(path) for path in losers)))
    clash = F.lit(False)
    for i, path in enumerate(paths):
        clash = clash | F.col(f"v{i}") if path in losers else clash
    bad = marks.where(clash).select("file_key", F.lit(True).alias("clash"))
    for number in range(run.n_batches):
        checked = _checked(run, number).join(bad, "file_key", "left")
        state = F.when(F.col("clash"), "error").otherwise(F.col("state"))
        write_table(checked.withColumn("state", state).drop("clash"), f"{run.scratch}/apart-{number}")
        run.apart.add(number)
    run.good = run.texts = None
    return losers


def _value_at(path: tuple[str, ...]) -> Column:
    """The text at a path of field names, of a record whose top-level fields are texts."""
    value = quoted(path[0])
    if len(path) == 1:
        return value
    kind: T.DataType = T.StringType()
    for name in reversed(path[1:]):
        kind = T.StructType([T.StructField(name, kind)])
    value = F.from_json(value, kind)
    for name in path[1:]:
        value = value.getField(name)
    return value


def _infer(run: Run, paths: list[str], large: bool, drop_null: bool = False) -> T.StructType:
    """Schema of some files; where the check has just opened exactly these, they are not looked up again."""
    opened = run.texts[1] if run.texts and run.texts[0] == sorted(paths) and not run.dataset.lines else None
    return infer_documents(run.spark, paths, run.dataset.lines, drop_null, streamed=large, texts=opened)


def _scan(run: Run, number: int, schema: T.StructType) -> DataFrame:
    small, large = _good_paths(run, number, False), _good_paths(run, number, True)
    return scan_documents(run.spark, small, schema, run.dataset.lines, large)


def _probe(run: Run, part: tuple[int, bool | None], schema: T.StructType, names: list[str]) -> dict[str, dict]:
    number, large = part
    small = [] if large else _good_paths(run, number, False)
    streamed = [] if large is False else _good_paths(run, number, True)
    with session_conf(run.spark, **_task_sizes(run, number)):
        return mixed_fields(run.spark, small, schema, names, run.dataset.lines, streamed)


def _adopt_schema(run: Run, known: T.StructType | None, schema: T.StructType) -> T.StructType:
    """Make ``schema`` the dataset's schema, converting stored columns whose type changes; returns it.

    If another run has changed the schema since this one began, both changes are kept.
    """
    with run.log.commit():
        latest, unseen, _ = load_schema(run.spark, run.dataset)
        if latest is not None and latest != known:
            schema = reconcile(latest, unseen, [(schema, lambda own, names: own)])
            known = latest
        _change_schema(run, known, schema)
    return schema


def _change_schema(run: Run, known: T.StructType | None, schema: T.StructType) -> None:
    """Save ``schema``; stored columns whose type changes are converted through a written copy.

    Added columns need no rewrite: files without them read as null under the stored schema.
    """
    spark, dataset = run.spark, run.dataset
    new = {f.name: f.dataType for f in _table_schema_of(schema).fields}
    clash = {name.lower() for name in new} & {FILE_KEY, INGEST_BATCH}
    if clash:
        raise ColumnCollisionError(f"field names reserved for the table: {', '.join(sorted(clash))}")
    old = {f.name: f.dataType for f in _table_schema_of(known).fields} if known else {}
    changed = {name: new[name] for name, kind in old.items() if name in new and new[name] != kind}
    if run.strict and known is not None and schema != known:
        added = sorted(set(new) - set(old))
        kinds = [f"{name}: {old[name].simpleString()} to {kind.simpleString()}" for name, kind in sorted(changed.items())]
        raise SchemaDriftError(f"{dataset.source}/{dataset.name}: new columns {added}, changed types {kinds}")
    version = time.time_ns() // 1_000
    pending = f"{dataset.state}/pending-types-{version}"
    rewrite = bool(changed) and files.exists(spark, dataset.bronze)
    if rewrite and dataset.layout == BY_FILE and run.log.live_runs() != [run.id]:
        raise ConcurrentRunError(f"{dataset.source}/{dataset.name}: columns change their type while another run writes to the table")
    if rewrite:
        table = read_bronze(spark, dataset, keys=True)
        columns = [quoted(n).cast(changed[n]).alias(n) if n in changed else quoted(n) for n in table.columns]
        write_pending(table.select(*columns), pending, dataset.partition)
    save_schema(spark, dataset, version, schema, set())
    if rewrite:
        finish_replacement(spark, dataset.bronze, dataset.partition, pending)


def _recover(run: Run, version: int | None) -> None:
    """Finish or discard what an interrupted run left behind."""
    spark, dataset = run.spark, run.dataset
    if not files.exists(spark, dataset.state):
        return
    for path in files.children(spark, dataset.state):
        name = path.rsplit("/", 1)[-1]
        if name == f"pending-types-{version}":
            finish_replacement(spark, dataset.bronze, dataset.partition, path)
        elif name.startswith("pending-"):
            files.delete(spark, path)  # written inside a commit, which is this run's now
    if dataset.layout == BY_BATCH:
        _drop_dead_batches(run, batch_counts(spark, dataset))


def _ingest_batch(run: Run, number: int, state: _Columns, lone_batch: bool) -> None:
    spark, dataset = run.spark, run.dataset
    checked = _checked(run, number)
    batch_id = run.id * 1_000 + number
    n_corrupt = 0
    if _good_files(run, number) and state.schema.fields:
        levels, n_corrupt = _write_records(run, number, state, batch_id)
        mixed = _find_mixed(run, number, state, levels)
        if mixed:
            if lone_batch and run.log.live_runs() == [run.id]:
                files.delete(spark, dataset.bronze)  # holds this batch only, about to be written again
            else:
                # Earlier rows of the column are text already, of whatever kind.
                mixed = {name: {**parts, SCALAR_PART: "string"} for name, parts in mixed.items()}
            state.schema = _adopt_schema(run, state.schema, with_mixed(state.schema, mixed))
            levels, n_corrupt = _write_records(run, number, state, batch_id)
        state.unseen = {n for n in state.unseen & state.names() if not levels.get(n)}
    bad = None
    if n_corrupt:
        scan = _scan(run, number, state.schema).where(F.col(CORRUPT).isNotNull())
        first = quoted(state.schema.fields[0].name)
        # Counting a data column keeps it in the scan: Spark refuses to read the marker alone.
        bad = scan.groupBy(run.key_of(F.col(SOURCE_PATH)).alias("file_key")).agg(F.count(first).alias("bad"))
    _commit_batch(run, checked, state, bad, batch_id)


def _commit_batch(run: Run, checked: DataFrame, state: _Columns, bad: DataFrame | None, batch_id: int) -> None:
    with run.log.commit():
        _follow_schema(run, checked, state, batch_id)
        _record(run, checked, bad, batch_id)
    run.tell()


def _follow_schema(run: Run, checked: DataFrame, state: _Columns, batch_id: int) -> None:
    """Convert the rows just written if another run has changed the types of their columns meanwhile."""
    spark, dataset = run.spark, run.dataset
    latest, _, _ = load_schema(spark, dataset)
    if latest is None or latest == state.schema or not state.schema.fields:
        return
    own, now = _table_schema_of(state.schema), {f.name: f.dataType for f in _table_schema_of(latest).fields}
    changed = {f.name: now[f.name] for f in own.fields if f.name in now and now[f.name] != f.dataType}
    state.schema = latest
    path = dataset.bronze if dataset.layout == BY_FILE else f"{dataset.bronze}/{INGEST_BATCH}={batch_id}"
    if not changed or not files.exists(spark, path):
        return
    rows = spark.read.schema(T.StructType([*own.fields, T.StructField(FILE_KEY, T.StringType())])).parquet(path)
    if dataset.layout == BY_FILE:
        rows = rows.join(checked.where("state = 'ok'").select(FILE_KEY), FILE_KEY, "left_semi")
    columns = [quoted(n).cast(changed[n]).alias(n) if n in changed else quoted(n) for n in rows.columns]
    kept = stage(rows.select(*columns), f"{run.scratch}/converted-{batch_id}")
    if dataset.layout == BY_FILE:
        write_partitions(kept, dataset.bronze, FILE_KEY)
    else:
        write_table(kept, path)


def _write_records(run: Run, number: int, state: _Columns, batch_id: int) -> tuple[dict[str, int], int]:
    """Scan, flatten and write one batch in a single pass; returns what was seen on the way.

    Every file is read whole by one task, so its rows are together and no shuffle is needed.
    """
    dataset = run.dataset
    broken, content = Observation(), Observation()
    scan = _scan(run, number, state.schema)
    scan = scan.observe(broken, F.count(F.col(CORRUPT)).alias("n"))
    key = run.key_of(F.col(SOURCE_PATH)).alias(FILE_KEY)
    table = records(scan)
    watched = state.levels()
    table = table.observe(content, *watched) if watched else table
    columns = [quoted(name) for name in table.columns if name != SOURCE_PATH]
    table = table.select(*columns, key)
    with session_conf(run.spark, **_task_sizes(run, number)):
        if dataset.layout == BY_FILE:
            write_partitions(table, dataset.bronze, FILE_KEY)
        else:
            write_table(table, f"{dataset.bronze}/{INGEST_BATCH}={batch_id}")
    found = content.get if watched else {}
    return {dotted: found.get(name) or 0 for dotted, name, _ in state.fields()}, broken.get["n"] or 0


def _find_mixed(run: Run, number: int, state: _Columns, levels: dict[str, int]) -> dict[str, dict]:
    """Text columns of this batch that turn out to hold objects as well."""
    plain = text_like_names(state.schema)
    suspects = [name for name, level in levels.items() if level == 2 and name in plain]
    return _probe(run, (number, None), state.schema, suspects) if suspects else {}


def _record(run: Run, checked: DataFrame, bad: DataFrame | None, batch_id: int) -> None:
    """Note the outcome of every file of the batch.

    In batch layout this entry is what makes the new rows visible and the former ones invisible.
    """
    dataset = run.dataset
    outcome = checked
    outcome = outcome.join(bad, "file_key", "left") if bad is not None else outcome.withColumn("bad", F.lit(None))
    status = (
        F.when(F.col("bad").isNotNull() | (F.col("state") == "error"), ERROR)
        .when(F.col("state") == "empty", EMPTY)
        .otherwise(PROCESSED)
    )
    counts = _row_counts(run, batch_id)
    entries = (
        outcome.withColumn("status", status)
        .join(counts, "file_key", "left")
        .withColumn("n_rows", F.when(F.col("status") == PROCESSED, F.coalesce("n_rows", F.lit(0))).otherwise(F.lit(0)))
        .withColumn("ingest_batch", F.when(F.col("status") == PROCESSED, F.lit(batch_id)))
        .withColumn("run", F.lit(run.id))
    )
    entries = stage(entries, f"{run.scratch}/entries-{batch_id}")
    if dataset.layout == BY_FILE:
        _drop_emptied_files(run, entries)
    append_manifest(entries, dataset)


def _row_counts(run: Run, batch_id: int) -> DataFrame:
    spark, dataset = run.spark, run.dataset
    path = dataset.bronze if dataset.layout == BY_FILE else f"{dataset.bronze}/{INGEST_BATCH}={batch_id}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], "file_key string, n_rows bigint")
    rows = spark.read.schema("file_key string").parquet(path)
    return rows.groupBy("file_key").agg(F.count(F.lit(1)).alias("n_rows"))


def _drop_emptied_files(run: Run, entries: DataFrame) -> None:
    emptied = entries.where((F.col("status") == EMPTY) & F.col("out_mtime").isNotNull()).select("file_key")
    keys = [row.file_key for row in emptied.toLocalIterator()]
    if keys and files.exists(run.spark, run.dataset.bronze):
        table = run.spark.read.schema("file_key string").parquet(run.dataset.bronze)
        drop_partitions(table.where(F.col("file_key").isin(keys)))


def _compact(run: Run) -> list[Row]:
    """Move the current rows of batches that are largely dead into a batch of their own, and remove what is dead.

    The move is an entry in the manifest as well: before it the copy is invisible, after it the
    originals are, so a crash at any point loses and doubles nothing, and readers see every row once.
    """
    spark, dataset = run.spark, run.dataset
    batches = batch_counts(spark, dataset)
    worn = [b.ingest_batch for b in batches if b.n_current and b.n_files - b.n_current >= DEAD_SHARE * b.n_files]
    if worn and files.exists(spark, dataset.bronze):
        moved_to = time.time_ns() // 1_000 * 1_000
        table = read_bronze(spark, dataset, keys=True).where(F.col(INGEST_BATCH).isin(worn)).drop(INGEST_BATCH)
        write_table(table, f"{dataset.bronze}/{INGEST_BATCH}={moved_to}")
        held = current_entries(spark, dataset).where(F.col(INGEST_BATCH).isin(worn))
        held = held.withColumn("status", F.lit(MOVED)).withColumn("run", F.lit(run.id)).withColumn(INGEST_BATCH, F.lit(moved_to))
        append_manifest(stage(held, f"{run.scratch}/moved"), dataset)
        batches = batch_counts(spark, dataset)
    gone = _drop_dead_batches(run, batches)
    return [b for b in batches if b.ingest_batch not in gone]


def _drop_dead_batches(run: Run, batches: list[Row]) -> set[int]:
    """Delete the batches that hold the current rows of no file, except those that a live run may be writing and those within their grace."""
    spark, dataset = run.spark, run.dataset
    gone: set[int] = set()
    if not files.exists(spark, dataset.bronze):
        return gone
    oldest = run.log.oldest_live() * 1_000
    recent = datetime.now() - timedelta(seconds=dataset.grace)
    kept = {b.ingest_batch for b in batches if b.n_current or (dataset.grace and b.left_at and b.left_at >= recent)}
    for path in files.children(spark, dataset.bronze):
        name = path.rsplit("/", 1)[-1]
        if name.startswith(f"{INGEST_BATCH}="):
            batch = int(name.removeprefix(f"{INGEST_BATCH}="))
            # A live run's own batches are numbered from its id on; noted ones are judged by the manifest, whoever wrote them.
            noted = any(b.ingest_batch == batch for b in batches)
            if batch not in kept and (noted or batch < oldest):
                files.delete(spark, path)
                gone.add(batch)
    return gone


def _stored(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """Everything in the table's folder, under the dataset's schema."""
    schema, _, _ = load_schema(spark, dataset)
    if schema is None:
        raise FileNotFoundError(f"{dataset.source}/{dataset.name} has not been ingested")
    table = T.StructType([*_table_schema_of(schema).fields, T.StructField(FILE_KEY, T.StringType())])
    if dataset.layout == BY_BATCH:
        table = table.add(INGEST_BATCH, T.LongType())
    if not files.exists(spark, dataset.bronze):
        return spark.createDataFrame([], table)
    return spark.read.schema(table).parquet(dataset.bronze)


def read_bronze(spark: SparkSession, dataset: Dataset, keys: bool = False, version: int | None = None) -> DataFrame:
    """The bronze table of a dataset. ``file_key`` is kept; ``keys`` also keeps the batch column.

    ``version``, a run's id, gives the table as that run left it, under today's schema, as long as the dataset's ``grace`` keeps the rows (batch layout).

    In batch layout the manifest says which rows count: those of the batch that a file was last
    read into. Rows are only compared with it where a batch holds rows that a later read replaced.
    """
    if dataset.format == "csv":
        raise ValueError("every CSV file is a table of its own; read one with parquet_table, all with read_csv_tables")
    df = _stored(spark, dataset)
    if version is not None and dataset.layout != BY_BATCH:
        raise ValueError("only tables in batch layout keep earlier versions")
    if dataset.layout == BY_BATCH:
        batches = batch_counts(spark, dataset, version)
        df = df.where(F.col(INGEST_BATCH).isin([b.ingest_batch for b in batches if b.n_current]))
        mixed = [b.ingest_batch for b in batches if 0 < b.n_current < b.n_files]
        if mixed:
            dead = replaced_outputs(spark, dataset, version).where(F.col(INGEST_BATCH).isin(mixed))
            df = df.join(dead, [FILE_KEY, INGEST_BATCH], "left_anti").select(*[quoted(name) for name in df.columns])
        df = df if keys else df.drop(INGEST_BATCH)
    return df


# --- CSV ----------------------------------------------------------------------------------


def csv_table_path(dataset: Dataset, file_key: str) -> str:
    return f"{dataset.bronze}/{file_key}.parquet"


def read_csv_tables(spark: SparkSession, dataset: Dataset, columns: str) -> DataFrame:
    """The tables of all CSV files of a dataset under one schema (DDL) and ``file_key``; a column that a table lacks is null."""
    schema = T.StructType.fromDDL(columns)
    if not files.exists(spark, dataset.bronze):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(FILE_KEY, T.StringType())]))
    with opening_paths(spark):
        rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(dataset.bronze)
    relative = F.substring(decoded_path(F.col("_metadata.file_path")), len(files.path_part(spark, dataset.bronze)) + 2, 2**31 - 1)
    return larger_tasks(rows.select("*", F.regexp_extract(relative, r"^(.*)\.parquet/[^/]*$", 1).alias(FILE_KEY)))


def _ingest_csv(run: Run) -> None:
    """One table per file, as the columns differ from file to file; jobs go by layout, not by file."""
    for number in range(run.n_batches):
        # The outcomes of one batch are noted before the next begins: a crash repeats one batch.
        _ingest_csv_batch(run, number)
        run.tell()
    with run.log.commit():
        checkpoint_manifest(run.spark, run.dataset, set(), run.id)


def _ingest_csv_batch(run: Run, number: int) -> None:
    spark, scratch = run.spark, f"{run.scratch}/csv-{number}"
    batch = run.batch(number)
    paths = [row.path for row in batch.where("length > 0").select("path").toLocalIterator()]
    if not paths:
        append_manifest(stage(_csv_entries(run, batch.withColumn("status", F.lit(ERROR)).withColumn("n_rows", F.lit(0).cast("bigint"))), f"{scratch}/entries"), run.dataset)
        return
    # Tasks take many small files each.
    with session_conf(spark, spark__sql__files__maxPartitionBytes=str(TASK_BYTES)), small_files(spark):
        seen = survey(spark, paths, scratch)
    fits = seen.where("not too_long")
    layouts: dict[CsvLayout, list[tuple[str, int]]] = {}
    for row in fits.select("path_part", "names", "unnamed", "kinds", "n_rows").toLocalIterator():
        layouts.setdefault(layout_of(row.names, row.unnamed, row.kinds), []).append((row.path_part, row.n_rows))
    by_part = {files.plain_part(spark, path): path for path in paths}
    by_types: dict[tuple, list] = {}
    for layout, some in layouts.items():
        by_types.setdefault((layout.names, layout.unnamed, tuple(layout.types)), [layout, []])[1].extend(some)
    # A layout whose names clash makes its own files errors.
    rejected = []
    for key in [*by_types]:
        try:
            normalized_names(list(key[0]))
        except ColumnCollisionError as clash:
            log.warning("%d CSV files rejected: %s", len(by_types[key][1]), clash)
            rejected += [(part,) for part, _ in by_types.pop(key)[1]]
    # A task makes folders of its own besides those of its files.
    with session_conf(spark, spark__sql__files__maxPartitionBytes=str(TASK_BYTES)), small_files(spark), ThreadPoolExecutor(CSV_JOBS) as pool:
        work = [pool.submit(_write_csv_layout, run, f"{scratch}/table-{i}", layout, some, by_part) for i, (layout, some) in enumerate(by_types.values())]
        for done in work:
            done.result()  # what fails here is no file's own fault
    refused = spark.createDataFrame(rejected, "path_part string").withColumn("refused", F.lit(True))
    found = seen.join(refused, "path_part", "left").select(run.key_of(F.col("path_part")).alias("file_key"), "n_rows", (F.col("too_long") | F.col("refused").isNotNull()).alias("bad"))
    outcome = batch.join(found, "file_key", "left")
    bad = F.coalesce("bad", F.lit(True))
    status = F.when(bad, ERROR).when(F.col("n_rows") == 0, EMPTY).otherwise(PROCESSED)
    rows = F.when(bad, F.lit(0)).otherwise(F.col("n_rows")).cast("bigint")
    append_manifest(stage(_csv_entries(run, outcome.withColumn("status", status).withColumn("n_rows", rows)), f"{scratch}/entries"), run.dataset)


def _csv_entries(run: Run, outcome: DataFrame) -> DataFrame:
    return outcome.select("file_key", "path", "src_mtime", "length", "status", "n_rows", F.lit(None).cast("bigint").alias("ingest_batch"), F.lit(run.id).alias("run"))


def _write_csv_layout(run: Run, target: str, layout: CsvLayout, members: list[tuple[str, int]], by_part: dict[str, str]) -> None:
    """All files of one layout in one job, dealt out by file; then each file's folder takes its own name."""
    spark, dataset = run.spark, run.dataset
    filled = [by_part[part] for part, n_rows in members if n_rows]
    names = [quoted(name) for name in layout.names]
    if filled:
        table = layout_table(spark, filled, layout)
        plain = normalize_column_names(table.select(*names))
        keyed = table.select(*[value.alias(name) for value, name in zip(names, plain.columns, strict=True)], run.key_of(F.col("path_part")).alias(CSV_FILE))
        # A file is read whole by one task, so no shuffle gathers its rows.
        write_new_partitions(keyed, target, CSV_FILE)
        files.move_all(spark, [
            (f"{target}/{name}", csv_table_path(dataset, files.unescaped(name.removeprefix(f"{CSV_FILE}="))))
            for name in files.names(spark, target) if name.startswith(f"{CSV_FILE}=")
        ])
    blank = [part for part, n_rows in members if not n_rows]
    if blank:
        schema = T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in zip(normalized_names(list(layout.names)), layout.types, strict=True)])
        write_table(spark.createDataFrame([], schema), f"{target}-blank")
        keys = spark.createDataFrame([(part,) for part in blank], "path_part string").select(run.key_of(F.col("path_part")).alias("key"))
        files.copy_all(spark, f"{target}-blank", [csv_table_path(dataset, row.key) for row in keys.toLocalIterator()])
