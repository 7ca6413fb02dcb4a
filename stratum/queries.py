"""The registered queries and the SQL each of them has to agree with.

Every query reads whole tables. Where an operator reads files, the files are made from a table
first (``landing``), so that the work grows with the data.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import files, operators as ops
from .functions.paths import capture_int, file_stem
from .landing import as_list, as_record, prepared, write_documents, write_named, write_single_records
from .operators import head_by, project, tail_by, unique_by
from .plans import lineups
from .plans.ingest import csv_table_path, ingest_dataset, read_bronze, read_csv_tables
from .plans.layers import ingest_named, ingest_source, run_pipeline
from .plans.manifest import read_manifest
from .plans.spec import BY_BATCH, BY_FILE, FILE_KEY, Dataset, dataset
from .session import shared_dir
from .sinks.parquet import write_partitions, write_table
from .sources.delimited import read_csv
from .sources.documents import read_documents
from .sources.tables import parquet_glob, parquet_table

QUERIES = {}
ORACLE = {}


def query(sql: str):
    """Register a query under its function name, with its SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        ORACLE[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    return parquet_table(spark, f"{sf_dir}/{name}.parquet", columns)


def _event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested records."""
    events = _table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        as_record(
            F.col("event_id").alias("id"),
            F.struct(F.col("user_id").alias("id")).alias("user"),
            F.struct(F.col("event_type").alias("name")).alias("type"),
            F.from_json("props", "k bigint").alias("props"),
        ),
    )


EVENTS_SQL = """
    SELECT event_id AS id, user_id, event_type AS type_name, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k
    FROM events"""

EVENT_COLUMNS = ["id", "user_id", "type_name", "props_k"]


@query(EVENTS_SQL)
def json_ingest_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = prepared(spark, "events", sf_dir, lambda to: write_documents(_event_records(spark, sf_dir), to))
    return project(read_documents(spark, folder), EVENT_COLUMNS)


@query("SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def json_dict_as_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _table(spark, sf_dir, "supplier").select(as_record("*"))
    folder = prepared(spark, "supplier", sf_dir, lambda to: write_single_records(suppliers, to))
    return project(read_documents(spark, folder), ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", F.split("text", " ", -1).alias("words"))


WORDS_SQL = "SELECT doc_id, CAST(to_json(string_split(text, ' ')) AS VARCHAR) AS words FROM documents"


@query(WORDS_SQL)
def serialize_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir).select(as_record("doc_id", "words"))
    folder = prepared(spark, "words", sf_dir, lambda to: write_documents(words, to, per_file=50))
    return project(read_documents(spark, folder), ["doc_id", "words"])


@query(WORDS_SQL)
def serialize_parsed_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.serialize_lists(_words(spark, sf_dir))


@query(
    "SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS customer_stats_segment FROM customer"
)
def normalize_column_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    dotted = {"c_custkey": "customer.key", "c_name": "customer.name", "c_mktsegment": "customer.stats.segment"}
    return ops.normalize_column_names(customers.withColumnsRenamed(dotted))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
        o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '"' || o_orderpriority || '", ' || o_orderstatus END AS note_text,
        o_orderkey % 2 = 0 AS even
    FROM orders"""
)
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    note = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('", '), F.col("o_orderstatus"))
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.when(key % 7 == 0, "NA").otherwise(note).alias("note.text"),
        (key % 2 == 0).alias("even"),
    )
    folder = prepared(
        spark, "orders-csv", sf_dir, lambda to: orders.write.options(header=True, quote='"', escape='"').csv(to)
    )
    return ops.normalize_column_names(read_csv(spark, folder, multiline=False))


@query("SELECT doc_id, lang, source FROM documents")
def parquet_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(_table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"])


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 2 = 0 THEN l_quantity END AS l_quantity FROM lineitem"""
)
def parquet_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        lines = _table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
        even = F.col("l_orderkey") % 2 == 0
        lines.where(~even).drop("l_quantity").write.parquet(f"{folder}/a")
        lines.where(even).write.parquet(f"{folder}/b")

    folder = prepared(spark, "lineitem-parts", sf_dir, write)
    return parquet_glob(spark, f"{folder}/*/*.parquet")


@query("SELECT o_orderkey, CAST(o_custkey % 8 AS BIGINT) AS match_id FROM orders")
def file_key_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    named = orders.select(as_record("o_orderkey"), F.format_string("lineups_%d", F.col("o_custkey") % 8).alias("file"))
    folder = prepared(spark, "orders-by-file", sf_dir, lambda to: write_documents(named, to, by="file"))
    scan = read_documents(spark, folder, path_column="path")
    return scan.select("o_orderkey", capture_int(F.col("path"), r"(?i)lineups_(\d+)/").alias("match_id"))


@query(
    """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier"""
)
def concat_vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    def party(table: str, mark: str) -> DataFrame:
        columns = ["name", "nationkey", "acctbal"]
        return _table(spark, sf_dir, table, [f"{mark}_{c}" for c in columns]).toDF(*columns)

    return ops.concat_vertical(party("customer", "c"), party("supplier", "s"))


@query(
    """SELECT l_orderkey, l_suppkey, MIN(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey, l_suppkey"""
)
def unique_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber"])
    return unique_by(lines, ["l_orderkey", "l_suppkey"], ["l_linenumber"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def sort_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head_by(_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]), ["o_orderkey"])


@query(
    """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority LIKE '1%'
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 5"""
)
def filter_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    chosen = orders.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").startswith("1"))
    return tail_by(project(chosen, ["o_orderkey", "o_orderdate"]), ["o_orderdate", "o_orderkey"])


@query("SELECT COUNT(*) AS n_rows, CAST(3 AS INTEGER) AS n_cols FROM lineitem")
def shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.shape(_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]))


@query(
    """WITH src AS (SELECT o_orderkey AS k, o_orderdate AS src FROM orders WHERE o_orderkey % 7 <> 0),
        made AS (SELECT l_orderkey AS k, MIN(l_shipdate) AS made FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1)
    SELECT COALESCE(src.k, made.k) AS file_key, CASE WHEN src IS NULL THEN 'source_missing' WHEN made IS NULL THEN 'new'
        WHEN src > made THEN 'stale' ELSE 'fresh' END AS action
    FROM src FULL OUTER JOIN made ON src.k = made.k"""
)
def freshness_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"]).toDF("file_key", "src_mtime")
    lines = _table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"]).toDF("file_key", "shipped")
    outputs = lines.where(F.col("file_key") % 3 != 0).groupBy("file_key").agg(F.min("shipped").alias("out_mtime"))
    return project(ops.freshness_plan(orders.where(F.col("file_key") % 7 != 0), outputs), ["file_key", "action"])


@query(
    """SELECT event_type AS dataset, CASE WHEN event_id % 10 = 0 THEN 'error' WHEN event_id % 10 = 1 THEN 'skipped'
        ELSE 'processed' END AS status, COUNT(*) AS n_files
    FROM events GROUP BY 1, 2"""
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("event_id") % 10
    status = F.when(rest == 0, "error").when(rest == 1, "skipped").otherwise("processed").alias("status")
    return ops.batch_summary(_table(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), status))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount
    FROM lineitem"""
)
def nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_discount"])
    marked = F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount"))
    return ops.nan_to_null(lines.withColumn("l_discount", marked))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 8 < 3 THEN 'v2' ELSE 'v1' END AS version FROM orders")
def incremental_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = shared_dir(spark, "overwrite")
    orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    keyed = orders.select("o_orderkey", (F.col("o_custkey") % 8).alias("part"))
    write_partitions(keyed.withColumn("version", F.lit("v1")), target, "part", gather=True)
    write_partitions(keyed.where("part < 3").withColumn("version", F.lit("v2")), target, "part", gather=True)
    return project(parquet_table(spark, target), ["o_orderkey", "version"])


@query(
    """SELECT o_custkey % 16 AS match_id, o_orderstatus AS team_id, 'team ' || o_orderstatus AS team_name,
        MIN('[{"player":"' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '"}]') AS lineup
    FROM orders GROUP BY 1, 2, 3"""
)
def lineups_by_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(folder: str) -> None:
        orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
        lineup = F.format_string('[{"player":"%s"}]', F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
        rows = orders.select(
            F.col("o_orderstatus").alias("team_id"),
            F.concat(F.lit("team "), F.col("o_orderstatus")).alias("team_name"),
            lineup.alias("lineup"),
            F.format_string("lineups_%d", F.col("o_custkey") % 16).alias(FILE_KEY),
        )
        other = rows.select("team_id", "team_name", F.lit("[]").alias("lineup"), F.lit("lineups_x").alias(FILE_KEY))
        write_partitions(rows.unionByName(other), folder, FILE_KEY, gather=True)

    bronze = parquet_table(spark, prepared(spark, "lineups", sf_dir, write))
    target = shared_dir(spark, "lineups-by-match")
    write_table(lineups.lineups_by_match(bronze, F.concat(F.col(FILE_KEY), F.lit(".parquet"))), target, compression="zstd")
    return parquet_table(spark, target)


def _dataset(spark: SparkSession, landing: str, label: str, **settings) -> Dataset:
    """A dataset over a landing folder with a new, empty table."""
    base = shared_dir(spark, label)
    return Dataset("", label, landing, f"{base}/table", "**/*", state=f"{base}/state", **settings)


def _ingest_events(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    folder = prepared(spark, "events", sf_dir, lambda to: write_documents(_event_records(spark, sf_dir), to))
    dataset = _dataset(spark, folder, f"events-{layout}", layout=layout)
    ingest_dataset(spark, dataset)
    return project(read_bronze(spark, dataset), EVENT_COLUMNS)


@query(EVENTS_SQL)
def bronze_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_events(spark, sf_dir, BY_FILE)


@query(EVENTS_SQL)
def bronze_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_events(spark, sf_dir, BY_BATCH)


@query(
    """SELECT event_id // 500 AS doc, CASE WHEN event_id // 500 % 10 = 0 THEN 'error' ELSE 'processed' END AS status,
        CAST(CASE WHEN event_id // 500 % 10 = 0 THEN 0 ELSE COUNT(*) END AS BIGINT) AS n_rows
    FROM events GROUP BY event_id // 500"""
)
def quarantine_bad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.floor(F.col("event_id") / 500)

    def write(folder: str) -> None:
        # A record cut short in every file of a tenth of the documents.
        events = _event_records(spark, sf_dir).withColumn("doc", doc)
        cut = F.when(F.col("doc") % 10 == 0, F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
        write_documents(events.select(cut.alias("record"), "doc"), folder, by="doc")

    folder = prepared(spark, "events-broken", sf_dir, write)
    dataset = _dataset(spark, folder, "events-broken", layout=BY_BATCH)
    ingest_dataset(spark, dataset)
    files = read_manifest(spark, dataset).withColumn("doc", capture_int(F.col("file_key"), r"doc=(\d+)/"))
    return files.groupBy("doc", "status").agg(F.sum("n_rows").alias("n_rows"))


@query(
    """SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN user_id END AS v_x,
        CASE WHEN event_id % 2 = 1 THEN event_id END AS v
    FROM events"""
)
def object_or_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events", ["event_id", "user_id"])
    record = F.when(
        F.col("event_id") % 2 == 0, F.format_string('{"id":%d,"v":{"x":%d}}', F.col("event_id"), F.col("user_id"))
    ).otherwise(F.format_string('{"id":%d,"v":%d}', F.col("event_id"), F.col("event_id")))
    records = events.select(record.alias("record"))
    folder = prepared(spark, "events-mixed", sf_dir, lambda to: write_documents(records, to))
    dataset = _dataset(spark, folder, "events-mixed", layout=BY_BATCH)
    ingest_dataset(spark, dataset)
    return project(read_bronze(spark, dataset), ["id", "v_x", "v"])


@query(
    """SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) ELSE value END AS v,
        CASE WHEN event_id % 2 = 1 THEN event_type END AS n
    FROM events"""
)
def schema_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one dataset; the files of the second need a wider type and a new column."""
    even = F.col("event_id") % 2 == 0
    first_id = F.col("event_id").alias("id")

    def write(folder: str) -> None:
        events = _table(spark, sf_dir, "events", ["event_id", "value", "event_type"])
        whole = events.where(even).select(as_record(first_id, F.col("event_id").alias("v")))
        wider = events.where(~even).select(as_record(first_id, F.col("value").alias("v"), F.col("event_type").alias("n")))
        write_documents(whole, f"{folder}/run1")
        write_documents(wider, f"{folder}/run2")

    folder = prepared(spark, "events-wider", sf_dir, write)
    dataset = _dataset(spark, folder, "events-wider", layout=BY_BATCH)
    ingest_dataset(spark, replace(dataset, pattern="run1/*"))
    ingest_dataset(spark, dataset)
    return project(read_bronze(spark, dataset), ["id", "v", "n"])


@query("SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_date FROM orders")
def newline_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("custkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("o"),
    )
    folder = prepared(spark, "orders-lines", sf_dir, lambda to: orders.write.json(to))
    return project(read_documents(spark, folder, lines=True), ["o_orderkey", "o_custkey", "o_date"])


# --- Jobs over landing trees ---------------------------------------------------------------

PER_FILE = 5000


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as matches: files of equal names in four folders."""
    orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    name = F.format_string("matches/%d/%d.json", F.col("o_custkey") % 4, F.floor(F.col("o_orderkey") / PER_FILE))
    return orders.select(
        as_record(F.col("o_orderkey").alias("match_id"), F.struct(F.col("o_custkey").alias("team_id")).alias("home")), name.alias("file")
    )


def _team_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as teams with a lineup, the match in the file's name; every team twice."""
    customers = _table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    player = F.array(F.struct(F.col("c_custkey").alias("player")))
    teams = customers.select(
        as_record(F.col("c_custkey").alias("team_id"), F.col("c_name").alias("team_name"), player.alias("lineup")),
        F.format_string("lineups/%d.json", F.floor(F.col("c_custkey") / PER_FILE)).alias("file"),
    )
    return teams.unionByName(teams)


def _views(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    events = _table(spark, sf_dir, "events", ["event_id", "user_id"])
    return events.select(
        as_record(F.col("event_id").alias("event_uuid"), F.array("user_id", "event_id").alias("visible_area")),
        F.format_string(f"{folder}/%d.json", F.floor(F.col("event_id") / PER_FILE)).alias("file"),
    )


def _open_tree(spark: SparkSession, sf_dir: str) -> str:
    """A base folder with the landing files of the first source."""

    def write(base: str) -> None:
        competitions = _table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"]).select(
            as_record(F.col("s_suppkey").alias("competition_id"), F.struct(F.col("s_nationkey").alias("id")).alias("season")),
            F.lit("competitions.json").alias("file"),
        )
        parts = [competitions, _matches(spark, sf_dir), _team_lists(spark, sf_dir), _views(spark, sf_dir, "events"), _views(spark, sf_dir, "three-sixty")]
        write_named(as_list(ops.concat_vertical(*parts)), f"{base}/landing/open_data/data")

    return prepared(spark, "open-tree", sf_dir, write)


def _league_tree(spark: SparkSession, sf_dir: str) -> str:
    """A base folder with the landing files of the second source: single documents, and CSV files with columns of their own."""

    def write(base: str) -> None:
        suppliers = _table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
        parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
        single = [
            suppliers.select(as_record(F.col("s_suppkey").alias("match_id")), F.lit("sb-matches/sb_matches.json").alias("file")),
            parts.select(as_record("id"), F.lit("sb-events/sb_events.json").alias("file")),
            parts.select(as_record(F.struct("id").alias("player")), F.lit("hudl-physical/hudl_physical.json").alias("file")),
        ]
        lines = suppliers.select(F.concat_ws(",", "s_suppkey", "s_name").alias("line"), F.lit("teams").alias("name"), F.lit("team.id,team.name").alias("header"))
        lines = lines.unionByName(parts.select(F.col("id").cast("string").alias("line"), F.lit("players").alias("name"), F.lit("player.id").alias("header")))
        text = F.concat_ws("\n", F.first("header"), F.collect_list("line"), F.lit(""))
        tables = lines.groupBy(F.format_string("mappings/%s.csv", "name").alias("file")).agg(text.alias("value"))
        write_named(as_list(ops.concat_vertical(*single)).unionByName(tables), f"{base}/landing/j1_league")

    return prepared(spark, "league-tree", sf_dir, write)


def _job(spark: SparkSession, tree: str, label: str, source: str, name: str) -> tuple[DataFrame, Dataset]:
    """One dataset of a landing tree, ingested into a new table; the run's summary and the dataset."""
    base = shared_dir(spark, label)
    own = replace(dataset(source, name).below(base), landing=dataset(source, name).below(tree).landing)
    return ingest_dataset(spark, own), own


@query("SELECT s_suppkey AS competition_id, CAST(s_nationkey AS BIGINT) AS season_id, 'competitions' AS file_key FROM supplier")
def job_competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, made = _job(spark, _open_tree(spark, sf_dir), "job-competitions", "open_data", "competitions")
    return project(read_bronze(spark, made), ["competition_id", "season_id", FILE_KEY])


@query(
    """SELECT o_orderkey AS match_id, o_custkey AS home_team_id, 'matches_' || (o_custkey % 4) || '/' || (o_orderkey // 5000) AS file_key,
        CAST(o_orderkey // 5000 AS VARCHAR) AS stem
    FROM orders"""
)
def job_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one name in several folders; key, prefix and stem of each row's file."""
    _, made = _job(spark, _open_tree(spark, sf_dir), "job-matches", "open_data", "matches")
    return project(read_bronze(spark, made).withColumn("stem", file_stem(F.col(FILE_KEY))), ["match_id", "home_team_id", FILE_KEY, "stem"])


@query(
    """SELECT event_id AS event_uuid, '[' || user_id || ',' || event_id || ']' AS visible_area,
        'events_three_sixty_' || (event_id // 5000) AS file_key
    FROM events"""
)
def job_three_sixty(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, made = _job(spark, _open_tree(spark, sf_dir), "job-three-sixty", "open_data", "three-sixty")
    return project(read_bronze(spark, made), ["event_uuid", "visible_area", FILE_KEY])


@query("SELECT p_partkey AS id, 'events' AS dataset FROM part UNION ALL SELECT p_partkey, 'physical' FROM part UNION ALL SELECT s_suppkey, 'matches' FROM supplier")
def job_single_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three single documents of the second source."""
    tables = []
    for name, column in (("events", "id"), ("physical", "player_id"), ("matches", "match_id")):
        _, made = _job(spark, _league_tree(spark, sf_dir), f"job-{name}", "j1_league", name)
        tables.append(read_bronze(spark, made).select(F.col(column).alias("id"), F.lit(name).alias("dataset")))
    return ops.concat_vertical(*tables)


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier UNION ALL SELECT p_partkey, NULL FROM part")
def csv_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every CSV file of a folder to a table of its own."""
    _, made = _job(spark, _league_tree(spark, sf_dir), "job-mappings", "j1_league", "mappings")
    teams = parquet_table(spark, csv_table_path(made, "teams")).select(F.col("team_id").alias("id"), F.col("team_name").alias("name"))
    players = parquet_table(spark, csv_table_path(made, "players")).select(F.col("player_id").alias("id"), F.lit(None).cast("string").alias("name"))
    return ops.concat_vertical(teams, players)


@query(
    """SELECT CAST(event_id // 500 AS BIGINT) AS doc, CASE WHEN event_id // 500 % 10 IN (3, 7) THEN 'error' ELSE 'processed' END AS status,
        CAST(CASE WHEN event_id // 500 % 10 IN (3, 7) THEN 0 ELSE COUNT(*) END AS BIGINT) AS n_rows,
        CAST(SUM(CASE WHEN event_id // 500 % 10 NOT IN (3, 7) THEN event_id END) AS BIGINT) AS ids,
        CAST(SUM(CASE WHEN event_id // 500 % 10 NOT IN (3, 7) THEN user_id END) AS BIGINT) AS users
    FROM events GROUP BY event_id // 500"""
)
def clashing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that disagree on names: a tenth spells ``id`` as ``Id``, a tenth has ``user_id`` beside the others' ``user.id``; these alone are errors."""
    doc = F.floor(F.col("event_id") / 500)

    def write(folder: str) -> None:
        events = _table(spark, sf_dir, "events", ["event_id", "user_id"]).withColumn("doc", doc)
        one = F.format_string('{"id":%d,"user":{"id":%d}}', "event_id", "user_id")
        spelled = F.format_string('{"Id":%d,"user":{"id":%d}}', "event_id", "user_id")
        joined = F.format_string('{"id":%d,"user_id":%d}', "event_id", "user_id")
        record = F.when(F.col("doc") % 10 == 3, spelled).when(F.col("doc") % 10 == 7, joined).otherwise(one)
        write_documents(events.select(record.alias("record"), "doc"), folder, by="doc")

    folder = prepared(spark, "events-clashing", sf_dir, write)
    dataset = _dataset(spark, folder, "events-clashing", layout=BY_BATCH)
    ingest_dataset(spark, dataset)
    number = capture_int(F.col(FILE_KEY), r"doc=(\d+)/").alias("doc")
    outcome = read_manifest(spark, dataset).groupBy(number, "status").agg(F.sum("n_rows").alias("n_rows"))
    content = read_bronze(spark, dataset).groupBy(number).agg(F.sum("id").alias("ids"), F.sum("user_id").alias("users"))
    return outcome.join(content, "doc", "left")


CSV_FILE_ROWS = 200


@query(
    """WITH f AS (SELECT *, o_orderkey // 200 AS n FROM orders),
        rows AS (SELECT n, CASE WHEN n % 10 <> 0 AND n % 10 <> 7 THEN o_orderkey END AS order_id, o_custkey AS cust_id, CASE WHEN n % 3 = 2 THEN o_orderstatus END AS status FROM f)
    SELECT CAST(n AS BIGINT) AS n, CASE WHEN n % 10 = 7 THEN 'empty' WHEN n % 10 = 0 THEN 'error' ELSE 'processed' END AS outcome,
        CAST(CASE WHEN n % 10 IN (0, 7) THEN 0 ELSE COUNT(*) END AS BIGINT) AS n_rows,
        CAST(SUM(order_id) AS BIGINT) AS order_ids, CAST(SUM(CASE WHEN n % 10 IN (0, 7) THEN NULL ELSE cust_id END) AS BIGINT) AS cust_ids,
        CASE WHEN n % 10 NOT IN (0, 7) THEN MAX(status) END AS status
    FROM rows GROUP BY n"""
)
def csv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small CSV files of three layouts; a tenth has a row with surplus cells, a tenth a header only. Outcome and contents per file."""
    n = F.floor(F.col("o_orderkey") / CSV_FILE_ROWS)

    def write(base: str) -> None:
        orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]).withColumn("n", n)
        plain, turned, wide = F.concat_ws(",", "o_orderkey", "o_custkey"), F.concat_ws(",", "o_custkey", "o_orderkey"), F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus")
        line = F.when(n % 3 == 0, plain).when(n % 3 == 1, turned).otherwise(wide)
        header = F.when(n % 3 == 0, "order.id,cust.id").when(n % 3 == 1, "cust.id,order.id").otherwise("order.id,cust.id,status")
        lines = orders.groupBy("n").agg(F.first(header).alias("header"), F.collect_list(line).alias("lines"))
        body = F.when(n_is(10, 7), F.array().cast("array<string>")).when(n_is(10, 0), F.concat("lines", F.array(F.lit("1,2,3,4,5")))).otherwise(F.col("lines"))
        text = F.concat(F.array_join(F.concat(F.array("header"), body), "\n"), F.lit("\n"))
        write_named(lines.select(text.alias("value"), F.format_string("part/%d.csv", "n").alias("file")), base)

    def n_is(modulus: int, rest: int):
        return F.col("n") % modulus == rest

    folder = prepared(spark, "orders-csv-layouts", sf_dir, write)
    base = shared_dir(spark, "csv-layouts")
    made = Dataset("", "csv-layouts", f"{folder}/part", f"{base}/table", "*.csv", state=f"{base}/state", format="csv")
    ingest_dataset(spark, made)
    number = F.col(FILE_KEY).cast("bigint").alias("n")
    outcome = read_manifest(spark, made).select(number, F.col("status").alias("outcome"), "n_rows")
    content = read_csv_tables(spark, made, "order_id bigint, cust_id bigint, status string").groupBy(number).agg(
        F.sum("order_id").alias("order_ids"), F.sum("cust_id").alias("cust_ids"), F.max("status").alias("status"))
    return outcome.join(content, "n", "left")


@query(
    """SELECT 1 AS run, dataset, 'processed' AS status, CAST(n_files AS BIGINT) AS n_files, CAST(n_rows AS BIGINT) AS n_rows FROM (
        SELECT 'matches' AS dataset, 1 AS n_files, COUNT(*) AS n_rows FROM supplier
        UNION ALL SELECT 'events', 1, COUNT(*) FROM part UNION ALL SELECT 'physical', 1, COUNT(*) FROM part
        UNION ALL SELECT 'mappings', 2, (SELECT COUNT(*) FROM part) + COUNT(*) FROM supplier)
    UNION ALL SELECT 2, dataset, 'skipped', n_files, 0 FROM (VALUES ('matches', 1), ('events', 1), ('physical', 1), ('mappings', 2)) v(dataset, n_files)
    UNION ALL SELECT 3, dataset, 'processed', n_files, CAST(n_rows AS BIGINT) FROM (
        SELECT 'matches' AS dataset, 1 AS n_files, COUNT(*) AS n_rows FROM supplier
        UNION ALL SELECT 'events', 1, COUNT(*) FROM part UNION ALL SELECT 'physical', 1, COUNT(*) FROM part
        UNION ALL SELECT 'mappings', 2, (SELECT COUNT(*) FROM part) + COUNT(*) FROM supplier)"""
)
def job_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All datasets of a source: a first run, a second that finds nothing to do, a third that reads all again."""
    base = _with_landing(spark, _league_tree(spark, sf_dir))
    runs = []
    for number, overwrite in ((1, False), (2, False), (3, True)):
        summary = ingest_source(spark, base, "j1_league", overwrite)
        runs.append(summary.select(
            F.lit(number).alias("run"), "dataset", "status", F.col("n_files").cast("bigint").alias("n_files"),
            F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        ))
    return ops.concat_vertical(*runs)


def _with_landing(spark: SparkSession, tree: str) -> str:
    """A new base folder with the landing files of ``tree``."""
    base = shared_dir(spark, "base")
    files.copy(spark, f"{tree}/landing", f"{base}/landing")
    return base


@query(
    """SELECT c_custkey // 5000 AS match_id, c_custkey AS team_id, c_name AS team_name, '[{"player":' || c_custkey || '}]' AS lineup
    FROM customer"""
)
def pipeline_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and silver of the first source; the silver table, one row per match and team."""
    base = _with_landing(spark, _open_tree(spark, sf_dir))
    run_pipeline(spark, base, bronze=True, silver=True, source="open_data")
    return parquet_table(spark, f"{base}/silver/open_data/lineups/lineups_by_match")


@query("SELECT o_orderkey AS match_id, CASE WHEN o_orderkey // 5000 % 10 = 0 THEN -o_custkey ELSE o_custkey END AS home_team_id FROM orders")
def bronze_reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the files changes between two runs in batch layout; the table holds the new rows of those and the old ones of the rest."""
    base = _with_landing(spark, _open_tree(spark, sf_dir))
    ingest_named(spark, base, "open_data", "matches")
    orders = _table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"]).withColumn("n", F.floor(F.col("o_orderkey") / PER_FILE))
    changed = orders.where("n % 10 = 0").select(
        as_record(F.col("o_orderkey").alias("match_id"), F.struct((-F.col("o_custkey")).alias("team_id")).alias("home")),
        F.format_string("matches/%d/%d.json", F.col("o_custkey") % 4, "n").alias("file"),
    )
    write_named(as_list(changed), f"{base}/landing/open_data/data")
    ingest_named(spark, base, "open_data", "matches")
    return project(read_bronze(spark, dataset("open_data", "matches").below(base)), ["match_id", "home_team_id"])
