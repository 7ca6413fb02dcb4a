"""CSV files: names, types, missing values and malformed rows."""

from __future__ import annotations

import os

import pytest

from stratum import ingest_csv_batch
from stratum.sources.delimited import RaggedCsvError, header_names, read_csv


@pytest.fixture
def table(spark, tmp_path):
    def read(text: str, **options):
        path = tmp_path / "t.csv"
        path.write_bytes(text.encode())
        df = read_csv(spark, str(path), **options)
        return dict(df.dtypes), [tuple(row) for row in df.collect()]

    return read


def test_basics(table):
    kinds, rows = table("id,a.b,name,flag,when,z\n1,2,NA,True,2024-01-01,007\n2,2.5,n,false,,8\n")
    assert kinds == {"id": "bigint", "a.b": "double", "name": "string", "flag": "boolean", "when": "string", "z": "bigint"}
    assert rows == [(1, 2.0, None, True, "2024-01-01", 7), (2, 2.5, "n", False, None, 8)]


def test_na_texts(table):
    tokens = ["#N/A", "N/A", "NULL", "None", "nan", "<NA>", "n/a", "null", "-1.#IND", '""']
    kinds, rows = table("a,b\n" + "".join(f"{t},x\n" for t in tokens) + "3,y\n")
    assert kinds["a"] == "bigint"
    assert [r[0] for r in rows] == [None] * len(tokens) + [3]


def test_numbers(table):
    assert table("a\n1e5\ninf\n-Infinity\n.5\n1.\n")[1] == [(1e5,), (float("inf"),), (float("-inf"),), (0.5,), (1.0,)]
    assert table("a\n1d\n2\n")[0] == {"a": "string"}
    assert table("a\n1_0\n")[0] == {"a": "string"}
    assert table("a\n18446744073709551615\n")[0] == {"a": "decimal(20,0)"}
    assert table("a\n99999999999999999999\n1\n") == ({"a": "string"}, [("99999999999999999999",), ("1",)])
    assert table("a,b\n 1, x\n2 ,y\n") == ({"a": "bigint", "b": "string"}, [(1, " x"), (2, "y")])
    assert table("a\n1\nTrue\n") == ({"a": "string"}, [("1",), ("True",)])


def test_all_missing_column_is_text(table):
    assert table("a,b\n1,\n2,\n") == ({"a": "bigint", "b": "string"}, [(1, None), (2, None)])


def test_quotes_and_line_breaks(table):
    assert table('a,b\n"x\ny","q""r"\n"p,q",\\n\n')[1] == [("x\ny", 'q"r'), ("p,q", "\\n")]


def test_blank_lines_and_line_ends(table):
    assert table("\n\na,b\r\n1,2\r\n\r\n3,4\r\n")[1] == [(1, 2), (3, 4)]


def test_short_and_long_rows(table):
    assert table("a,b\n1\n2,3\n")[1] == [(1, None), (2, 3)]
    for text in ("a,b\n1,2\n3,4,5\n", "a,b\n1,2\n3,4,\n", "a,b\n1,2\n3,4,,5\n"):
        with pytest.raises(RaggedCsvError):
            table(text)


def test_leading_unnamed_cells_are_an_index(table):
    assert table("a,b\n1,2,3\n4,5\n") == ({"a": "bigint", "b": "bigint"}, [(2, 3), (5, None)])


def test_header_names():
    assert header_names(["a", "a", "a"]) == ["a", "a.1", "a.2"]
    assert header_names(["a", "a", "a.1"]) == ["a", "a.2", "a.1"]
    assert header_names(["a", None, "b", None]) == ["a", "Unnamed: 1", "b", "Unnamed: 3"]


def test_splittable_read_gives_the_same(table):
    text = "a,b\n" + "".join(f"{i},t{i}\n" for i in range(1000))
    assert table(text) == table(text, multiline=False)


def test_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out" / "mappings")
    source.mkdir()
    texts = {
        "teams": "team.id,name,name\n1,Añ,x\n2,NA,y\n", "head": "a,b\n", "long": "a,b\n1,2\n1,2,3\n", "zero": "",
        "dates": "d\n2024-01-01\n",
    }
    for name, text in texts.items():
        (source / f"{name}.csv").write_text(text, "utf-8")
        os.utime(source / f"{name}.csv", (1_700_000_000, 1_700_000_000))
    (source / "other.txt").write_text("x\n")

    def run(**options):
        return {r.status: r.n_files for r in ingest_csv_batch(spark, str(source), out, **options).collect()}

    assert run() == {"processed": 2, "empty": 1, "error": 2}
    teams = spark.read.parquet(f"{out}/teams.parquet")
    assert teams.dtypes == [("team_id", "bigint"), ("name", "string"), ("name_1", "string")]
    assert sorted(map(tuple, teams.collect())) == [(1, "Añ", "x"), (2, None, "y")]
    assert spark.read.parquet(f"{out}/dates.parquet").dtypes == [("d", "string")]
    assert spark.read.parquet(f"{out}/head.parquet").columns == ["a", "b"]
    assert run() == {"skipped": 3, "error": 2}

    (source / "teams.csv").write_text("a,b\n1,2,3\n4,5,6,7\n")  # now malformed: the last good table stays
    os.utime(source / "teams.csv", (1_700_000_500, 1_700_000_500))
    assert run() == {"skipped": 2, "error": 3}
    assert spark.read.parquet(f"{out}/teams.parquet").count() == 2


def jobs(spark) -> int:
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    """Three layouts, one of them turned around; the manifest tells every file's own outcome."""
    started = []
    for n in (120, 240):
        source, out = tmp_path / f"in{n}", str(tmp_path / f"out{n}")
        source.mkdir()
        for k in range(n):
            header, row = (("a.b,name", f"{k},x"), ("name,a.b", f"x,{k}"), ("a.b,name,extra", f"{k},x,2.5"))[k % 3]
            bad = "1,2,3,4,5,6\n" if k % 10 == 9 else ""
            (source / f"m {k}=%.csv").write_text(f"{header}\n{row}\n{row}\n{bad}")
        before = jobs(spark)
        summary = {r.status: (r.n_files, r.n_rows) for r in ingest_csv_batch(spark, str(source), out).collect()}
        started.append(jobs(spark) - before)
        assert summary == {"processed": (n * 9 // 10, n * 9 // 10 * 2), "error": (n // 10, 0)}
        for k in (0, 1, 2):
            table = spark.read.parquet(f"{out}/m {k}=%.parquet")
            assert table.columns == (["a_b", "name"], ["name", "a_b"], ["a_b", "name", "extra"])[k]
            assert [r["a_b"] for r in table.collect()] == [k, k]
    assert started[0] == started[1]


def test_one_clashing_file_leaves_the_others(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for name, text in {"good": "a.b\n1\n", "clash": "a.b,a_b\n1,2\n", "text": "a.b\nx\n", "blank": "\n \n"}.items():
        (source / f"{name}.csv").write_text(text)
    assert {r.status: r.n_files for r in ingest_csv_batch(spark, str(source), out).collect()} == {"processed": 2, "error": 2}
    assert spark.read.parquet(f"{out}/good.parquet").dtypes == [("a_b", "bigint")]
    assert spark.read.parquet(f"{out}/text.parquet").dtypes == [("a_b", "string")]


def test_trailing_commas_from_the_first_row_on(table):
    assert table("a,b\n1,2,\n3,4,\n") == ({"a": "bigint", "b": "string"}, [(2, None), (4, None)])


def test_headers_and_rows_over_several_lines(table):
    assert table('"a\nb","c ""d"""\n1,2\n') == ({"a\nb": "bigint", 'c "d"': "bigint"}, [(1, 2)])
    wide = ",".join(f"k{i}" for i in range(40))
    row = ",".join(f'"{i}\n"' if i % 3 == 0 else str(i) for i in range(40))
    kinds, rows = table(f"{wide}\n{row}\n")
    assert len(kinds) == 40 and rows[0][:3] == (0, 1, 2) and rows[0][38] == 38


def test_many_columns(table):
    kinds, rows = table(",".join(f"k{i}" for i in range(1_000)) + "\n1,2\n")
    assert len(kinds) == 1_000 and rows[0][:3] == (1, 2, None)


def test_several_files_bind_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2.5,3\n")
    (tmp_path / "c.csv").write_text("x,z\n1,2\n")
    df = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert df.dtypes == [("x", "bigint"), ("y", "double")]
    assert sorted(map(tuple, df.collect())) == [(1, 2.0), (3, 2.5)]
    with pytest.raises(RaggedCsvError):
        read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "c.csv")])
