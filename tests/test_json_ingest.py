"""JSON documents to a flat table: shapes, types, names and bad files."""

from __future__ import annotations

import json

import pytest

from stratum import SchemaDriftError
from stratum.operators import ColumnCollisionError


def test_array_and_object_roots(landing):
    landing.put("a.json", [{"id": "e1", "team": {"id": 7, "name": "Añ"}}, {"id": "e2"}])
    landing.put("b.json", {"id": "solo", "team": {"id": 9}})
    assert landing.run() == {"processed": 2}
    assert landing.columns() == {"id": "string", "team_id": "bigint", "team_name": "string"}
    assert landing.rows("id", "team_id", "team_name", "file_key") == [
        ("e1", 7, "Añ", "a"), ("e2", None, None, "a"), ("solo", 9, None, "b"),
    ]


def test_bad_files_do_not_stop_the_batch(landing):
    landing.put("ok.json", [{"id": "g"}])
    landing.put("empty.json", "[]")
    landing.put("spaces.json", " [ ]\n")
    bad = {
        "truncated": '[{"id":"e3","index":1', "late": '[{"id":"g1"},{"id":}]', "tail": '[{"id":"x"}] garbage',
        "two": '{"id":"a"}{"id":"b"}', "zero": "", "blank": " \n", "scalar": "5", "text": '"abc"', "nothing": "null",
        "numbers": "[1,2]", "partly": '[{"id":"p"},3]', "hole": '[{"id":"h"}, null]', "quotes": "[{'id':'q'}]",
        "close": '{"id":"x"}],[{"id":"y"}', "member": '[{"id":"x"}],"e":[2]', "brace": '{"id":"x"}}',
    }
    for name, text in bad.items():
        landing.put(f"{name}.json", text)
    assert landing.run() == {"processed": 1, "empty": 2, "error": len(bad)}
    assert landing.rows("id") == [("g",)]
    assert landing.columns() == {"id": "string"}


def test_only_bad_or_empty_files_write_nothing(landing):
    landing.put("a.json", "[]")
    landing.put("b.json", "{")
    assert landing.run() == {"empty": 1, "error": 1}
    assert not (landing.root / "table").exists()


def test_nan_is_null(landing):
    landing.put("a.json", '[{"a":NaN},{"a":1.5},{"a":Infinity}]')
    assert landing.run() == {"processed": 1}
    assert landing.rows("a") == [(1.5,), (None,), (float("inf"),)]


def test_top_level_lists_keep_their_text(landing):
    landing.put("a.json", '[{"location":[61.0, 40],"related":["x","é"],"lineup":[{"b":1,"a":null,"f":1.10}],"none":[]}]')
    landing.run()
    assert landing.rows("location", "related", "lineup", "none") == [
        ("[61.0, 40]", '["x","é"]', '[{"b":1,"a":null,"f":1.10}]', "[]")
    ]


def test_lists_inside_objects_stay_arrays(landing):
    landing.put("a.json", [{"pass": {"end": [1, 2.5]}, "top": [1]}])
    landing.run()
    assert landing.columns() == {"pass_end": "array<double>", "top": "string"}
    assert landing.rows("pass_end") == [([1.0, 2.5],)]


def test_lists_stay_arrays_without_serializing(make_landing):
    landing = make_landing(serialize_lists=False)
    landing.put("a.json", [{"top": [1, 2]}])
    landing.run()
    assert landing.columns() == {"top": "array<bigint>"}


def test_nesting_and_empty_objects(landing):
    landing.put("a.json", [{"c": {"y": {"z": 3}}, "a": {}, "b": 1}])
    landing.run()
    assert landing.columns() == {"c_y_z": "bigint", "b": "bigint"}


def test_object_or_null(landing):
    landing.put("a.json", [{"a": {"x": 1}}, {"a": None}])
    landing.run()
    assert landing.columns() == {"a_x": "bigint"}
    assert landing.rows("a_x") == [(1,), (None,)]


def test_object_or_scalar(landing):
    landing.put("a.json", [{"a": {"x": 1}}, {"a": 7}, {"a": None}])
    landing.run()
    assert landing.columns() == {"a_x": "bigint", "a": "bigint"}
    assert landing.rows("a_x", "a") == [(1, None), (None, 7), (None, None)]


def test_object_or_scalar_below_an_object(landing):
    landing.put("a.json", [{"o": {"a": {"x": {"y": 1.5}}}}, {"o": {"a": "t"}}, {"o": {"b": 2}}])
    landing.run()
    assert landing.columns() == {"o_a_x_y": "double", "o_a": "string", "o_b": "bigint"}
    assert landing.rows("o_a_x_y", "o_a", "o_b") == [(1.5, None, None), (None, "t", None), (None, None, 2)]


def test_text_that_looks_like_an_object_stays_text(landing):
    landing.put("a.json", [{"props": '{"k":1}'}, {"props": "{}"}])
    landing.run()
    assert landing.columns() == {"props": "string"}
    assert landing.rows("props") == [('{"k":1}',), ("{}",)]


def test_object_in_one_run_scalar_in_the_next(landing):
    landing.put("a.json", [{"a": {"x": 1}}])
    landing.run()
    landing.put("b.json", [{"a": 7}])
    assert landing.run() == {"processed": 1, "skipped": 1}
    assert landing.rows("a_x", "a") == [(1, None), (None, 7)]
    landing.put("c.json", [{"a": "word"}, {"a": {"x": 2, "y": "n"}}])
    landing.run()
    assert landing.rows("a_x", "a_y", "a") == [(1, None, None), (2, "n", None), (None, None, "7"), (None, None, "word")]


def test_scalar_in_one_run_object_in_the_next(landing):
    landing.put("a.json", [{"a": 7}])
    landing.run()
    landing.put("b.json", [{"a": {"x": 1}}, {"a": 2.5}])
    landing.run()
    assert landing.rows("a_x", "a") == [(1, None), (None, 2.5), (None, 7.0)]


def test_types(landing):
    landing.put("a.json", [{"i": 1, "f": 1, "b": True, "n": None, "m": 1, "big": 12345678901234567890123, "d": "2024-01-01"}])
    landing.put("b.json", [{"i": None, "f": 2.5, "m": "x"}])
    landing.run()
    assert landing.columns() == {
        "i": "bigint", "f": "double", "b": "boolean", "n": "string", "m": "string",
        "big": "decimal(23,0)", "d": "string",
    }
    assert landing.rows("i", "f", "m") == [(1, 1.0, "1"), (None, 2.5, "x")]


def test_name_collisions(landing):
    landing.put("a.json", [{"a_b": 1, "a": {"b": 2}}])
    with pytest.raises(ColumnCollisionError, match="'a_b'.*'a.b'|'a.b'.*'a_b'"):
        landing.run()


def test_case_collision(landing):
    landing.put("a.json", [{"A": 1, "a": 2}])
    with pytest.raises(ColumnCollisionError, match="'A', 'a'"):
        landing.run()


def test_dotted_names(landing):
    landing.put("a.json", [{"x.y": 1, "q`t": {"r s": 2}}])
    landing.run()
    assert landing.rows("x_y") == [(1,)]
    assert set(landing.columns()) == {"x_y", "q`t_r s"}


def test_new_field_and_wider_type_under_a_known_schema(landing):
    landing.put("a.json", [{"v": 1}])
    landing.run()
    landing.put("b.json", [{"v": 2.5, "n": "new"}])
    assert landing.run() == {"processed": 1, "skipped": 1}
    assert landing.columns() == {"v": "double", "n": "string"}
    assert landing.rows("v", "n") == [(1.0, None), (2.5, "new")]


def test_null_only_fields_do_not_widen(landing):
    landing.put("a.json", [{"v": 1, "o": {"x": 1}, "l": {"e": [1.5]}, "late": None, "w": "x"}])
    landing.run()
    assert landing.columns()["late"] == "string"
    landing.put("b.json", [{"v": None, "o": None, "l": {"e": []}, "late": 4, "w": None}])
    landing.run()
    assert landing.columns() == {"v": "bigint", "o_x": "bigint", "l_e": "array<double>", "late": "bigint", "w": "string"}
    assert landing.rows("v", "o_x", "l_e", "late", "w") == [(1, 1, [1.5], None, "x"), (None, None, [], 4, None)]


def test_text_stays_text_when_numbers_follow(landing):
    landing.put("a.json", [{"v": "x"}])
    landing.run()
    landing.put("b.json", [{"v": 12}])
    landing.run()
    assert landing.rows("v") == [("12",), ("x",)]


def test_strict_run_refuses_drift(landing):
    landing.put("a.json", [{"v": 1}])
    landing.run(strict=True)
    landing.put("b.json", [{"v": 2.5}])
    with pytest.raises(SchemaDriftError, match="v: bigint to double"):
        landing.run(strict=True)
    assert landing.rows("v") == [(1,)]


def test_several_batches_agree_on_one_schema(landing):
    for i in range(6):
        landing.put(f"f{i}.json", [{"id": i, "v": [None, 1, 2.5][i % 3], "only": None}])
    assert landing.run(max_files=2) == {"processed": 6}
    assert landing.columns() == {"id": "bigint", "v": "double", "only": "string"}
    assert len(landing.rows("id")) == 6


def test_odd_file_names(landing):
    for i, name in enumerate(["a b", "p+q", "x%20y", "br[1]", "é", "{z}", "st*r"]):
        landing.put(f"{name}.json", [{"id": i}])
    assert landing.run() == {"processed": 7}
    assert landing.rows("id", "file_key") == [
        (0, "a b"), (1, "p+q"), (2, "x%20y"), (3, "br[1]"), (4, "é"), (5, "{z}"), (6, "st*r"),
    ]


def test_long_text_values(landing):
    text = "w" * 25_000_000
    landing.put("a.json", [{"t": text, "n": 1}])
    assert landing.run() == {"processed": 1}
    assert landing.table().selectExpr("length(t)").first()[0] == len(text)


def test_newline_delimited(make_landing):
    landing = make_landing(format="jsonl", pattern="*.jsonl")
    landing.put("a.jsonl", '{"a":{"b":1}}\n\n{"a":{"b":2}}\n')
    landing.put("bad.jsonl", '{"a":{"b":3}}\n{"a":\n')
    landing.put("tail.jsonl", '{"a":{"b":3}} x\n')
    assert landing.run() == {"processed": 1, "error": 2}
    assert landing.rows("a_b") == [(1,), (2,)]


def test_serialized_text_parses_back(landing):
    value = [{"p": {"q": [1, None, "ü"]}, "r": 1e-7}, []]
    landing.put("a.json", [{"l": value}])
    landing.run()
    assert json.loads(landing.rows("l")[0][0]) == value


def test_large_files_are_streamed(landing, monkeypatch):
    """Files beyond the size of one text value go through the multi-line reader, same result."""
    from stratum.plans import ingest

    monkeypatch.setattr(ingest, "LARGEST_CHECKED_FILE", 60)
    landing.put("small.json", [{"id": 1, "v": {"x": 1}, "l": [1.0, 2]}])
    landing.put("large.json", [{"id": 2, "v": {"x": 2}, "l": [1.0, 2]}, {"id": 3, "v": None, "l": [], "pad": "p" * 60}])
    landing.put("wrong.json", [{"id": 4, "pad": "p" * 60}, 5])
    assert landing.run() == {"processed": 2, "error": 1}
    assert landing.rows("id", "v_x", "l") == [(1, 1, "[1.0, 2]"), (2, 2, "[1.0, 2]"), (3, None, "[]")]


def test_counting_reads(spark, tmp_path):
    """Frames from files can be counted although no column of theirs is asked for."""
    from stratum.sources import read_csv, read_documents

    (tmp_path / "a.json").write_text('[{"a":1},{"a":2}]')
    (tmp_path / "bad.json").write_text('[{"a":1}')
    (tmp_path / "l.jsonl").write_text('{"a":1}\n{"a":\n')
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    assert read_documents(spark, [str(tmp_path / "a.json"), str(tmp_path / "bad.json")]).count() == 2
    assert read_documents(spark, str(tmp_path / "l.jsonl"), lines=True).select("a").collect() == [(1,)]
    assert read_csv(spark, str(tmp_path / "c.csv")).count() == 1


def test_size_changes_no_answer_for_lines(make_landing, monkeypatch):
    """Files of lines give all rows, and are checked, at any size."""
    from stratum.plans import ingest

    monkeypatch.setattr(ingest, "LARGEST_CHECKED_FILE", 100)
    lines = make_landing(format="jsonl", pattern="*.jsonl")
    lines.put("a.jsonl", "\n".join(json.dumps({"i": i}) for i in range(1000)))
    lines.put("b.jsonl", "\n".join(json.dumps({"i": i}) for i in range(50)) + "\n{broken")
    summary = lines.run()
    assert summary["processed"] == 1 and summary["error"] == 1 and lines.table().count() == 1000


def test_malformed_records_count_alike_for_every_projection(spark, tmp_path):
    """A value that does not fit the given schema, and a broken file, whatever columns are asked for."""
    from stratum.sources import read_documents

    (tmp_path / "l.jsonl").write_text('{"i":1,"v":1}\n{"i":2,"v":"x"}\n{"i":3,"v":3}\n')
    (tmp_path / "bad.json").write_text('[{"a":1}')
    rows = read_documents(spark, str(tmp_path / "l.jsonl"), schema="i bigint, v bigint", lines=True)
    assert rows.count() == rows.select("i").count() == rows.select("i", "v").count() == len(rows.select("i").collect()) == 2
    for columns in (["i"], ["i", "v"]):
        strict = read_documents(spark, str(tmp_path / "l.jsonl"), schema="i bigint, v bigint", lines=True, malformed="raise")
        with pytest.raises(Exception, match="malformed record in .*l.jsonl"):
            strict.select(*columns).collect()
    with pytest.raises(Exception, match="bad.json"):
        read_documents(spark, str(tmp_path / "bad.json"), schema="a bigint", malformed="raise").count()
    with pytest.raises(ValueError, match="malformed"):
        read_documents(spark, str(tmp_path / "l.jsonl"), malformed="ignore")


def test_files_of_one_stem_are_two_files(make_landing):
    """A pattern that leaves the extension open keeps it in the key."""
    landing = make_landing(pattern="*")
    landing.put("x.json", [{"i": 1}, {"i": 2}])
    landing.put("x.txt", [{"i": 3}])
    assert landing.run() == {"processed": 2}
    assert landing.rows("i") == [(1,), (2,), (3,)]
