"""Random nested records, ingested and compared with a plain Python flattening."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings, strategies as st

from stratum.sources.documents import read_documents

NAMES = ["a", "b", "c", "d"]
TEXT = st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=8)
SCALARS = {
    "int": st.integers(-(2**63), 2**63 - 1),
    "float": st.floats(allow_nan=False, allow_infinity=False),
    "bool": st.booleans(),
    "text": TEXT,
}

kinds = st.recursive(
    st.one_of(st.sampled_from(sorted(SCALARS)), st.tuples(st.just("list"), st.sampled_from(sorted(SCALARS)))),
    lambda inner: st.dictionaries(st.sampled_from(NAMES), inner, min_size=1, max_size=3),
    max_leaves=6,
)
schemas = st.dictionaries(st.sampled_from(NAMES), kinds, min_size=1, max_size=4)


def values(kind):
    if isinstance(kind, dict):
        return st.fixed_dictionaries({}, optional={name: values(inner) for name, inner in kind.items()})
    if isinstance(kind, tuple):
        return st.lists(SCALARS[kind[1]], max_size=3)
    return st.one_of(st.none(), SCALARS[kind])


def flat(record: dict, above: str = "") -> dict:
    out = {}
    for name, value in record.items():
        if isinstance(value, dict):
            out |= flat(value, f"{above}{name}_")
        else:
            out[f"{above}{name}"] = value
    return out


def comparable(value):
    if isinstance(value, (list, tuple)):
        return tuple(comparable(v) for v in value)
    return value


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_flattening_agrees(spark, tmp_path_factory, data):
    schema = data.draw(schemas)
    records = data.draw(st.lists(values(schema), min_size=1, max_size=6))
    folder = tmp_path_factory.mktemp("docs")
    half = len(records) // 2
    (folder / "a.json").write_text(json.dumps(records[:half], ensure_ascii=False), "utf-8")
    (folder / "b.json").write_text(json.dumps(records[half:], ensure_ascii=False), "utf-8")
    expected = [flat(record) for record in records]
    df = read_documents(spark, str(folder))
    assert set(df.columns) == {name for row in expected for name in row}
    if not df.columns:
        return
    top_lists = {name for record in records for name, value in record.items() if isinstance(value, list)}
    got = []
    for row in df.collect():
        got.append({
            name: json.loads(value) if name in top_lists and value is not None else value
            for name, value in row.asDict().items()
        })
    names = sorted(df.columns)

    def as_rows(rows):
        return sorted(repr([comparable(row.get(name)) for name in names]) for row in rows)

    assert as_rows(got) == as_rows(expected)
