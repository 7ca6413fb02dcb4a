"""The check by pieces against the check of whole texts."""

from __future__ import annotations

import json
import random

import pytest

from stratum.plans import ingest as ingest_module
from stratum.session import session_conf
from stratum.sources.documents import check_documents, open_texts
from stratum.sources.structure import check_structure

TEXTS = {
    "list": '[{"a":1},{"a":2}]', "object": '{"a":{"b":[1,2,{"c":"]"}]}}', "blank_end": ' [ {"a":1} ] \n ', "empty": " [ ] ",
    "after": '[{"a":1}] x', "two": '[{"a":1}][{"a":2}]', "comma": '[{"a":1}],', "listed": '[{"a":1}],[{"a":2}]', "objects": '{"a":1}{"b":2}',
    "open": '[{"a":1},{"a":2}', "string": '[{"a":"x]}', "closed": '[{"a":1}]]', "words": "true", "early": 'x[{"a":1}]',
    "quotes": r'[{"a":"say \"[{\" , or \\","b":"},{"},{"a":"\\"}]', "commas": '[{"a":",,,","b":","}]', "text": '[{"a":1}] ,"b"', "nested": "[" * 30 + "]" * 30,
    "inner": '[{"a":1}],{"b":[1,2]}', "late_string": '[{"a":1}]"', "unicode": '[{"ä":"€]","b":"日,本"}]', "none": " , ",
}


def states(df) -> dict[str, str]:
    return {r.path_part.rsplit("/", 1)[-1].removesuffix(".json"): r.state for r in df.collect()}


@pytest.mark.parametrize("block", ["1g", "7b"])
def test_same_states_as_whole_texts(spark, tmp_path, block):
    rng = random.Random(4)
    texts = dict(TEXTS)
    for k in range(12):
        records = [{"id": i, "s": "".join(rng.choice('ab,"\\[]{} ') for _ in range(rng.randrange(12))), "l": [1, {"x": None}][: rng.randrange(3)]} for i in range(rng.randrange(1, 6))]
        text = json.dumps(records if k % 3 else records[0], indent=rng.choice([None, 1]))
        texts[f"good{k}"] = text
        # A bracket or quote too few or too many.
        at = rng.choice([i for i, c in enumerate(text) if c in '[]{}"'])
        texts[f"bad{k}"] = text[:at] + text[at + 1 :] if k % 2 else text + rng.choice(["]", "{}", ' "x"', "0"])
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, "utf-8")
    paths = [str(tmp_path / f"{name}.json") for name in texts]
    whole = states(check_documents(open_texts(spark, paths)))
    with session_conf(spark, spark__sql__files__maxPartitionBytes=block, spark__sql__files__openCostInBytes="1"):
        pieces = states(check_structure(spark, paths))
    # What is wrong between the brackets only the parser sees; nothing that is right may be refused.
    differ = {name for name in texts if pieces.get(name, "error") != whole[name]}
    assert all(whole[name] == "error" and pieces[name] == "ok" and name.startswith("bad") for name in differ), differ
    assert not differ & set(TEXTS)


def test_statuses_do_not_depend_on_the_limit(make_landing, monkeypatch):
    found = []
    for limit in (2_000_000_000, 10):
        monkeypatch.setattr(ingest_module, "LARGEST_CHECKED_FILE", limit)
        landing = make_landing()
        for name, text in TEXTS.items():
            if name not in ("nested", "none", "words"):
                landing.put(f"{name}.json", text)
        landing.put("syntax.json", '[{"a":1} {"a":2}]')
        landing.put("tail.json", '[{"a":1},]')
        landing.run()
        from stratum.plans.manifest import read_manifest

        found.append({r.file_key: (r.status, r.n_rows) for r in read_manifest(landing.spark, landing.dataset).collect()})
    assert found[0] == found[1]
