"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import os
import random
import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from stratum.llm import decontaminate, exact_dedup, language_id, packing, scratch, sharding, simhash, toxicity, url_filter, warc
from stratum.llm.scratch import gives_back
from stratum.llm.words import Codes, default_tokenizer

LONG = " ".join(f"w{i % 997}" for i in range(60_000))
TEXTS = [(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "four  five"), (4, LONG), (5, "fourfive"), (6, "ONE two"), (7, " \t")]
SCHEMA = "doc_id long, text string, score double, start int, bin int, digest string, id string, shard string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 0.5, 9, 9, "d", "x", "s") for i, t in TEXTS], SCHEMA)


def test_sharding(docs):
    rows = sharding.shard_rows(docs, shards=3, bins=64).collect()
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_rows(docs.limit(0)).count() == 0


def test_sharding_balance_and_movement(spark):
    many = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    before = {}
    for shards in (8, 9):
        rows = sharding.shard_rows(many.withColumn("n", many["doc_id"]), shards=shards, bins=4096, keep=("doc_id",)).toPandas()
        loads = rows.groupby("shard")["size"].sum()
        assert len(loads) == shards and loads.max() < 1.03 * loads.mean() and loads.min() > 0.97 * loads.mean()
        before[shards] = rows[rows["doc_id"] != 7].set_index("doc_id")["shard"]
    moved = (before[8].sort_index() != before[9].sort_index()).mean()
    assert moved < 0.4


def test_exact_dedup(docs, spark):
    rows = exact_dedup.mark_copies(docs).collect()
    assert len(rows) == len(TEXTS)
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in rows)
    # "four  five" has more code points than "fourfive"; the first empty row by length, then id, is " \t".
    assert kept == sorted([
        (False, 1, 1, 2, True), (False, 1, 1, 2, False), (False, 2, 7, 3, False), (False, 3, 7, 3, False), (True, 0, 0, 2, True),
        (False, 4, 4, 1, True), (False, 5, 0, 2, False), (False, 6, 6, 1, True), (False, 7, 7, 3, True),
    ])
    assert exact_dedup.drop_copies(docs).count() == 5
    assert exact_dedup.mark_copies(docs.limit(0)).count() == 0 and exact_dedup.drop_copies(docs.limit(0)).columns == docs.columns


def test_cuckoo_index_inserts_deletes_and_grows(spark):
    digests = spark.range(3000).selectExpr("sha2(cast(id as string), 256) as digest", "id as keep_id", "1 as keep_points", "1L as group_size")
    index = exact_dedup.CuckooIndex(spark, 2).insert(digests.filter("keep_id < 100"))
    index = index.insert(digests.filter("keep_id >= 50"))
    assert index.probe(digests).count() == 3000
    index = index.delete(digests.filter("keep_id % 3 = 0"))
    left = {r["keep_id"] for r in index.probe(digests).collect()}
    assert left == {i for i in range(3000) if i % 3}
    assert index.insert(digests.filter("keep_id = 3")).probe(digests).count() == 2001


def test_an_insert_asks_the_filters_once_and_leaves_no_table_behind(spark, monkeypatch):
    digests = spark.range(300).selectExpr("sha2(cast(id as string), 256) as digest", "id as keep_id", "1 as keep_points", "1L as group_size")
    made, asked = [], []

    class Noted(exact_dedup.Stored):
        def __init__(self, df, label):
            asked.append(df._jdf.queryExecution().optimizedPlan().toString().count("_probe"))
            super().__init__(df, label)
            made.append((label, self.path.removeprefix("file://")))

    monkeypatch.setattr(exact_dedup, "Stored", Noted)
    monkeypatch.setattr(exact_dedup, "stored", lambda df, label: Noted(df, label).df)
    index = exact_dedup.CuckooIndex(spark, 2).insert(digests)
    assert sum(asked) == 1
    assert {label for label, path in made if os.path.exists(path)} == {"cuckoo-keys", "cuckoo-filters"}
    assert index.probe(digests).count() == 300


def test_difference_and_windows():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 1024, n)
        window = packing.windows_for(sizes, 1024)
        assert np.bincount(window, weights=sizes).max() <= 1024
    assert np.bincount(packing.difference(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4]).max() == 16


def test_packing(docs):
    codes = Codes(default_tokenizer())
    rows = packing.pack(packing.pieces(docs, capacity=64), capacity=64).collect()
    by_text: dict = {}
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) and r["offset"] + r["length"] <= 64
        by_text.setdefault(str(r["doc_id"]), []).append((r["start"], bytes(r["ids"])))
    for doc_id, text in TEXTS:
        data = codes.encode(text or "") + bytes(4)
        got = sorted(set(by_text[str(doc_id)]))
        assert b"".join(part for _, part in got) == data
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    for (a, at, n), (b, to, _) in zip(places, places[1:]):
        assert to == (at + n if a == b else 0)
    assert packing.pack(packing.pieces(docs.limit(0))).count() == 0


def test_warc(spark):
    big = "é" * 700
    pages = spark.createDataFrame([
        (1, "http://A.org/x\r\ny", big, 1), (2, "http://a.org/", big, 1), (3, None, None, 1), (4, "no scheme", "", 1), (4, "no scheme", "", 1),
        (None, "http://b/", big, 1), (5, "http://b/#f", "small\r\n\r\nWARC/1.1\r\n", 1), (6, "http://b/?q", "small\r\n\r\nWARC/1.1\r\n", 1),
    ], "page_id long, url string, html string, offset int")
    rows = warc.capture_history(pages).collect()
    assert [warc.order_of(tuple(r)) for r in rows] == sorted(warc.order_of(tuple(r)) for r in rows)
    got = sorted((str(r["page_id"]), r["record_type"], r["payload_bytes"], r["refers_to"]) for r in rows)
    assert got == sorted([("1", "revisit", 1400, 2), ("2", "response", 1400, None), ("3", "response", 0, None), ("4", "response", 0, None),
                          ("4", "response", 0, None), ("None", "revisit", 1400, 2), ("5", "response", 19, None), ("6", "response", 19, None)], key=str)
    assert warc.capture_history(pages.limit(0)).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted(((str(rng.randint(0, 9)), "t", rng.randint(0, 99), "", "", 0, None, "f", j, 0) for j in range(rng.randint(0, 20))), key=warc.order_of) for _ in range(k)]
        assert [warc.order_of(r) for r in warc.LoserTree(runs)] == sorted(warc.order_of(r) for run in runs for r in run)


def test_url_filter(spark):
    rules = [url_filter.Rule("block", "bad.org"), url_filter.Rule("allow", "bad.org", "/ok/"), url_filter.Rule("allow", "good.org")]
    page = '<link rel="canonical" href="{}">'
    rows = [
        (1, "http://x.com/a", page.format("http://y.com/b")), (2, "http://y.com/b", '<meta http-equiv="refresh" content="0; url=http://z.bad.org/c">'),
        (3, "http://w.com/", page.format("http://bad.org/ok/1")), (4, "http://Q.com/p?utm_x=1", page.format("/r")), (5, None, None), (6, "none", ""),
        (7, "http://v.com/1", page.format("http://bad.org/1")), (7, "http://v.com/1", page.format("http://good.org/1")), (8, "http://notbad.org/", None),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, rule string")
    got = {(r["page_id"], r["verdict"], r["decided_by"]) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {(1, "block", "alias"), (2, "block", "alias"), (3, "allow", "default"), (4, "allow", "default"), (5, "allow", "default"),
                   (6, "allow", "default"), (7, "allow", "default"), (8, "allow", "default")}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_language(spark, docs):
    learn = spark.createDataFrame([(i, "der die das und " * 5 if i % 2 else "the and of to " * 5, "de" if i % 2 else "en") for i in range(20)] + [(99, None, "fr"), (98, "x", None)], "id long, text string, lang string")
    model = language_id.train(learn)
    ask = spark.createDataFrame([(1, "und das der"), (2, "and the of"), (3, None), (4, "123 ½"), (5, ""), (6, LONG)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(ask, model).collect()}
    assert [got[i] for i in range(1, 6)] == ["de", "en", "und", "und", "und"] and got[6] in ("de", "en")
    assert language_id.identify(docs.limit(0), model).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, language_id.train(learn.limit(0))).collect()} == {"und"}


def brute_marginals(field, emissions):
    w = np.exp(field.steps)
    n = len(emissions)
    total, one = 0.0, np.zeros(n)
    for code in range(1 << n):
        tags = [code >> k & 1 for k in range(n)]
        value = np.exp(sum(e for e, t in zip(emissions, tags) if t)) * (np.exp(field.start) if tags[0] else 1)
        value *= np.prod([w[a, b] for a, b in zip(tags, tags[1:])])
        total += value
        one += value * np.array(tags)
    return one / total


def test_forward_backward_is_exact():
    rng = np.random.default_rng(2)
    field = toxicity.Field(*(np.zeros(4, np.float32) for _ in range(3)), rng.normal(size=(2, 2)), -0.7, np.zeros(4))
    sizes = np.array([1, 5, 9, 2])
    emissions = rng.normal(size=sizes.sum())
    first = toxicity._firsts(sizes)
    got, _, _ = toxicity.forward_backward(field, emissions, first)
    at = 0
    for size in sizes:
        assert np.allclose(got[at : at + size], brute_marginals(field, emissions[at : at + size]))
        at += size


def test_toxicity(spark, docs):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=40)
        if i % 4 == 0:
            words[rng.randrange(40)] = rng.choice(["vile", "nasty"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    train = spark.createDataFrame(rows, "doc_id long, text string")
    field = toxicity.train(train, spark.createDataFrame(labels, "doc_id long, toxic int"))
    ask = spark.createDataFrame([(1, "word1 vile word2"), (2, "word1 word2"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(ask, field).collect()}
    assert got[1]["score"] > 0.8 and [tuple(s) for s in got[1]["spans"]] == [(6, 10)]
    assert max(got[i]["score"] for i in (2, 3, 4)) < 0.3
    assert toxicity.score_documents(docs.limit(0), field).count() == 0
    flat = toxicity.train(train, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert {0 <= r["score"] < 0.5 for r in toxicity.score_documents(docs, flat).collect()} == {True}


def test_decontamination(spark):
    rng = random.Random(4)
    words = [f"t{i}" for i in range(4000)]
    items = [" ".join(rng.choices(words, k=30)) + ". " + " ".join(rng.choices(words, k=5)) + "." for _ in range(30)]
    texts = [(k, " ".join(rng.choices(words, k=200)) + " " + items[k].upper() + " " + " ".join(rng.choices(words, k=90))) for k in range(10)]
    texts += [(k, " ".join(rng.choices(words, k=300))) for k in range(10, 60)] + [(60, None), (61, ""), (None, items[20]), (62, items[21]), (62, items[21])]
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([*enumerate(items), (77, None), (78, "...")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {(k, k) for k in range(10)} | {(None, 20), (62, 21)}
    assert decontaminate.drop_leaks(docs, bench).count() == len(texts) - 13
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0 and decontaminate.leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_with_more_items_than_rank(spark):
    rng = random.Random(11)
    words = [f"t{i}" for i in range(3000)]
    items = [" ".join(rng.choices(words, k=10)) for _ in range(400)]
    texts = [(k, " ".join(rng.choices(words, k=150)) + " " + items[k] + " " + " ".join(rng.choices(words, k=150))) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == {(k, k) for k in range(60)}


def test_decontamination_of_long_items(spark):
    rng = random.Random(12)
    words = [f"t{i}" for i in range(3000)]
    items = [" ".join(rng.choices(words, k=size)) for size in (150, 200, 300, 500, 800)]
    texts = [(k, " ".join(rng.choices(words, k=170)) + " " + items[k] + " " + " ".join(rng.choices(words, k=90))) for k in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r["share"] for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {(k, k): 1.0 for k in range(5)}


def test_near_copies(spark):
    rng = random.Random(6)
    words = [f"t{i}" for i in range(3000)]
    base = [rng.choices(words, k=400) for _ in range(40)]
    rows = [(k, " ".join(base[k])) for k in range(40)]
    for k in range(20):
        copy = list(base[k])
        copy[200] = "changed"
        rows.append((100 + k, " ".join(copy)))
    docs = spark.createDataFrame([(*r, "z") for r in [*rows, (None, rows[0][1]), (None, None)]], "doc_id long, text string, component string")
    left = {r["doc_id"] for r in simhash.drop_near_copies(docs).collect()}
    assert left >= set(range(40)) | {None} and len(left) <= 41 + 2
    assert simhash.drop_near_copies(docs.limit(0)).count() == 0


def test_the_filters_decide_what_becomes_a_group(docs, spark, monkeypatch):
    """A filter that knows nothing makes every slice's digests new ones."""
    whole = sorted((r["digest"], r["group_size"]) for r in exact_dedup.mark_copies(docs).collect())
    assert max(size for _, size in whole) == 3
    monkeypatch.setattr(exact_dedup.CuckooIndex, "probe", lambda self, digests: self.keys.limit(0))
    rows = exact_dedup.numbered(exact_dedup.digests(docs), "test")
    index = exact_dedup.indexed(rows)
    # Copies that fell into different slices are groups of their own now.
    assert index.keys.count() > len({digest for digest, _ in whole})


def test_an_overflowing_filter_is_rebuilt_from_its_keys():
    digests = [f"{k * 0x9E3779B97F4A7C15 % (1 << 64):016x}{k * 0xBF58476D1CE4E5B9 % (1 << 64):016x}" for k in range(2000)]
    small = exact_dedup.filled(None, digests[:100], [])
    rows = small.rows
    large = exact_dedup.filled(small, digests[100:], digests[:100])
    assert large.rows > rows
    assert large.contains(*exact_dedup.CuckooFilter.prints(digests)).all()


def test_pair_counts_are_those_of_all_passages(spark, monkeypatch):
    """Every document counts, in several passes over the terms, with long documents cut in stretches."""
    for name, value in (("CELLS", 3000), ("SLICE", 200), ("PORTION", 128), ("SEND_PAIRS", 5000)):
        monkeypatch.setattr(decontaminate, name, value)
    rng, size, half = np.random.default_rng(3), 61, decontaminate.HALF
    docs = [np.minimum(rng.integers(0, 80, n), size - 1) * (rng.random(n) < 0.6) for n in [0, 1, 31, 32, 33, 64, 65, 700, 160, 161, *rng.integers(0, 200, 2500)]]
    rows = [(k, words.astype("<u2").tobytes()) for k, words in enumerate(docs)]
    found = decontaminate.pair_counts(spark.createDataFrame(rows, "doc_id long, words binary"), "<u2", size).collect()
    upper, own, held = np.zeros((size, size)), np.zeros(size), np.zeros(size)
    for row in found:
        at = slice(row.slice * decontaminate.slice_rows(size), (row.slice + 1) * decontaminate.slice_rows(size))
        upper[at] = np.frombuffer(row.counts, dtype=np.int64).reshape(-1, size)
        own[at], held[at] = np.frombuffer(row.own, dtype=np.int64), np.frombuffer(row.held, dtype=np.int64)
    want = np.zeros((size, size))
    for words in docs:
        for start in range(0, max(len(words) - half, min(len(words), 1)), half):
            row = np.bincount(words[start : start + 2 * half], minlength=size).astype(float)
            row[0] = 0
            want += np.outer(row, row)
    assert np.array_equal(upper + upper.T + np.diag(own), want)
    assert held[0] == len(docs) and held[1:].tolist() == [sum(k in words for words in docs) for k in range(1, size)]


def test_toxicity_sends_each_text_once(spark, docs):
    """Kept columns, whole texts among them, do not travel through Python, and each text is scored once."""
    flat = toxicity.train(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    for spans in (True, False):
        scored = toxicity.score_documents(docs, flat, ("doc_id", "text"), spans=spans)
        kept = scored.filter("score < 2").select("*", (scored["score"] >= 0.3).alias("predicted"))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and plan.count("ArrowEvalPython") == 1 and plan.count("run(text") == 1, plan
        assert sorted(kept.select("doc_id", "text").collect(), key=repr) == sorted(docs.select("doc_id", "text").collect(), key=repr)


def test_a_task_gives_its_memory_back():
    """What a process holds after a task that needed much is near what it held before."""
    def own() -> int:
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096

    def run(batches):
        for _ in batches:
            held = [bytes(2000) for _ in range(100_000)]
            # A small thing that stays keeps the allocator's own way of shrinking from it.
            sys.kept_by_a_test = bytes(2000)
            yield own()
            del held

    before = own()
    (most,) = gives_back(run)(iter([1]))
    assert most > before + (100 << 20) and own() < before + (60 << 20)


def test_words_of_latin_texts_get_the_terms_that_the_pattern_finds():
    texts = [None, "", " \t", "a_b-c d\xa0e\x85f", "Größe, ÀÉÎ; x² ½ µ ªº", "naïve’s “quote” ſ İ Straße", "日本 a b", "a" * 70_000 + " b"]
    words = sorted({word for text in texts for word in decontaminate.words_of(text)})
    for width in (2, 4):
        terms = {word: k for k, word in enumerate(words[::2], 1)}
        code = decontaminate.coder(terms, width)
        for text in texts:
            found = np.frombuffer(code(text), dtype=f"<u{width}").tolist()
            assert found == [terms.get(word, 0) for word in decontaminate.words_of(text)]
    assert decontaminate.words_of(texts[5]) and max(map(ord, texts[4])) < 256


def test_passage_sums_leave_other_words_out():
    rng = np.random.default_rng(3)
    docs = [(rng.integers(0, 9, n) * rng.integers(0, 2, n)).astype("<u2") for n in (1, 5, 32, 33, 64, 65, 500)] + [np.zeros(40, dtype="<u2")]
    table = rng.integers(-9, 9, (9, 4)).astype(np.float32)
    # What lies in the row of all other words must not matter.
    table[decontaminate.OTHER] = np.nan
    halves, first = decontaminate._halves(docs)
    sums = decontaminate._sums(halves, table)
    want = [
        sum((table[word] for word in doc[start : start + decontaminate.PASSAGE] if word), np.zeros(4))
        for doc in docs for start in range(0, max(1, len(doc) - decontaminate.HALF), decontaminate.HALF)
    ]
    assert np.array_equal(sums[first] + sums[first + 1], np.array(want))


def test_rows_go_to_python_in_small_batches_and_groups_give_room_back(spark, monkeypatch):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    texts = spark.range(0, 8_000, 1, 1).selectExpr("repeat('x', 2000) as text")
    rows = scratch.stored(texts.mapInArrow(sizes, "n long, bytes long"), "test-batches").collect()
    assert sum(row["n"] for row in rows) == 8_000 and max(row["bytes"] for row in rows) < 6 << 20
    given = []
    monkeypatch.setattr(scratch, "give_back", lambda: given.append(1))
    assert scratch.gives_back_groups(lambda group: group + 1)(3) == 4 and given == [1]


def test_pair_counts_go_to_python_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SLICE", 128)
    monkeypatch.setattr(scratch, "BATCH_BYTES", "1k")
    made = decontaminate._gram

    def watched(idf, basis):
        run = made(idf, basis)

        def seen(batch):
            assert len(batch) <= 2, f"{len(batch)} slices at once"
            return batch

        return lambda batches: run(map(seen, batches))

    rng, size = np.random.default_rng(5), 61
    rows = [(k, rng.integers(0, size, 100).astype("<u2").tobytes()) for k in range(40)]
    pairs = scratch.stored(decontaminate.pair_counts(spark.createDataFrame(rows, "doc_id long, words binary"), "<u2", size).coalesce(1), "test")
    own, idf = np.zeros((1, size), dtype=np.float32), np.ones(size)
    whole = decontaminate.singular_vectors(pairs, own, idf, 4, 2)
    monkeypatch.setattr(decontaminate, "_gram", watched)
    assert pairs.count() > 20 and np.allclose(abs(decontaminate.singular_vectors(pairs, own, idf, 4, 2)), abs(whole), atol=1e-5)


def test_empty_tables_start_no_python(spark):
    index = exact_dedup.CuckooIndex(spark, 2)
    for table, schema in ((index.keys, exact_dedup.KEYS), (index.filters, exact_dedup.FILTERS)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert table.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        assert table.count() == 0 and "ExistingRDD" not in plan and "Python" not in plan
