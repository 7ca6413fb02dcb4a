"""Collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

from stratum.llm import collocations as co

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, words int, head string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, least, best, covered):
    f, n = Counter(), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    kept = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = set()
    for (lang, words), a in kept.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * a >= covered * f[lang, words[i : i + size]]:
                    inside.add((lang, words[i : i + size]))
    rows = {}
    for (lang, words), a in kept.items():
        if (lang, words) not in inside:
            cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1))


def sample(rng):
    words = ["a", "b", "c", "D", "É", "é", "x-y", "\x1c", "日本", " "]
    texts = []
    for _ in range(150):
        parts = [rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", ";"]) for _ in range(rng.randrange(60))]
        texts.append((rng.choice(["en", "en", "de", None]), "".join(parts)))
    texts += [("en", None), ("de", ""), (None, " \t"), ("fr", "solo"), ("en", "a b c d " * 20_000)]
    return texts + [("en", "new york city hall")] * 40 + [("de", "der hut. der hut " + "z" * 100_000)] * 3


def found(spark, texts, **options):
    df = spark.createDataFrame([(1, text, lang, "p", 1, 1, "h") for lang, text in texts], SCHEMA)
    return sorted(tuple(r) for r in co.collocations(df, **options).collect())


def test_equals_plain_counts(spark):
    texts = sample(random.Random(5))
    for least, best in ((3, 25), (30, 2000)):
        assert found(spark, texts, least=least, best=best) == brute(texts, least, best, 80)


def test_hot_pairs_and_small_blocks(spark, monkeypatch):
    """Every pair that holds a twentieth of the windows is dealt out by what follows it, and blocks are cut often."""
    plain = co.phrase_counts
    monkeypatch.setattr(co, "phrase_counts", lambda docs, least, lang, text: plain(docs, least, lang, text, block=500, share=20))
    texts = sample(random.Random(6))
    assert found(spark, texts, least=3, best=2000) == brute(texts, 3, 2000, 80)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_rare_pairs_go_before_triples_are_summed(spark):
    """The sums of triples lie above those of pairs and their filter, so they see what is left only."""
    df = spark.createDataFrame([("a b c d", "en")], "text string, lang string")
    plan = co.phrase_counts(df, 3)[1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS of_triple") < plan.index("AS of_pair")
