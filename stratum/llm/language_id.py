"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes. A byte costs the code length that
escape method C gives it: ``count / (n + d)`` in a context with ``n`` bytes of ``d`` kinds,
``d / (n + d)`` for an escape to the next shorter context, down to a uniform code. The
trees are frozen after training, so the cost of a byte depends on the three bytes before
it alone and is kept in a table; a text costs the sum over all its bytes, exactly. The
language with the shortest code wins, ties by name.

Training uses at most ``docs_per_language`` documents of each language, the first ones by hash of
the id, whole; a documented bound, so what travels to the tasks has a bound too. Scoring
reads every whole text, in blocks, with constant memory.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is
everything if nothing could be learned. A-Z counts as a-z. Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import id_text, stored

UNDETERMINED = "und"
KINDS = 64
BLOCK = 1 << 19
LETTER = regex.compile(r"\p{L}")


@dataclass
class PpmModel:
    """``symbols`` maps bytes to byte kinds; per language ``rows`` maps three kinds to a row of ``bits``."""

    languages: list[str]
    symbols: np.ndarray
    rows: list[np.ndarray]
    bits: list[np.ndarray]


def _kinds(texts_bytes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    return symbols[texts_bytes]


def _grams(symbols: np.ndarray):
    """Per language and four-kind gram, counts of one batch after another."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                sums: dict[int, int] = {}
                for text in part["text"]:
                    for _, block in _blocks(text):
                        grams, counts = np.unique(_codes(_kinds(block, symbols)), return_counts=True)
                        for gram, n in zip(grams.tolist(), counts.tolist()):
                            sums[gram] = sums.get(gram, 0) + n
                yield pd.DataFrame({"lang": lang, "gram": list(sums), "n": list(sums.values())})

    return count


def _blocks(text: str) -> Iterator[tuple[int, np.ndarray]]:
    """The text's bytes after three line breaks, in blocks that repeat the last three bytes of the one before."""
    raw = np.frombuffer(b"\n\n\n" + text.encode("utf-8", "replace").lower(), dtype=np.uint8)
    for start in range(0, len(raw) - 3, BLOCK):
        yield start, raw[start : start + BLOCK + 3]


def _codes(kinds: np.ndarray) -> np.ndarray:
    wide = kinds.astype(np.int32)
    return (wide[:-3] << 18) | (wide[1:-2] << 12) | (wide[2:-1] << 6) | wide[3:]


def _byte_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(256, dtype=np.int64)
    for batch in batches:
        for text in batch["text"]:
            total += np.bincount(np.frombuffer(text.encode("utf-8", "replace").lower(), dtype=np.uint8), minlength=256)
    yield pd.DataFrame({"byte": np.arange(256), "n": total})


def _tree(grams: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Cost rows of one language and the row of every three-kind context: its longest known suffix."""

    def mixed(table: np.ndarray, lower: np.ndarray) -> np.ndarray:
        n = table.sum(axis=1, keepdims=True)
        d = (table > 0).sum(axis=1, keepdims=True)
        total = np.maximum(n + d, 1)
        escape = np.where(n > 0, d / total, 1.0)
        return np.where(table > 0, table / total, escape * lower)

    two = np.zeros((KINDS**2, KINDS))
    np.add.at(two, ((grams >> 6) & 0xFFF, grams & 63), counts)
    one = two.reshape(KINDS, KINDS, KINDS).sum(axis=0)
    zero = one.sum(axis=0, keepdims=True)
    p0 = mixed(zero, np.full((1, KINDS), 1 / KINDS))
    p1 = mixed(one, np.repeat(p0, KINDS, axis=0))
    p2 = mixed(two, np.tile(p1, (KINDS, 1)))
    contexts, inverse = np.unique(grams >> 6, return_inverse=True)
    seen = np.bincount(inverse, weights=counts)
    kept = contexts[seen >= least]
    rows = (np.arange(KINDS**3) & 0xFFF).astype(np.int32)
    rows[kept] = KINDS**2 + np.arange(len(kept), dtype=np.int32)
    three = np.zeros((len(kept), KINDS))
    own = seen[inverse] >= least
    np.add.at(three, (np.searchsorted(kept, grams[own] >> 6), grams[own] & 63), counts[own])
    p3 = mixed(three, p2[kept & 0xFFF])
    return rows, -np.log2(np.concatenate([p2, p3])).astype(np.float32)


def train(labelled: DataFrame, docs_per_language: int = 600, least_context: int = 3) -> PpmModel:
    """Context trees from (id, text, lang); rows with a null text or language teach nothing."""
    usable = labelled.filter("text is not null and lang is not null").withColumn("mix", F.xxhash64(F.lit("train"), "id"))
    # A share of each language by hash, four times what is taken, goes to the ranking.
    least = usable.select("lang", "id", "mix").join(usable.groupBy("lang").agg(F.count("*").alias("n")), "lang").filter(
        F.pmod("mix", F.lit(1 << 20)) * F.col("n") < F.lit(4 * docs_per_language << 20)
    )
    order = W.partitionBy("lang").orderBy("mix", "id")
    picked = least.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= docs_per_language)
    # Written, so that its known size, a few rows per language, lets the texts stay where they are.
    ids = stored(picked.select("lang", "id").distinct(), "train-ids")
    chosen = stored(usable.select("lang", "id", "text").join(ids, ["lang", "id"], "left_semi").select("lang", "text"), "train-texts")
    # One row per byte value and per distinct gram of a bounded number of documents.
    bytes_seen = chosen.mapInPandas(_byte_counts, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).toPandas()
    order_by_count = bytes_seen.sort_values(["n", "byte"], ascending=[False, True])
    symbols = np.full(256, KINDS - 1, dtype=np.uint8)
    common = order_by_count[order_by_count["n"] > 0]["byte"].to_numpy()[: KINDS - 1]
    symbols[common] = np.arange(len(common))
    grams = chosen.mapInPandas(_grams(symbols), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    model = PpmModel([], symbols, [], [])
    for lang in sorted(grams["lang"].unique()):
        own = grams[grams["lang"] == lang]
        rows, bits = _tree(own["gram"].to_numpy(np.int64), own["n"].to_numpy(np.float64), least_context)
        model.languages.append(lang)
        model.rows.append(rows)
        model.bits.append(bits)
    return model


def code_lengths(texts: list[str], model: PpmModel) -> np.ndarray:
    """Bits of every text under every language, text by language."""
    bits = np.zeros((len(texts), len(model.languages)))
    pending: list[tuple[int, np.ndarray]] = []
    held = 0

    def flush() -> None:
        if not pending:
            return
        codes = np.concatenate([_codes(model.symbols[block]) for _, block in pending])
        bounds = np.concatenate([[0], np.cumsum([len(block) - 3 for _, block in pending])[:-1]])
        owners = np.array([owner for owner, _ in pending])
        contexts, last = codes >> 6, codes & 63
        for k, (rows, table) in enumerate(zip(model.rows, model.bits)):
            costs = table.ravel()[rows[contexts] * KINDS + last]
            np.add.at(bits[:, k], owners, np.add.reduceat(costs, bounds, dtype=np.float64))
        pending.clear()

    for owner, text in enumerate(texts):
        for _, block in _blocks(text):
            pending.append((owner, block))
            held += len(block)
            if held >= BLOCK:
                flush()
                held = 0
    flush()
    return bits


def _scorer(broadcast):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: PpmModel = broadcast.value
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            known = [i for i, text in enumerate(texts) if model.languages and text is not None and LETTER.search(text)]
            choice = np.full(len(texts), len(model.languages))
            score = np.zeros(len(texts))
            if known:
                bits = code_lengths([texts[i] for i in known], model)
                gap = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
                choice[known] = bits.argmin(axis=1)
                score[known] = gap.max(axis=1) / gap.sum(axis=1)
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names[choice], pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    return score


def identify(docs: DataFrame, model: PpmModel, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: the kept columns, lang_pred and score, the winner's share under equal priors."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[F.col(name).alias(f"k{i}") for i, name in enumerate(keep)], F.col(text).alias("text"))
    kinds = [f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))]
    scored = source.mapInArrow(_scorer(shared), ", ".join([*kinds, "lang_pred string", "score double"]))
    return scored.select(*[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)], "lang_pred", "score")


def learning_rows(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    """(id, text, lang) of the documents outside the held-out fold of crc32(id as text)."""
    return docs.filter(F.crc32(id_text()) % folds != held_out).select(F.col("doc_id").alias("id"), "text", "lang")
