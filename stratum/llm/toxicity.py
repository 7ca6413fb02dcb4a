"""Toxic spans by a linear-chain conditional random field over words, summed up to document scores.

Labels exist for documents only, so the words get theirs first: a word of a toxic training document
counts as toxic if it is found in toxic documents far more often than chance allows (z of at least
``LEAST_Z``, and eight times as often as in others). From these tagged sequences the field learns weights of the word, of the words
beside it and of the tag before. Forward-backward gives each word's marginal; a logistic of the
expected number of toxic words and of the largest marginal, fitted to the document labels, is the
score, and runs of words with a marginal of one half or more are the offending spans.

Training uses at most ``docs_per_class`` labelled documents of each class, first by hash of the id and
not longer than ``LONGEST`` code points: a documented bound. Scoring reads every whole text.

Defined results: null and empty texts have no words and get the score of no toxic words. Repeated
rows score alike. With labels of one class only, that class's smoothed share is every score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import give_back, gives_back, stored

WORD = re.compile(r"\w+")
DIMS = 1 << 20
LONGEST = 50_000
LEAST_Z = 4.0
STRIDE = 128
WORDS_AT_ONCE = 1 << 17
KNOWN_WORDS = 100_000


class WordIds(dict):
    """Word to feature number, remembered for the words seen lately."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        number = self[word] = zlib.crc32(word.encode("utf-8", "replace")) % (DIMS - 1) + 1
        return number


@dataclass
class Field:
    """Weights of tag 1 by feature (own, before, after), transitions, start, and the document logistic."""

    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    steps: np.ndarray
    start: float
    document: np.ndarray

    def emissions(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Feature 0 stands beside the ends of a document."""
        left = np.where(first, 0, np.concatenate([[0], ids[:-1]]))
        last = np.concatenate([first[1:], [True]])
        right = np.where(last, 0, np.concatenate([ids[1:], [0]]))
        return np.clip(self.own[ids] + self.before[left] + self.after[right], -30, 30).astype(np.float64)


def _ratios(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t]) from x = 0, for all t.

    The steps are 2 by 2 matrices; runs of ``STRIDE`` of them are multiplied side by side, the runs'
    products chained, and the values filled in side by side again.
    """
    n = len(a)
    runs = -(-n // STRIDE)
    parts = [np.concatenate([v, np.full(runs * STRIDE - n, fill)]).reshape(runs, STRIDE).T.copy() for v, fill in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0))]
    m11, m12, m21, m22 = np.ones(runs), np.zeros(runs), np.zeros(runs), np.ones(runs)
    for k in range(STRIDE):
        p, q, r, s = (part[k] for part in parts)
        m11, m12, m21, m22 = p * m11 + q * m21, p * m12 + q * m22, r * m11 + s * m21, r * m12 + s * m22
        scale = 1.0 / (m11 + m12 + m21 + m22)
        m11, m12, m21, m22 = m11 * scale, m12 * scale, m21 * scale, m22 * scale
    x, starts = 0.0, np.empty(runs)
    for k, (p, q, r, s) in enumerate(zip(m11.tolist(), m12.tolist(), m21.tolist(), m22.tolist())):
        starts[k] = x
        x = (p * x + q) / (r * x + s)
    out, x = np.empty((STRIDE, runs)), starts
    for k in range(STRIDE):
        p, q, r, s = (part[k] for part in parts)
        x = (p * x + q) / (r * x + s)
        out[k] = x
    return out.T.ravel()[:n]


def forward_backward(field: Field, emissions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: the marginal of tag 1, and the forward and backward odds of tag 1 against tag 0.

    Documents lie one after the other; ``first`` marks their first words, which depend on no word before.
    """
    w = np.exp(field.steps)
    e = np.exp(emissions)
    one, zero = np.ones_like(e), np.zeros_like(e)
    begin = e * np.exp(field.start)
    ahead = _ratios(np.where(first, zero, e * w[1, 1]), np.where(first, begin, e * w[0, 1]),
                    np.where(first, zero, w[1, 0]), np.where(first, one, w[0, 0]))
    last = np.concatenate([first[1:], [True]])
    following = np.concatenate([e[1:], [1.0]])
    back = _ratios(*(v[::-1].copy() for v in (
        np.where(last, zero, w[1, 1] * following), np.where(last, one, w[1, 0]),
        np.where(last, zero, w[0, 1] * following), np.where(last, one, w[0, 0]),
    )))[::-1]
    odds = ahead * back
    return odds / (1 + odds), ahead, back


def _words(texts: list[str | None], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words and the number of words per text."""
    sizes, numbers = [], []
    look = ids.__getitem__
    for text in texts:
        found = WORD.findall(text.lower()) if text else []
        numbers.extend(map(look, found))
        sizes.append(len(found))
    return np.array(numbers, dtype=np.int32), np.array(sizes, dtype=np.int64)


def _firsts(sizes: np.ndarray) -> np.ndarray:
    first = np.zeros(int(sizes.sum()), dtype=bool)
    starts = np.cumsum(sizes) - sizes
    first[starts[sizes > 0]] = True
    return first


def _document_features(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per document: one, the logarithm of one plus the expected number of toxic words, the same of words that
    are toxic rather than not, and the largest marginal."""
    features = np.zeros((len(sizes), 4))
    features[:, 0] = 1
    has = sizes > 0
    if has.any():
        starts = (np.cumsum(sizes) - sizes)[has]
        features[has, 1] = np.log1p(np.add.reduceat(marginals, starts))
        features[has, 2] = np.log1p(np.add.reduceat(np.where(marginals >= 0.5, marginals, 0), starts))
        features[has, 3] = np.maximum.reduceat(marginals, starts)
    return features


def _toxic_words(texts: list[str], toxic: np.ndarray) -> set[str]:
    inside, outside = Counter(), Counter()
    for text, label in zip(texts, toxic):
        (inside if label else outside).update(set(WORD.findall(text.lower())))
    share = toxic.mean()
    odds = share / (1 - share)
    found = set()
    for word, n in inside.items():
        expected = (n + outside[word]) * share
        if (n - expected) / np.sqrt(expected + 1) >= LEAST_Z and n >= 8 * odds * (outside[word] + 0.5):
            found.add(word)
    return found


def _chunks(ids: np.ndarray, sizes: np.ndarray) -> list[slice]:
    """Runs of whole documents of about ``WORDS_AT_ONCE`` words."""
    ends = np.cumsum(sizes)
    cuts, start = [], 0
    for end in ends.tolist():
        if end - start >= WORDS_AT_ONCE:
            cuts.append(slice(start, end))
            start = end
    return [*cuts, slice(start, len(ids))] if start < len(ids) else cuts


def _fit_field(ids: np.ndarray, first: np.ndarray, tags: np.ndarray, chunks: list[slice], rounds: int, rate: float, decay: float) -> Field:
    """Gradient ascent on the likelihood of the tags, step sizes by past gradients (Adagrad).

    Gradients are summed over chunks of documents, so memory is that of one chunk and of the weights.
    """
    field = Field(*(np.zeros(DIMS, dtype=np.float32) for _ in range(3)), np.zeros((2, 2)), 0.0, np.zeros(4))
    past: dict[str, np.ndarray] = {}

    def move(name: str, weights: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        past[name] = past.get(name, 1e-8) + gradient**2
        return weights + (rate * gradient / np.sqrt(past[name])).astype(weights.dtype)

    for _ in range(rounds):
        sums = {name: np.zeros(DIMS, dtype=np.float32) for name in ("own", "before", "after")}
        steps, start = np.zeros((2, 2)), 0.0
        for part in chunks:
            own, heads, tag = ids[part], first[part], tags[part]
            left = np.where(heads, 0, np.concatenate([[0], own[:-1]]))
            right = np.where(np.concatenate([heads[1:], [True]]), 0, np.concatenate([own[1:], [0]]))
            emissions = field.emissions(own, heads)
            marginal, ahead, back = forward_backward(field, emissions, heads)
            miss = (tag - marginal).astype(np.float32)
            for name, index in (("own", own), ("before", left), ("after", right)):
                np.add.at(sums[name], index, miss)
            inner = np.flatnonzero(~heads)
            w, e, a, b = np.exp(field.steps), np.exp(emissions[inner]), ahead[inner - 1], back[inner]
            joint = np.stack([np.full(len(inner), w[0, 0]), w[0, 1] * e * b, a * w[1, 0], a * w[1, 1] * e * b])
            steps -= (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
            np.add.at(steps, (tag[inner - 1], tag[inner]), 1)
            start += float(miss[heads].sum())
        # Neighbours are held back: chance neighbours of a few toxic words say little.
        for name, pull in (("own", decay), ("before", 100 * decay), ("after", 100 * decay)):
            weights = getattr(field, name)
            setattr(field, name, move(name, weights, sums[name] - np.float32(pull) * weights))
        field.steps = move("steps", field.steps, steps - decay * field.steps)
        field.start = float(move("start", np.array(field.start), np.array(start)))
    return field


def _fit_logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Newton's method with a small ridge."""
    beta = np.zeros(features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (weights * (labels - p)) - 0.01 * beta
        curve = (features * (weights * p * (1 - p))[:, None]).T @ features + 0.01 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -3, 3)
    return beta


def train(
    docs: DataFrame, labels: DataFrame, docs_per_class: int = 800, rounds: int = 20, rate: float = 0.7, decay: float = 0.01,
    key: str = "doc_id", text: str = "text",
) -> Field:
    """The field and its document logistic from ``labels`` (key, toxic) and the texts of ``docs``.

    A document with several labels counts as toxic if one says so.
    """
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    ).withColumn("mix", F.xxhash64(F.lit("toxic"), "id"))
    classes = {row["toxic"]: row["n"] for row in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0)
    for label, n in classes.items():
        share = F.when(F.col("toxic") == label, F.lit(n)).otherwise(share)
    near = marks.filter(F.pmod("mix", F.lit(1 << 20)) * share < F.lit(4 * docs_per_class << 20))
    rank = F.row_number().over(W.partitionBy("toxic").orderBy("mix", "id"))
    # Written, so that its known size lets the texts stay where they are.
    chosen = stored(near.withColumn("rank", rank).filter(F.col("rank") <= docs_per_class).select("id", "toxic"), "toxic-ids")
    texts = docs.filter(F.length(text) <= LONGEST).select(F.col(key).alias("id"), F.col(text).alias("text"))
    # At most docs_per_class rows of each class, each of bounded length.
    sample = texts.join(chosen, "id").orderBy("id", "text").limit(4 * docs_per_class).toPandas()
    give_back()
    labels_of = sample["toxic"].to_numpy(np.int64)
    words = list(sample["text"])
    counts = np.array([classes.get(0, 0), classes.get(1, 0)], dtype=np.float64)
    if len(set(labels_of.tolist())) < 2:
        share_of = (counts[1] + 1) / (counts.sum() + 2)
        flat = Field(*(np.zeros(DIMS, dtype=np.float32) for _ in range(3)), np.zeros((2, 2)), -30.0, np.zeros(4))
        flat.document[0] = np.log(share_of / (1 - share_of))
        return flat
    lexicon = {zlib.crc32(word.encode()) % (DIMS - 1) + 1 for word in _toxic_words(words, labels_of)}
    ids, sizes = _words(words, WordIds())
    first = _firsts(sizes)
    owner = np.repeat(labels_of, sizes)
    tags = (np.isin(ids, np.fromiter(lexicon, dtype=np.int64, count=len(lexicon))) & (owner == 1)).astype(np.int64)
    chunks = _chunks(ids, sizes)
    field = _fit_field(ids, first, tags, chunks, rounds, rate, decay)
    marginals = np.concatenate([forward_backward(field, field.emissions(ids[c], first[c]), first[c])[0] for c in chunks] or [np.zeros(0)])
    taken = np.bincount(labels_of, minlength=2)
    weights = (counts / np.maximum(taken, 1))[labels_of]
    field.document = _fit_logistic(_document_features(marginals, sizes), labels_of, weights / weights.mean())
    # The driver, too, keeps what the training texts took.
    del sample, words
    give_back()
    return field


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Code-point offsets of the runs of toxic words."""
    spans: list[dict] = []
    before = -2
    lowered = text.lower()
    # Some letters become several when lower-cased; each of those stands at the place of the one that it came from.
    place = range(len(text)) if len(lowered) == len(text) else [k for k, letter in enumerate(text) for _ in letter.lower()]
    for k, word in enumerate(WORD.finditer(lowered)):
        if marginals[k] >= 0.5:
            start, end = place[word.start()], place[word.end() - 1] + 1
            if before == k - 1:
                spans[-1]["end"] = end
            else:
                spans.append({"start": start, "end": end})
            before = k
    return spans


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _tagger(shared, with_spans: bool):
    def tag(texts: list[str | None], ids: WordIds, field: Field) -> tuple[np.ndarray, list]:
        numbers, sizes = _words(texts, ids)
        spans: list = [[] for _ in texts]
        marginals = np.zeros(0)
        if len(numbers):
            first = _firsts(sizes)
            marginals, _, _ = forward_backward(field, field.emissions(numbers, first), first)
            if with_spans:
                ends = np.cumsum(sizes)
                for k in np.unique(np.searchsorted(ends, np.flatnonzero(marginals >= 0.5), side="right")).tolist():
                    spans[k] = _spans(texts[k], marginals[ends[k] - sizes[k] : ends[k]])
        logit = _document_features(marginals, sizes) @ field.document
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), spans

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field, ids = shared.value, WordIds()
        for column in columns:
            scores, spans, part, held = [np.zeros(0)], [], [], 0
            for value in column:
                text = value.as_py()
                part.append(text)
                held += len(text or "")
                if held >= 6 * WORDS_AT_ONCE:
                    done = tag(part, ids, field)
                    scores.append(done[0])
                    spans.extend(done[1])
                    part, held = [], 0
            if part:
                done = tag(part, ids, field)
                scores.append(done[0])
                spans.extend(done[1])
            made = [pa.array(np.concatenate(scores)), *[pa.array(spans, SPANS)] * with_spans]
            yield pa.StructArray.from_arrays(made, names=["score", *["spans"] * with_spans])

    return gives_back(run)


def score_documents(docs: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",), text: str = "text", spans: bool = True) -> DataFrame:
    """The kept columns, ``score`` and ``spans`` (start and end code points of offending runs) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = "struct<score:double" + ",spans:array<struct<start:int,end:int>>" * spans + ">"
    # Only the text goes to the tasks' Python and only the result comes back; the kept columns stay where they are.
    # Marked so that a filter on the score is not moved below it, which would score each text twice.
    score = F.arrow_udf(_tagger(shared, spans), kind).asNondeterministic()
    found = score(F.col(f"`{text}`")).alias("found")
    scored = docs.select(*[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)], found)
    return scored.select(*[F.col(f"k{i}").alias(name) for i, name in enumerate(keep)], "found.score", *["found.spans"] * spans)
