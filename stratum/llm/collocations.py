"""Phrase collocations by top-order marginalisation.

Every word begins exactly one window of the next ``ORDER`` words of its piece, padded with nulls at the piece's end. A phrase of
any length occurs as often as windows begin with it, so only the longest windows are ever counted, and ROLLUP sums
them to the counts of their shorter prefixes.

1. *Words.* Counts per language and word, and the words, pairs and triples that hold much of a block: what begins 1 / HOT_SHARE of all windows has at
   least half of them in blocks where it has half that share, so the lists of hot ones are complete at twice that share and none is longer than ``HOT_SHARE``.
2. *Windows.* A word under ``least`` can be in no phrase, so windows end before it as before a piece's end; a bit map of fixed size, whatever the
   vocabulary, tells frequent words (a rare one that shares a bit with one costs some rows and changes no result). Lead columns w1 to w4 over each piece, windows counted within a block of text before they are shuffled. Those of a block with
   one w1 travel together, as lines of text, at most ``LINES`` a row.
3. *Roll-up.* Rows are dealt by w1; hot words by w2 as well, hot pairs by w3, hot triples by w4, so none is one task's. All windows of a pair are
   in one partition then, unless it is hot. By sums over the sorted partition, windows of pairs under ``least`` go (no phrase that begins with such a
   pair can count); by sums over what is left, those of triples under ``least`` end after their pair. ROLLUP over w3 and w4 sums what is left, which each task has reduced
   to a row per phrase before it is shuffled; what is summed for hot pairs and triples is a part of each, a few rows that meet in one small aggregate more.
4. *Scores.* Parts of a phrase occur at least as often as the phrase, so whatever is needed is among the rows that stayed.

Words are case-folded for A-Z only; pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``. Null text is empty, a null language ``und``. Repeated rows
count as often as they come; ids play no role. Long texts are taken whole, in blocks. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .scratch import Stored, bit_map

ORDER = 4
BLOCK_WINDOWS = 1_250_000
HOT_SHARE = 512
HOT_PARTS = 64
# Where the numbers of hot words', pairs' and triples' parts begin.
WORD_PARTS, PAIR_PARTS, TRIPLE_PARTS = 1, 1 + HOT_PARTS, 1 + 2 * HOT_PARTS
LINES = 4096
MAP_BITS = 1 << 24
SEED = 42
HALF, LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
# A-Z to a-z, and every separator of pieces to a line feed.
FOLD = bytes.maketrans(bytes(range(0x41, 0x5B)) + b".,;:!?\x0b\x0c\x0d", bytes(range(0x61, 0x7B)) + b"\n" * 9)


class Block:
    """Words of one language, coded by order of appearance from 1; 0 pads each piece's end."""

    def __init__(self):
        self.codes: defaultdict[bytes, int] = defaultdict(count(1).__next__)
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: str) -> None:
        words: list[bytes] = []
        pad = [b"\n"] * (ORDER - 1)
        for piece in text.encode("utf-8", "replace").translate(FOLD).split(b"\n"):
            found = piece.split()
            if found:
                words += found
                words += pad
        if words:
            self.codes[b"\n"] = 0
            self.parts.append(np.fromiter(map(self.codes.__getitem__, words), dtype=np.uint32, count=len(words)))
            self.size += len(words)

    def columns(self, often: np.ndarray | None = None) -> list[np.ndarray]:
        """w1 to w4 of each window by leads over the words; padding is 0, and so is what comes after it or is not ``often``."""
        flat = np.concatenate([*self.parts, np.zeros(ORDER - 1, dtype=np.uint32)])
        if often is not None:
            flat = np.where(often[flat], flat, np.uint32(0))
        start = np.flatnonzero(flat[: len(flat) - ORDER + 1])
        columns = [flat[start + k] for k in range(ORDER)]
        for k in range(2, ORDER):
            columns[k][columns[k - 1] == 0] = 0
        return columns

    def frequent(self, lang: str, bits: np.ndarray) -> np.ndarray:
        """Per code whether the bit map holds the word."""
        seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
        words = self.codes.items()
        at = np.fromiter((xxhash.xxh64_intdigest(word, seed) % MAP_BITS for word, _ in words), dtype=np.int64, count=len(words))
        often = np.zeros(len(words) + 1, dtype=bool)
        often[np.fromiter((code for _, code in words), dtype=np.int64, count=len(words))] = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        often[0] = False
        return often

    def words(self) -> pa.Array:
        names: list[bytes | None] = [None] * (len(self.codes) + 1)
        for word, code in self.codes.items():
            names[code] = word
        names[0] = None
        return pa.array(names, pa.binary()).cast(pa.string())


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, Block]]:
    open_: dict[str, Block] = {}
    total = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            name = lang.as_py()
            block = open_.setdefault(name, Block())
            before = block.size
            block.add(text.as_py())
            total += block.size - before
            if total >= most:
                yield from open_.items()
                open_, total = {}, 0
    yield from open_.items()


def _counted(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows given by 64-bit columns, where each distinct one first lies in sorted order, and how often it comes."""
    order = np.lexsort(keys[::-1])
    changed = np.zeros(len(order), dtype=bool)
    changed[:1] = True
    for key in keys:
        sorted_ = key[order]
        changed[1:] |= sorted_[1:] != sorted_[:-1]
    starts = np.flatnonzero(changed)
    return order[starts], np.diff(np.append(starts, len(order)))


def _slices(lang: str, columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    rows = len(columns[0])
    for start in range(0, rows, 65_536):
        part = [column.slice(start, 65_536) for column in columns]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part[0]), pa.string()), *part], names=["lang", *names])


def _two(names: pa.Array, pairs: np.ndarray) -> list[pa.Array]:
    """The words of the upper and lower half of packed codes."""
    return [names.take(pa.array(half.astype(np.int64))) for half in (pairs >> HALF, pairs & LOW)]


def _count_words(most: int, share: int):
    """(lang, w1, w2, w3, n): words with w2 and w3 null, and the pairs (w3 null) and triples that hold much of their block."""
    names_of = ["w1", "w2", "w3", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, most):
            if not block.size:
                continue
            first, second, third, _ = block.columns()
            names = block.words()
            tally = np.bincount(first, minlength=len(names))
            codes = np.flatnonzero(tally)
            none = pa.nulls(len(codes), pa.string())
            yield from _slices(lang, [names.take(pa.array(codes)), none, none, pa.array(tally[codes])], names_of)
            # A pair holds no more than its words do, a triple no more than its pair.
            enough = -(-int(tally.sum()) // (2 * share))
            often = tally >= enough
            first, second, third = (column[often[first] & often[second] & (second > 0)] for column in (first, second, third))
            pairs, at, n = np.unique((first.astype(np.uint64) << HALF) | second, return_inverse=True, return_counts=True)
            heavy = n >= enough
            left, right = _two(names, pairs[heavy])
            yield from _slices(lang, [left, right, pa.nulls(len(left), pa.string()), pa.array(n[heavy])], names_of)
            inside = heavy[at] & (third > 0)
            triples, n = np.unique((at[inside].astype(np.uint64) << HALF) | third[inside], return_counts=True)
            triples, n = triples[n >= enough], n[n >= enough]
            left, right = _two(names, pairs[(triples >> HALF).astype(np.int64)])
            yield from _slices(lang, [left, right, names.take(pa.array((triples & LOW).astype(np.int64))), pa.array(n)], names_of)

    return run


Hot = list[tuple[str, "str | None", "str | None"]]


def _parts(block: Block, high: np.ndarray, low: np.ndarray, hot: Hot) -> np.ndarray:
    """0, or for hot words, pairs and triples a number that follows from the word after them."""
    part = np.zeros(len(high), dtype=np.int32)
    codes = [[block.codes.get(word.encode(), 0) for word in some if word is not None] for some in hot]
    codes = [some for some in codes if all(some)]
    if codes:
        mark = np.zeros(len(block.codes) + 1, dtype=np.int32)
        for word, number in block.codes.items():
            mark[number] = xxhash.xxh64_intdigest(word) % HOT_PARTS if number else 0

        def packed(length: int) -> list:
            return [some for some in codes if len(some) == length]

        one = np.isin(high >> HALF, np.array([a for a, in packed(1)], dtype=np.uint64))
        part[one] = WORD_PARTS + mark[(high[one] & LOW).astype(np.int64)]
        two = np.isin(high, np.array([(a << 32) | b for a, b in packed(2)], dtype=np.uint64))
        part[two] = PAIR_PARTS + mark[(low[two] >> HALF).astype(np.int64)]
        for a, b, c in packed(3):
            three = np.flatnonzero((high == np.uint64((a << 32) | b)) & (low >> HALF == np.uint64(c)))
            part[three] = TRIPLE_PARTS + mark[(low[three] & LOW).astype(np.int64)]
    return part


def _count_windows(most: int, shared, hot: dict[str, Hot]):
    """(lang, w1, part, tails): padded windows of two words or more, counted within a block; a tail is ``w2 w3 w4`` and, if over 1, a tab and the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, most):
            if not block.size:
                continue
            w1, w2, w3, w4 = block.columns(block.frequent(lang, np.frombuffer(shared.value, dtype=np.uint8)))
            whole = w2 > 0
            if not whole.any():
                continue
            high, low = ((x[whole].astype(np.uint64) << HALF) | y[whole] for x, y in ((w1, w2), (w3, w4)))
            at, n = _counted([high, low])
            high, low = high[at], low[at]
            part = _parts(block, high, low, hot.get(lang, []))
            if part.any():
                order = np.lexsort((part, high >> HALF))
                high, low, n, part = high[order], low[order], n[order], part[order]
            names = block.words()
            first, second = _two(names, high)
            lines = pc.binary_join_element_wise(second, *_two(names, low), " ", null_handling="skip")
            several = np.flatnonzero(n > 1)
            counted = pc.binary_join_element_wise(lines.take(pa.array(several)), pa.array(n[several]).cast(pa.string()), "\t")
            lines = pc.replace_with_mask(lines, pa.array(n > 1), counted)
            new = np.append(True, ((high[1:] >> HALF) != (high[:-1] >> HALF)) | (part[1:] != part[:-1]))
            starts = np.flatnonzero(new)
            since = np.arange(len(new)) - np.repeat(starts, np.diff(np.append(starts, len(new))))
            starts = np.flatnonzero(since % LINES == 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(new)), pa.int32()), lines)
            yield from _slices(lang, [first.take(pa.array(starts)), pa.array(part[starts]), pc.binary_join(lists, "\n")], ["w1", "part", "tails"])

    return run


def phrase_counts(
    docs: DataFrame, least: int, lang: str = "lang", text: str = "text", block: int = BLOCK_WINDOWS, share: int = HOT_SHARE
) -> tuple[DataFrame, DataFrame]:
    """Two tables: (lang, n) and (lang, phrase, words, f) of all phrases of 1 to ``ORDER`` words that occur ``least`` times or more."""
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    firsts = source.mapInArrow(_count_words(block, share), "lang string, w1 string, w2 string, w3 string, n long")
    firsts = Stored(firsts.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n")), "phrases-words").df
    words = firsts.filter("w2 is null")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    all_words = words.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, Hot] = {}
    # At most ``share`` words, as many pairs and as many triples, by what hot means, whatever the size of the table.
    for row in firsts.filter(F.col("n") * share >= all_words).select("lang", "w1", "w2", "w3").toLocalIterator():
        hot.setdefault(row.lang, []).append((row.w1, row.w2, row.w3))
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(words.filter(F.col("n") >= least).select(F.pmod(F.xxhash64("lang", "w1"), F.lit(MAP_BITS)).alias("bit")), MAP_BITS))
    dealt = source.mapInArrow(_count_windows(block, shared, hot), "lang string, w1 string, part int, tails string").repartition("lang", "w1", "part")
    lines = dealt.select("lang", "w1", "part", F.explode(F.split("tails", "\n")).alias("line"))
    # Plain cuts at one byte; lines without a tab stand for one window, words beyond a line's end are null.
    tail = F.substring_index("line", "\t", 1)
    times = F.when(F.contains("line", F.lit("\t")), F.substring_index("line", "\t", -1).cast("long")).otherwise(F.lit(1))
    cut = lines.select("lang", "w1", "part", F.substring_index(tail, " ", 1).alias("w2"), tail.alias("tail"), times.alias("n"))
    # The hash comes first, so rows are sorted by a number mostly. Windows of rare pairs, which are most, go before anything is done with the rest.
    pair = ["place", "lang", "w1", "part", "w2"]
    cut = cut.withColumn("place", F.xxhash64("w2", "w1", "lang")).withColumn("of_pair", F.sum("n").over(W.partitionBy(*pair)))
    hot_pair, hot_triple = F.col("part") >= PAIR_PARTS, F.col("part") >= TRIPLE_PARTS
    often = cut.filter(hot_pair | (F.col("of_pair") >= least)).withColumn("t", F.split("tail", " "))
    windows = often.select(*pair, F.get("t", F.lit(1)).alias("w3"), F.get("t", F.lit(2)).alias("w4"), "n")
    # A window whose triple is rare counts for its pair only, so it ends there.
    windows = windows.withColumn("of_triple", F.sum("n").over(W.partitionBy(*pair, "w3")))
    longer = hot_triple | (F.col("of_triple") >= least)
    kept = windows.select("lang", "w1", "part", "w2", F.when(longer, F.col("w3")).alias("w3"), F.when(longer, F.col("w4")).alias("w4"), "n")
    view = f"phrase_windows_{uuid.uuid4().hex}"
    kept.createOrReplaceTempView(view)
    rolled = docs.sparkSession.sql(f"""
        SELECT lang, w1, part, w2, w3, w4, sum(n) AS f, grouping(w3) AS g3, grouping(w4) AS g4 FROM {view}
        GROUP BY lang, w1, part, w2, ROLLUP (w3, w4)""")
    docs.sparkSession.catalog.dropTempView(view)
    # A padding null is no word: the prefix that ends before it is counted by the next shorter grouping.
    real = rolled.filter("(g3 = 1 or w3 is not null) and (g4 = 1 or w4 is not null)")
    whole = F.when(F.col("g3") == 1, ~hot_pair).when(F.col("g4") == 1, ~hot_triple).otherwise(True)
    real = real.filter(~whole | (F.col("f") >= least))
    summed = real.groupBy("lang", "w1", "w2", "w3", "w4").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    size = 2 + F.col("w3").isNotNull().cast("int") + F.col("w4").isNotNull().cast("int")
    longer = summed.select("lang", F.concat_ws(" ", "w1", "w2", "w3", "w4").alias("phrase"), size.alias("words"), "f")
    single = words.filter(F.col("n") >= least).select("lang", F.col("w1").alias("phrase"), F.lit(1).alias("words"), F.col("n").alias("f"))
    return totals, single.unionByName(longer)


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 30, best: int = 2000, covered: int = 80, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``best`` phrases of 2 to 4 words that occur ``least`` times or more.

    The score is floor(2000000 a / (l + r)) of the cut with the lowest one (ties: the earliest), l and r being the counts of its two parts. A phrase
    inside a longer one that has ``covered`` percent of its occurrences or more is dropped. Order: score and a falling, then the phrase's bytes.
    """
    totals, counts = phrase_counts(docs, least, lang, text)
    known = Stored(counts, "phrases-known").df
    f = known.select("lang", "phrase", "f")
    array = F.split("phrase", " ")
    phrases = known.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), "words", array.alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("w"), 1, F.col("k")).alias("left"), _part(F.col("w"), F.col("k") + 1, F.lit(ORDER)).alias("right"))
    sided = cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(
        f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    sided = sided.withColumn("score", F.expr("cast((cast(a as decimal(19,0)) * 2000000) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0))) as bigint)"))
    lowest = sided.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("score", "l", "r"), F.struct("score", "k")).alias("m")).select("lang", "phrase", "a", "m.*")
    spans = phrases.filter("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    spans = spans.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("from"))
    within = spans.groupBy("lang", _part(F.col("w"), F.col("from"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = lowest.join(within, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # A window group limit keeps each task's best rows only, so no language is gathered whole.
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
