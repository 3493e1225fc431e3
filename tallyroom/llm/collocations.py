"""Collocations: phrases of two to five words that are commoner than their parts let expect.

Prefix-free parsing cuts each piece of text where the hash of four consecutive words says so. A chunk
runs from one such trigger to the end of the next, so neighbours overlap by the trigger's four words and
any phrase of up to five words lies whole in the chunk that holds its first word before the closing
trigger: it is counted there and nowhere else. Equal passages are cut alike wherever they stand,
so the corpus becomes a dictionary of different chunks with frequencies, and phrases are counted inside
different chunks, times the frequency. Lengths are counted one after the other; a phrase is looked at
only if the two phrases one word shorter inside it passed (a hashed bitmap of fixed size says so,
which may let too many through and never too few), and every count is of the words themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch, sliced, text_or_empty

LONGEST = 5
LEAST = 100
FIRST = 2000
#: Words of a trigger, which neighbouring chunks share: one less than the longest phrase.
OVERLAP = LONGEST - 1
#: One window of words in so many is a trigger.
EVERY = 16
#: Bits of the bitmap that tells phrases that passed; 8 MB.
BITS = 26
#: Distinct chunks that a task counts before it hands them on, and bytes of chunks it counts phrases of at once.
HELD, AT_ONCE = 100_000, 8 << 20
#: Parts in which each language is ranked before the last ranking.
PARTS = 64

_NO_LANG = "und"
_ENDS = b".,;:!?\x0b\x0c\r"
_TO_LINES = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_PRIME, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of many space-joined texts, as one array: codes of different words, their hashes, ends of texts."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, b" ")
        self.ends = np.asarray(lists.offsets)[1:].astype(np.int64)
        coded = lists.values.dictionary_encode()
        self.codes = np.asarray(coded.indices)
        self.different = coded.dictionary
        each = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.different.to_pylist()), np.uint64, len(self.different))
        self.hashes = each[self.codes]
        self.starts = np.concatenate(([0], self.ends[:-1])).astype(np.int64)
        self.sizes = self.ends - self.starts
        #: for each word, how many words its text still has from it on
        self.left = np.repeat(self.ends, self.sizes) - np.arange(len(self.codes))

    def window_hashes(self, n: int) -> np.ndarray:
        """For each word the hash of the ``n`` words from it on (also beyond the end of its text: see ``left``)."""
        padded = np.concatenate((self.hashes, np.zeros(n, np.uint64)))
        total = np.zeros(len(self.hashes), np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                total = total * _PRIME + padded[i : i + len(total)]
            return _spread(total + np.uint64(n))


def _cut(pieces: list[bytes]) -> Iterator[tuple[int, bytes, bool]]:
    """(number of the piece, chunk, whether it ends the piece); pieces are words joined by one space."""
    words = Words(pa.array(pieces, pa.binary()))
    trigger = (words.window_hashes(OVERLAP) % np.uint64(EVERY) == 0) & (words.left >= OVERLAP)
    trigger[words.starts] = False  # a piece begins a chunk anyway
    at = np.nonzero(trigger)[0]
    owner = np.searchsorted(words.ends, at, side="right")
    lengths = np.asarray(pc.binary_length(words.different))[words.codes].astype(np.int64) + 1
    before = np.concatenate(([0], np.cumsum(lengths)))  # bytes before a word, each with one space
    base = before[words.starts]
    begin = np.zeros(len(pieces), np.int64).tolist()
    starts = (before[at] - base[owner]).tolist()
    stops = (before[at + OVERLAP] - base[owner] - 1).tolist()
    for i, start, stop in zip(owner.tolist(), starts, stops, strict=True):
        yield i, pieces[i][begin[i] : stop], False
        begin[i] = start
    for i, piece in enumerate(pieces):
        yield i, piece[begin[i] :], True


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, bool, bytes]] = Counter()

    def made() -> pa.RecordBatch:
        lang, last, chunk = zip(*counts, strict=True)
        out = pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(chunk, pa.binary()), pa.array(last, pa.bool_()), pa.array(counts.values(), pa.int64())],
            ["lang", "chunk", "last", "n"],
        )
        counts.clear()
        return out

    for b in sliced(batches):
        pieces: Counter[tuple[str, bytes]] = Counter()
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            pieces.update((lang, b" ".join(p.split())) for p in text.lower().translate(_TO_LINES).split(b"\n"))
        listed = [k for k in pieces if k[1]]
        if not listed:
            continue
        for i, chunk, last in _cut([p for _, p in listed]):
            counts[(listed[i][0], last, chunk)] += pieces[listed[i]]
        if len(counts) > HELD:
            yield made()
    if counts:
        yield made()


def dictionary(docs: DataFrame) -> DataFrame:
    """``(lang, chunk, last, n)``: the different chunks of each language and how often they occur.

    ``last`` chunks end a piece of text; the last four words of the others also begin the next one.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(_NO_LANG)).alias("lang"), text_or_empty().cast("binary").alias("text")
    )
    parsed = texts.mapInArrow(_parse, "lang string, chunk binary, last boolean, n long")
    return parsed.groupBy("lang", "chunk", "last").agg(F.sum("n").alias("n"))


def _phrase_hashes(words: Words, salts: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Places in the bitmap of the phrases of ``size`` words from each word on; languages are kept apart."""
    with np.errstate(over="ignore"):
        mixed = _spread(words.window_hashes(size) ^ np.repeat(salts, words.sizes))
    return mixed >> np.uint64(64 - bits)


def _salts(langs: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    each = np.fromiter((xxhash.xxh64_intdigest(x, 1) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return each[np.asarray(coded.indices)]


def _has(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


def _tally(size: int, chunks: pa.Table, bitmap: np.ndarray | None) -> pa.RecordBatch | None:
    """Weighted counts of the phrases of ``size`` words in some chunks, equal phrases combined."""
    langs, texts = chunks.column(0).combine_chunks(), chunks.column(1).combine_chunks()
    words = Words(texts)
    last = np.asarray(chunks.column(2).combine_chunks().cast(pa.int8()))
    # a phrase belongs to the chunk that it starts in before the closing trigger
    mine = words.left > np.repeat(np.where(last == 1, 0, OVERLAP), words.sizes)
    mine &= words.left >= size
    if bitmap is not None:
        bits = len(bitmap).bit_length() + 5
        passed = _has(bitmap, _phrase_hashes(words, _salts(langs), size - 1, bits))
        mine &= passed & np.concatenate((passed[1:], [False]))
    at = np.nonzero(mine)[0]
    if not len(at):
        return None
    text_of = np.searchsorted(words.ends, at, side="right")
    lang_codes = langs.dictionary_encode()
    keys = [words.codes[at + i] for i in range(size - 1, -1, -1)] + [np.asarray(lang_codes.indices)[text_of]]
    weight = np.asarray(chunks.column(3).combine_chunks())[text_of]
    order = np.lexsort(keys)
    different = np.zeros(len(at), bool)
    different[0] = True
    for k in keys:
        k = k[order]
        different[1:] |= k[1:] != k[:-1]
    firsts = np.nonzero(different)[0]
    shown = at[order[firsts]]
    parts = [words.different.take(pa.array(words.codes[shown + i])) for i in range(size)]
    phrase = pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0]
    return pa.RecordBatch.from_arrays(
        [langs.take(pa.array(text_of[order[firsts]])), phrase, pa.array(np.add.reduceat(weight[order], firsts))],
        ["lang", "phrase", "f"],
    )


def _count(size: int, passed: Broadcast | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bitmap = None if passed is None else passed.value
    held: list[pa.RecordBatch] = []
    for b in sliced(batches, 4096):
        held.append(b)
        if sum(x.column(1).nbytes for x in held) >= AT_ONCE:
            if (out := _tally(size, pa.Table.from_batches(held), bitmap)) is not None:
                yield out
            held = []
    if held and (out := _tally(size, pa.Table.from_batches(held), bitmap)) is not None:
        yield out


def _mark(size: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the bitmap with the bits of some phrases set."""
    for b in batches:
        words = Words(b.column(1))
        places = np.unique(_phrase_hashes(words, _salts(b.column(0)), size, bits)[words.starts])
        index, first = np.unique(places >> np.uint64(6), return_index=True)
        marks = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first) if len(first) else places
        yield pa.RecordBatch.from_arrays([pa.array(index.astype(np.int64)), pa.array(marks.view(np.int64))], ["i", "bits"])


def _bitmap(phrases: DataFrame, size: int, bits: int) -> np.ndarray:
    """2**bits bits, of which at most 2**(bits-6) words come to the driver however many phrases there are."""
    rows = (
        phrases.select("lang", F.col("phrase").cast("binary").alias("phrase"))
        .mapInArrow(partial(_mark, size, bits), "i long, bits long")
        .groupBy("i")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("i").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def phrases(docs: DataFrame, scratch: Scratch, least: int = LEAST, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of one to five words with f >= ``least``; ``(lang, n)``."""
    spark = docs.sparkSession
    chunks = scratch.write(dictionary(docs), "dictionary")
    passed: Broadcast | None = None
    levels = []
    for size in range(1, LONGEST + 1):
        counted = (
            chunks.mapInArrow(partial(_count, size, passed), "lang string, phrase binary, f long")
            .groupBy("lang", "phrase")
            .agg(F.sum("f").alias("f"))
            .select("lang", F.col("phrase").cast("string").alias("phrase"), F.lit(size).alias("size"), "f")
        )
        if size == 1:
            every = scratch.write(counted, "words")
            totals = scratch.write(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
            counted = every
        levels.append(scratch.write(counted.where(F.col("f") >= least), f"phrases-{size}"))
        if passed is not None:
            passed.destroy()
        if size < LONGEST:
            passed = spark.sparkContext.broadcast(_bitmap(levels[-1], size, bits))
    scratch.drop(chunks, every)
    return reduce(DataFrame.unionByName, levels), totals


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, bits: int = BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``first`` phrases by score.

    Texts have A-Z lower-cased and are split at ``.,;:!?`` and line ends; words are what blanks and
    tabs leave between them. A phrase occurs ``a`` times, overlaps included, and never across a
    split; a language has ``n`` words in all. The score is the least floor(1000 a n / (l r)) over the cuts of
    the phrase in two, whose parts occur ``l`` and ``r`` times, the earliest cut among equals. A phrase inside a longer
    one that occurs as often is left out. Ties go to the larger ``a``, then to the phrase in byte
    order. Null texts are empty, a null language is ``und``; repeated rows count as often as they stand
    there. No documents give no rows; other columns are ignored. ``bits`` (7 to 32) sizes the bitmap and
    changes the work, not the result.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    frequent, totals = phrases(docs, scratch, least, bits)
    words = F.split("phrase", " ")
    candidates = frequent.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    # one word more suffices: a phrase that occurs as often as a part two words shorter occurs as often as all between
    inside = (
        candidates.where("size > 2")
        .select(
            "lang",
            F.explode(
                F.array(F.slice("w", F.lit(1), F.col("size") - 1), F.slice("w", F.lit(2), F.col("size") - 1))
            ).alias("part"),
            "a",
        )
        .groupBy("lang", F.array_join("part", " ").alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    kept = (
        candidates.join(inside, ["lang", "phrase"], "left")
        .where("longer is null or longer < a")
        .join(totals, "lang")
        .select("lang", "phrase", "size", "a", "n", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select(
            "*",
            F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left_part"),
            F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right_part"),
        )
    )
    side = lambda name, count: frequent.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    scored = (
        kept.join(side("left_part", "l"), ["lang", "left_part"])
        .join(side("right_part", "r"), ["lang", "right_part"])
        .select(
            *("lang", "phrase", "a", "n", "k", "l", "r"),
            # 38 digits: 1000 a n stays below 10**38 for any corpus that fits 64-bit counts of up to 10**17
            F.expr(
                "cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
            ).alias("score"),
        )
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )
    scored = scratch.write(scored, "scored")
    by = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # what is not among the first of its part is not among the first of all
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*by)
    leaders = scored.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= first)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")
    return (
        leaders.withColumn("rank", rank)
        .where(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
