"""Benchmark decontamination: a BM25 index of test items, searched with every training passage.

Items are cut into parts no longer than half a passage, so each part lies whole in some passage. A
posting holds a part's share of its own full BM25 score, which makes one threshold fair to short and
long parts: a passage retrieves every part of which it scores at least that share. Retrieval is
block-max WAND. What it finds is verified by word shingles of the item's question and its answer.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch, fresh, sliced, text_or_empty

PASSAGE = 96
STRIDE = PASSAGE // 2
SHARE = 0.5
SHINGLE = 5
OVERLAP = 0.8
POSTINGS_PER_BLOCK = 64
#: Most of a part's full score that terms outside the first bound may make up.
COMMON = 0.25
#: Bytes of item texts in one index; more items make more indexes, each of which is searched.
INDEX_BYTES = 32 << 20
_K1, _B = 1.2, 0.75
_WORD = re.compile(r"\w+")
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Han.
_DENSE = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_ANY_WORD = re.compile(rf"[^\W{_DENSE}]+|(?=\w)[{_DENSE}]")


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case; each character of a script without spaces is a word."""
    return (_WORD if text.isascii() else _ANY_WORD).findall(text.lower())


def shingles(words: list, size: int = SHINGLE) -> set[tuple]:
    """Shingles of ``size`` words; the whole sequence if it is shorter, none if it is empty."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer, all before it the question; one sentence is cut in the middle."""
    sentences = [w for s in re.split(r"(?<=[.!?:])\s+|\n+", text) if (w := words_of(s))]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    words = sentences[0] if sentences else []
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def _sides(whole: list, question: int) -> tuple[set, set]:
    """Shingles of the question, and those that reach into the answer; each at least one, if there are any."""
    if len(whole) < SHINGLE:
        return shingles(whole), shingles(whole)
    in_order = list(zip(*(whole[i:] for i in range(SHINGLE)), strict=False))
    inside = max(1, question - SHINGLE + 1)
    return set(in_order[:inside]), set(in_order[inside:] or in_order[-1:])


def parts_of(whole: list) -> list[Counter]:
    """Terms of the parts of an item, which are of about one size and no longer than half a passage."""
    size = math.ceil(len(whole) / math.ceil(len(whole) / STRIDE)) if whole else 1
    return [Counter(whole[i : i + size]) for i in range(0, len(whole), size)]


class Tally(NamedTuple):
    """Counts over a whole benchmark: parts, their words, and the parts that hold a term."""

    parts: int
    words: int
    found: dict[str, int]


class Index:
    """Postings by term: part numbers ascending, their shares, and the largest share of each block.

    Everything that grows with the items lies in flat arrays, one after the other: the postings of term t
    are those from ``first[t]`` to ``first[t + 1]``, its blocks those from ``block[t]`` on, an item's
    words are term numbers. Shingles are made of an item's words when it is retrieved. Shares follow
    ``tally``, which must cover ``items``; without it the items are the whole benchmark.
    """

    def __init__(self, items: Iterable[tuple[int, str]], tally: Tally | None = None):
        self.terms: dict[str, int] = {}
        self.names, self.questions, self.item_of = array("q"), array("i"), array("i")
        self.words, self.ends = array("i"), array("q", [0])  # of the items
        term, tf, sizes, lengths = array("i"), array("i"), array("i"), array("i")  # sizes, lengths: of the parts
        for item, text in items:
            question, answer = question_and_answer(text)
            whole = [self.terms.setdefault(w, len(self.terms)) for w in question + answer]
            if not whole:
                continue
            for part in parts_of(whole):
                term.extend(part.keys())
                tf.extend(part.values())
                sizes.append(len(part))
                lengths.append(part.total())
                self.item_of.append(len(self.names))
            self.names.append(item)
            self.questions.append(len(question))
            self.words.extend(whole)
            self.ends.append(len(self.words))
        self._weigh(_view(term), _view(tf), _view(sizes), _view(lengths), tally)
        self._essential(len(sizes))

    def _weigh(self, term: np.ndarray, tf: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, tally: Tally | None) -> None:
        """Postings from the terms of all parts, part by part."""
        count = np.bincount(term, minlength=len(self.terms))
        if tally is None:
            total, words, found = len(sizes), int(lengths.sum()), count
        else:
            total, words = tally.parts, tally.words
            found = np.fromiter((tally.found[t] for t in self.terms), np.int64, len(self.terms))
        part = np.repeat(np.arange(len(sizes)), sizes)
        norm = _K1 * (1 - _B + _B * lengths / (words / max(1, total)))
        rare = np.log(1 + (total - found + 0.5) / (found + 0.5))
        weight = rare[term] * tf * (_K1 + 1) / (tf + norm[part])
        share = weight / np.bincount(part, weight, len(sizes))[part]
        order = np.argsort(term, kind="stable")
        first = np.concatenate(([0], np.cumsum(count)))
        blocks = -(-count // POSTINGS_PER_BLOCK)
        block = np.concatenate(([0], np.cumsum(blocks)))
        inside = np.arange(block[-1]) - np.repeat(block[:-1], blocks)
        starts = np.repeat(first[:-1], blocks) + inside * POSTINGS_PER_BLOCK
        share = share[order]
        top = np.maximum.reduceat(share, starts) if len(starts) else share
        self.first, self.block = array("q", first.astype(np.int64).tobytes()), array("q", block.astype(np.int64).tobytes())
        self.part, self.share = array("i", part[order].astype(np.int32).tobytes()), array("d", share.tobytes())
        self.top = array("d", top.tobytes())
        self.most = array("d", (np.maximum.reduceat(share, first[:-1]) if len(count) else share).tobytes())

    def postings(self, term: int) -> tuple[array, array, array]:
        """Part numbers, shares and the blocks' largest shares of a term."""
        held, blocks = slice(*self.first[term : term + 2]), slice(*self.block[term : term + 2])
        return self.part[held], self.share[held], self.top[blocks]

    def item(self, number: int) -> tuple[int, set, set, set, int]:
        """An item's id, its shingles, those of its question and of its answer, and their size."""
        whole = self.words[self.ends[number] : self.ends[number + 1]].tolist()
        size = min(SHINGLE, len(whole))  # an item of fewer than five words is one shingle
        return self.names[number], shingles(whole), *_sides(whole, self.questions[number]), size

    def n_bytes(self) -> int:
        """Bytes of the flat arrays; the table of terms comes on top."""
        arrays = (a for a in vars(self).values() if isinstance(a, (array, np.ndarray)))
        return sum(a.nbytes if isinstance(a, np.ndarray) else a.itemsize * len(a) for a in arrays)

    def _essential(self, parts: int) -> None:
        """Leaves the commonest terms out of the first bound as long as no part owes them much.

        ``owed`` is what a part can get from them; ``length`` is how many postings of a term count.
        """
        self.length = np.append(np.diff(_view(self.first, np.int64)), 0)  # last: words outside the index
        numbers, shares = _view(self.part), _view(self.share, np.float64)
        self.owed = np.zeros(parts)
        for t in np.argsort(-self.length[:-1], kind="stable").tolist():
            held = slice(*self.first[t : t + 2])
            after = self.owed[numbers[held]] + shares[held]
            if after.max(initial=0.0) > COMMON:
                break
            self.owed[numbers[held]] = after
            self.length[t] = 0

    def promising(self, terms: np.ndarray, windows: int, share: float) -> list[int]:
        """Passages in which some part could reach ``share``: all others need no search.

        Passages are two neighbouring stretches. A stretch counts each of its terms once, a passage
        possibly twice, so the sum over essential terms plus ``owed`` is an upper bound.
        """
        at = np.nonzero(self.length[terms] > 0)[0]
        pairs = np.unique((at // STRIDE) * len(self.length) + terms[at])
        stretch, term = np.divmod(pairs, len(self.length))
        count = self.length[term]
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = np.repeat(_view(self.first, np.int64)[term], count) + inside
        part, gain = _view(self.part)[place].astype(np.int64), _view(self.share, np.float64)[place]
        stretch = np.repeat(stretch, count)
        key = np.concatenate((stretch * len(self.owed) + part, (stretch - 1) * len(self.owed) + part))
        known, where = np.unique(key, return_inverse=True)
        sums = np.bincount(where, np.concatenate((gain, gain)), len(known))
        window, part = np.divmod(known, len(self.owed))
        good = (sums + self.owed[part] >= share - 1e-6) & (window >= 0) & (window < windows)
        return np.unique(window[good]).tolist()

    def retrieve(self, terms: list[int], share: float) -> dict[int, float]:
        """All parts that score at least ``share`` for the different ``terms``: block-max WAND."""
        share -= 1e-9
        cursors = [[self.part[self.first[t]], self.first[t], t] for t in terms]  # part, place, term
        found = {}
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                bound += self.most[t]
                if bound >= share:
                    pivot = i
                    break
            if pivot < 0:
                break
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            at_block, border = 0.0, math.inf
            for c in cursors[: pivot + 1]:
                start, end = self.first[c[2]], self.first[c[2] + 1]
                block = self._block(c[2], c[1], part)
                if start + block * POSTINGS_PER_BLOCK < end:
                    at_block += self.top[self.block[c[2]] + block]
                    last = min(end, start + (block + 1) * POSTINGS_PER_BLOCK) - 1
                    border = min(border, self.part[last] + 1)
            if at_block < share:
                # no part up to the nearest block border can do it; nor before the next cursor's part
                goal = min(border, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else math.inf)
                goal = max(goal, part + 1)
                cursors = self._advance(cursors, pivot, goal)
            elif cursors[0][0] == part:
                score = sum(self.share[at] for p, at, _ in cursors[: pivot + 1] if p == part)
                if score >= share:
                    found[part] = score
                cursors = self._advance(cursors, pivot, part + 1)
            else:
                cursors = self._advance(cursors, pivot, part)
        return found

    def _block(self, term: int, at: int, part: float) -> int:
        """The block of a term that would hold ``part``, not before place ``at``."""
        start, size = self.first[term], self.first[term + 1] - self.first[term]
        block = (at - start) // POSTINGS_PER_BLOCK
        while (block + 1) * POSTINGS_PER_BLOCK <= size and self.part[start + (block + 1) * POSTINGS_PER_BLOCK - 1] < part:
            block += 1
        return block

    def _advance(self, cursors: list[list[int]], pivot: int, goal: float) -> list[list[int]]:
        out = []
        for i, c in enumerate(cursors):
            if i <= pivot and c[0] < goal:
                term, end = c[2], self.first[c[2] + 1]
                at = max(c[1], self.first[term] + self._block(term, c[1], goal) * POSTINGS_PER_BLOCK)
                while at < end and self.part[at] < goal:
                    at += 1
                if at >= end:
                    continue
                c = [self.part[at], at, term]
            out.append(c)
        return out

    def leaks(self, text: str, share: float = SHARE, overlap: float = OVERLAP) -> list[tuple[int, float, float, float]]:
        """Items found in a text: (item_id, best share, question overlap, answer overlap)."""
        if share <= COMMON:
            raise ValueError(f"share must exceed {COMMON}")
        words = words_of(text)
        if not words or not self.terms:
            return []
        none = len(self.most)
        terms = np.fromiter((self.terms.get(w, none) for w in words), dtype=np.int64, count=len(words))
        windows = max(1, -(-(len(words) - STRIDE) // STRIDE))
        best: dict[int, float] = {}
        seen: dict[int, set] = defaultdict(set)
        items: dict[int, tuple] = {}
        for s in (w * STRIDE for w in self.promising(terms, windows, share)):
            here = set(terms[s : s + PASSAGE].tolist()) - {none}
            for part, score in self.retrieve(list(here), share).items():
                item = self.item_of[part]
                best[item] = max(score, best.get(item, 0.0))
                if item not in items:
                    items[item] = self.item(item)
                seen[item] |= shingles(terms[s : s + PASSAGE].tolist(), items[item][-1])
        out = []
        for item, score in best.items():
            name, whole, question, answer, _ = items[item]
            held = seen[item]
            in_question, in_answer = (len(s & held) / len(s) if s else 1.0 for s in (question, answer))
            both = in_question >= overlap and in_answer >= overlap
            if both or len(whole & held) >= overlap * len(whole):
                out.append((name, score, in_question, in_answer))
        return out


def _view(values: array, kind: type = np.int32) -> np.ndarray:
    """A flat array for numpy, without a copy."""
    return np.frombuffer(values, dtype=kind)


def indexes(benchmark: DataFrame, most: int = INDEX_BYTES) -> Iterator[Index]:
    """Indexes of at most about ``most`` bytes of item texts each; null and wordless items are left out.

    They are made one after the other: the driver holds one at a time. Shares are those of one index
    over the whole benchmark, whose terms are counted beforehand where there are more indexes.
    """
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text"))
        .where(F.col("item_id").isNotNull() & (F.col("text") != ""))
        .distinct()
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, math.ceil(size / most))
    numbered = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    scratch = counted = None
    if shards > 1:
        scratch = Scratch(benchmark.sparkSession, "decontaminate")
        counted = scratch.write(_tallies(numbered), "tallies")
    try:
        for i in range(shards):
            tally = None if counted is None else _tally(counted.where(F.col("shard") == i))
            rows = numbered.where(F.col("shard") == i).orderBy("item_id", "text").toLocalIterator()
            yield Index(((r["item_id"], r["text"]) for r in rows), tally)
    finally:
        if scratch is not None:
            scratch.clean()


def _tallies(numbered: DataFrame) -> DataFrame:
    """``(shard, term, n, words)``: for every term of a shard the parts of the whole benchmark that hold it.

    The row without a term has the number of all parts and of their words.
    """
    kind = "shard long, term string, n long, words long"
    each = numbered.select("shard", "text").mapInArrow(_count_terms, kind)
    per_shard = each.groupBy("shard", "term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    whole = Window.partitionBy("term")  # a row a shard
    return per_shard.select("shard", "term", F.sum("n").over(whole).alias("n"), F.sum("words").over(whole).alias("words"))


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        n: Counter = Counter()
        words: Counter = Counter()
        for shard, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            question, answer = question_and_answer(text)
            for part in parts_of(question + answer):
                n.update((shard, t) for t in part)
                n[shard, None] += 1
                words[shard, None] += part.total()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([s for s, _ in n], pa.int64()),
                pa.array([t for _, t in n], pa.string()),
                pa.array(list(n.values()), pa.int64()),
                pa.array([words[k] for k in n], pa.int64()),
            ],
            ["shard", "term", "n", "words"],
        )


def _tally(counted: DataFrame) -> Tally:
    rows = counted.collect()
    parts, words = next(((r["n"], r["words"]) for r in rows if r["term"] is None), (0, 0))
    return Tally(parts, words, {r["term"]: r["n"] for r in rows if r["term"] is not None})


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)``, one row per leaked item of a row.

    A leak is an item whose question and answer both, or which as a whole, has at least four fifths of
    its five-word shingles in the passages that retrieve it; an item of fewer words must occur as a
    whole, word by word. Letters count in either case, marks do not count; see ``words_of``. Null and empty texts hold no leaks; rows that repeat an id are searched one by one; an
    empty benchmark gives no rows. The benchmark does not grow with the corpus; its size is measured,
    and one that exceeds an index is searched index by index, each over all documents.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = None
    for index in indexes(benchmark):
        part = given.mapInArrow(
            _finder(docs, index),
            "doc_id long, item_id long, score double, question_overlap double, answer_overlap double",
        )
        out = part if out is None else out.unionByName(part)
    return out


def _finder(docs: DataFrame, index: Index):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = shared.value
        for b in sliced(batches):
            got = [
                (d, *leak)
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                for leak in ix.leaks(t)
            ]
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[i] for g in got], k) for i, k in enumerate(kinds)],
                ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    return find


def drop_leaky(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a leaked item, with all their columns; see ``leaks``."""
    for index in indexes(benchmark):
        docs = _without(docs, index)
    return docs


def _without(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)
    width, names = len(docs.columns), docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix: Index = shared.value
        for b in sliced(batches):
            keep = pa.array([not ix.leaks(t) for t in b.column(width).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(i).filter(keep) for i in range(width)], names)

    return docs.select("*", text_or_empty().alias(fresh(docs, "text_"))).mapInArrow(clean, docs.schema)
