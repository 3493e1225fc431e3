"""Token counts that follow edits: a segment tree over the leaves of each text.

A leaf is a stretch between sync points, places where white space follows another character: no
pre-token of the byte-level vocabulary reaches over one, whatever stands on either side. An edit can
only change the leaves it touches and, at its borders, the one before and the one after; those are cut
and encoded anew, and the sums on their paths to the root are updated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .secrets import Rule, found
from .store import sliced, text_or_empty
from .tokens import KNOWN, encoder

_SYNC = re.compile(r"(?<=\S)(?=[ \t\n\r])")
_HOST = r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: A local part starts where no longer one is cut, or where the last match ended: the matches are the leftmost
#: ones, and a long run of such characters is read once and not from each of its places.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
#: Personal data that the query masks, and what stands for it. A full stop may precede or follow a
#: network address, a further number may not; one that begins a mail address is left to that.
MASKS = (
    (Rule("mail", rf"{_LOCAL}{_HOST}", 1), "@", "<mail>"),
    (
        Rule(
            "ip",
            rf"(?<![0-9])(?<![0-9]\.)[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}(?!\.?[0-9])(?![A-Za-z0-9._%+-]*+{_HOST})",
            1,
        ),
        ".",
        "<ip>",
    ),
)


class Counts(dict):
    """leaf -> number of tokens; bounded, starts again when full."""

    def __init__(self, path: str):
        super().__init__()
        self.code = encoder(path)

    def __missing__(self, leaf: str) -> int:
        n = len(self.code.packed(leaf)) // 4
        if len(self) >= KNOWN // 2:
            self.clear()
        self[leaf] = n
        return n


class Tree:
    """Sums over the leaves of one text; ``total`` is the text's token count."""

    def __init__(self, text: str, counts: Counts):
        self.text, self.counts = text, counts
        self._build(*self._encode(_SYNC.split(text) if text else []))
        self.encoded = 0

    def _encode(self, leaves: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and token counts of leaves."""
        return tuple(np.fromiter(map(f, leaves), dtype=np.int64, count=len(leaves)) for f in (len, self.counts.__getitem__))

    def _build(self, lengths: np.ndarray, values: np.ndarray) -> None:
        self.ends = np.cumsum(lengths)
        self.width = 1 << max(0, len(values) - 1).bit_length()
        self.sums = np.zeros(2 * self.width, dtype=np.int64)
        self.sums[self.width : self.width + len(values)] = values
        low = self.width
        while low > 1:
            self.sums[low // 2 : low] = self.sums[low : 2 * low].reshape(-1, 2).sum(axis=1)
            low //= 2
        self._edited: list[tuple[int, int, str, np.ndarray, np.ndarray]] = []  # low, high, region and its leaves

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def apply(self, edits: list[tuple[int, int, str]]) -> int:
        """The count after replacing each ``text[start:end]``; positions are in the text before this call.

        Edits are taken by start; one that begins before the end of an earlier one is left out, as is
        one outside the text. Returns how many were applied.
        """
        self._settle()
        groups: list[tuple[int, int, list]] = []
        done, applied = 0, 0
        for start, end, new in sorted(edits):
            if start < done or end < start or end > len(self.text):
                continue
            done, applied = end, applied + 1
            low, high = self._leaf(start - 1), self._leaf(end)
            if groups and low <= groups[-1][1]:
                a, b, held = groups.pop()
                groups.append((a, max(b, high), [*held, (start, end, new)]))
            else:
                groups.append((low, high, [(start, end, new)]))
        for low, high, held in groups:
            self._replace(low, high, held)
        return applied

    def _leaf(self, at: int) -> int:
        """Number of the leaf that holds the character ``at``, or the nearest one."""
        return int(min(np.searchsorted(self.ends, max(at, 0), side="right"), max(0, len(self.ends) - 1)))

    def _replace(self, low: int, high: int, edits: list[tuple[int, int, str]]) -> None:
        begin = int(self.ends[low - 1]) if low else 0
        stop = int(self.ends[high]) if len(self.ends) else 0
        made, at = [], begin
        for start, end, new in edits:
            made += [self.text[at:start], new]
            at = end
        region = "".join([*made, self.text[at:stop]])
        leaves = _SYNC.split(region) if region else []
        self.encoded += len(leaves)
        lengths, values = self._encode(leaves)
        self._edited.append((low, high, region, lengths, values))
        self._set(low, int(values.sum()))
        for leaf in range(low + 1, high + 1):
            self._set(leaf, 0)

    def _settle(self) -> None:
        """Puts the regions of the batch before into text and leaves; nothing is encoded for it."""
        if not self._edited:
            return
        old_lengths, old_values = np.diff(self.ends, prepend=0), self.sums[self.width : self.width + len(self.ends)]
        texts, lengths, values, at = [], [], [], 0
        for low, high, region, new_lengths, new_values in self._edited:
            texts += [self._stretch(at, low), region]
            lengths += [old_lengths[at:low], new_lengths]
            values += [old_values[at:low], new_values]
            at = high + 1
        self.text = "".join([*texts, self._stretch(at, len(self.ends))])
        self._build(np.concatenate([*lengths, old_lengths[at:]]), np.concatenate([*values, old_values[at:]]))

    def _stretch(self, low: int, high: int) -> str:
        """Text of the leaves from ``low`` up to ``high``."""
        return self.text[int(self.ends[low - 1]) if low else 0 : int(self.ends[high - 1])] if low < high else ""

    def _set(self, leaf: int, value: int) -> None:
        node = self.width + leaf
        change = value - int(self.sums[node])
        while node and change:
            self.sums[node] += change
            node //= 2


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Counts(path)
    for b in sliced(batches):
        made = []
        for doc, text, edits in zip(*(c.to_pylist() for c in b.columns), strict=True):
            tree = Tree(text, counts)
            before = tree.total
            given = [(e["start"], e["end"], e["new"]) for e in edits if None not in e.values()]
            applied = tree.apply(given)
            made.append((doc, len(tree.ends), before, tree.total, applied, tree.encoded))
        names = ["doc_id", "n_leaves", "n_tokens", "n_tokens_edited", "n_edits", "n_reencoded"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], pa.int64()) for i in range(len(names))], names
        )


def count(docs: DataFrame, edits: Column, tokenizer: str) -> DataFrame:
    """Tokens of every text before and after its edits, and how many leaves were encoded again.

    ``edits`` is an array of (start, end, new) by code point. ``tokenizer`` must be a byte-level
    vocabulary without normalizer. Null text counts as empty, null edits as none; an edit with a null
    field, or one that overlaps an earlier one, is left out. Rows that repeat an id are counted one
    by one; no documents give no rows.
    """
    kind = "array<struct<start:int,end:int,new:string>>"
    given = docs.withColumn("_text", text_or_empty()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_text").alias("text"),
        F.coalesce(edits.cast(kind), F.array().cast(kind)).alias("edits"),
    )
    return given.mapInArrow(
        partial(_count, tokenizer),
        "doc_id long, n_leaves long, n_tokens long, n_tokens_edited long, n_edits long, n_reencoded long",
    )


def masks() -> Column:
    """Edits that replace e-mail and network addresses in ``_text``, and end the text with a line break."""
    kind = "array<struct<start:int,end:int,new:string>>"
    each = [
        F.when(
            F.contains("_text", F.lit(sign)),
            F.transform(found(rule, 0, "_text"), _edit(new)),
        ).otherwise(F.array().cast(kind))
        for rule, sign, new in MASKS
    ]
    size = F.length("_text")
    last = F.array(F.struct(size.alias("start"), size.alias("end"), F.lit("\n").alias("new")))
    return F.concat(*each, last)


def _edit(new: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(new).alias("new"))
