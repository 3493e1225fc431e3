"""Spelling variants: words one edit apart, by a dictionary of pairs of trie nodes.

The words are walked in sorted order, once forwards and once reversed, which numbers the nodes of both
tries: a word of length L has L+1 prefix nodes and L+1 suffix nodes. A cut of a word at i is the pair
(prefix node i, suffix node L-i); a skipped letter is the pair (prefix node i, suffix node L-i-1).
Two words with the same skipped pair differ in that letter alone, and a skipped pair of one word that
is a cut of another is an insertion. Pairs are integers of exact meaning, so nothing is verified after.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import Scratch, sliced, text_or_empty

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: One occurrence in so many loses a letter before it is counted.
SPOILED = 31
#: Distinct words that a task counts before it hands its counts on.
HELD = 200_000

_CUT, _SKIP, _FIRST_SKIP = 0, 1, 2


def _count(least: int, spoiled: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # as UTF-8: A-Z and U+00C0 to U+00FF; lower() of bytes changes A-Z alone
    runs = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least).findall
    crc = zlib.crc32
    counts: Counter[bytes] = Counter()

    def made() -> pa.RecordBatch:
        kept = {w: n for w, n in counts.items() if n}
        counts.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(kept.keys(), pa.binary()).cast(pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"]
        )

    for b in sliced(batches):
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            found = runs(text.lower())
            counts.update(found)
            start = crc(doc + b":")
            for w in [w for w in found if not crc(w, start) % spoiled]:
                counts[w] -= 1
                letters = w.decode()
                if len(letters) > least:
                    at = crc(w, start) % len(letters)
                    counts[(letters[:at] + letters[at + 1 :]).encode()] += 1
            if len(counts) > HELD:
                yield made()
    if counts:
        yield made()


def occurrences(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, spoiled: int = SPOILED
) -> DataFrame:
    """``(word, n)``: words of whole texts with at least ``least_length`` code points that occur ``least_count`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Where ``spoiled``
    divides h, the crc32 of ``<doc_id>:<run>``, the run's letter h modulo its length is left out.
    Null texts have no words; a null doc_id is written as nothing. A run of any length is one word.
    """
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return (
        docs.select(ids.alias("doc"), text_or_empty().cast("binary").alias("text"))
        .mapInArrow(partial(_count, least_length, spoiled), "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, in blocks and then letter by letter."""
    at, most, step = 0, min(len(a), len(b)), 4096
    while at < most and a[at : at + step] == b[at : at + step]:
        at += step
    at = min(at, most)
    while at < most and a[at] == b[at]:
        at += 1
    return at


def _walk(key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of the nodes below the root on each word's path; a range counts from 0 for itself.

    The words of a range come sorted, so a word opens new nodes behind what it shares with the one before.
    """
    part = TaskContext.get().partitionId()  # type: ignore[union-attr]
    last, path, free, row = "", [], 0, 0
    for b in batches:
        flat: list[int] = []
        ends, fresh = [0], []
        for word in b.column(b.schema.get_field_index(key)).to_pylist():
            old = _shared(last, word)
            new = len(word) - old
            path = path[:old] + list(range(free, free + new))
            free += new
            last = word
            flat += path
            ends.append(len(flat))
            fresh += [i == 0 or word[i] != word[i - 1] for i in range(len(word))]
        offsets = pa.array(ends, pa.int32())
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                *b.columns,
                pa.array([part] * n, pa.int32()),
                pa.array(range(row, row + n), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(fresh, pa.bool_())),
            ],
            [*b.schema.names, "part_", "row_", "path_", "fresh_"],
        )
        row += n


def _joints(spark: SparkSession, walked: DataFrame, key: str) -> DataFrame:
    """One row per range: what to add to its node and row numbers, and the nodes it shares with earlier ranges.

    Its first word continues paths of the range before: nodes of the common prefix are the same. One row
    per range (its first and last word) comes to the driver; ranges are as many as shuffle partitions.
    """
    ends = (
        walked.groupBy("part_")
        .agg(
            F.min(key).alias("first"),
            F.max(F.struct(F.col(key).alias("word"), F.col("path_").alias("path"))).alias("last"),
            F.max(F.element_at("path_", -1)).alias("top"),
            F.count(F.lit(1)).alias("rows"),
        )
        .orderBy("part_")
        .collect()
    )
    out, word, path, base, rows = [], "", [], 1, 0
    for r in ends:
        held = path[: _shared(word, r["first"])]
        out.append((r["part_"], base, rows, held))
        word = r["last"]["word"]
        path = [held[v] if v < len(held) else base + v for v in r["last"]["path"]]
        base, rows = base + r["top"] + 1, rows + r["rows"]
    return spark.createDataFrame(out, "part_ int, base_ long, rows_ long, held_ array<long>")


def number_nodes(words: DataFrame, key: str, path: str, scratch: Scratch, row: str = "row_", fresh: str = "fresh_") -> DataFrame:
    """``words`` (distinct, not empty, in column ``key``) with the numbers of their trie nodes from the root, 0, down.

    ``row`` is the word's place in code-point order; ``fresh`` tells letters that differ from the one before.
    """
    spark = words.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema)
    walked = scratch.write(
        words.repartitionByRange(key)
        .sortWithinPartitions(key)
        .mapInArrow(
            partial(_walk, key),
            f"{schema}, part_ int, row_ long, path_ array<long>, fresh_ array<boolean>",
        ),
        f"walk-{key}",
    )
    numbers = F.transform(
        "path_",
        lambda v: F.when(v < F.size("held_"), F.element_at("held_", (v + 1).cast("int"))).otherwise(F.col("base_") + v),
    )
    return walked.join(F.broadcast(_joints(spark, walked, key)), "part_").select(
        *words.columns,
        (F.col("rows_") + F.col("row_")).alias(row),
        F.concat(F.array(F.lit(0).cast("long")), numbers).alias(path),
        F.col("fresh_").alias(fresh),
    )


def pairs(words: DataFrame) -> DataFrame:
    """``(p, s, kind, id, n)`` from ``(id, n, prefixes, suffixes, fresh)``: all cuts and all skipped letters.

    In a run of equal letters skipping any gives the same word: only the first counts as an insertion.
    """
    turned = F.reverse("suffixes")
    length = F.size("fresh")

    def entry(x: Column, y: Column, kind: Column) -> Column:
        return F.struct(x.alias("p"), y.alias("s"), kind.cast("int").alias("kind"))

    cuts = F.zip_with("prefixes", turned, lambda x, y: entry(x, y, F.lit(_CUT)))
    skips = F.zip_with(
        F.zip_with(F.slice("prefixes", F.lit(1), length), F.slice(turned, F.lit(2), length), lambda x, y: entry(x, y, F.lit(_SKIP))),
        "fresh",
        lambda e, first: entry(e["p"], e["s"], F.when(first, _FIRST_SKIP).otherwise(_SKIP)),
    )
    return words.select("id", "n", F.explode(F.concat(cuts, skips)).alias("e")).select("e.*", "id", "n")


def neighbours(entries: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of words with neighbours: how many, and the struct (n, -id) of the greatest.

    Words that share a pair differ pairwise in one letter, so they are at most as many as there are
    letters, beside one word that is the pair's cut. None of their pairs is written out: each
    word learns how many the others are and which is greatest (or second, where that is itself).
    """
    group = Window.partitionBy("p", "s").orderBy(F.desc("n"), "id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    # the greatest is the largest n and, among equals, the first in code-point order
    who = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("minus_id"))
    skip, first_skip, cut = F.col("kind") > _CUT, F.col("kind") == _FIRST_SKIP, F.col("kind") == _CUT
    seen = entries.select(
        "id",
        "kind",
        F.count(F.lit(1)).over(group).alias("members"),
        F.count_if(skip).over(group).alias("skips"),
        F.count_if(first_skip).over(group).alias("first_skips"),
        F.first(F.when(cut, who), ignorenulls=True).over(group).alias("whole"),
        F.first(F.when(skip, who), ignorenulls=True).over(group).alias("top"),
        F.nth_value(F.when(skip, who), 2, True).over(group).alias("second"),
        F.first(F.when(first_skip, who), ignorenulls=True).over(group).alias("top_first"),
    ).where("members > 1")
    other = F.when(F.col("top.minus_id") == -F.col("id"), F.col("second")).otherwise(F.col("top"))
    return (
        seen.select(
            "id",
            F.when(cut, F.col("first_skips"))
            .otherwise(F.col("skips") - 1 + F.when(first_skip & F.col("whole").isNotNull(), 1).otherwise(0))
            .alias("near"),
            F.when(cut, F.col("top_first"))
            .when(first_skip, F.greatest(other, "whole"))
            .otherwise(other)
            .alias("best"),
        )
        .where("near > 0")
        .groupBy("id")
        .agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))
    )


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(id, root)`` from ``(id, form)``: pointers are doubled until none moves.

    Counts grow by a fixed factor along a chain, so it has few links and rounds are fewer still.
    """
    now = scratch.write(forms.select("id", F.col("form").alias("root")), "root")
    while True:
        on = now.select(F.col("id").alias("root"), F.col("root").alias("further"))
        new = scratch.write(
            now.join(on, "root", "left").select("id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "root",
        )
        scratch.drop(now)
        if new.where("moved").isEmpty():
            return new.drop("moved")
        now = new


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` from distinct words and their counts ``(word, n)``.

    Near words are those one inserted, deleted or replaced code point away. A word's form is the near
    word with the largest n, the first in code-point order among equals, if that n is at least
    ``ratio`` times the word's own (``ratio`` above 1); its root is reached by following forms. Null
    and empty words are left out; no words give no rows. Other columns are ignored. All steps are
    linear in the letters of the words, so a word may be as long as a text.
    """
    scratch = Scratch(words.sparkSession, "variants")
    given = words.select("word", F.col("n").cast("long").alias("n")).where("word is not null and word <> ''")
    forward = number_nodes(given, "word", "prefixes", scratch, "id", "fresh")
    both = number_nodes(forward.withColumn("turned", F.reverse("word")), "turned", "suffixes", scratch).drop("row_", "fresh_")
    near = scratch.write(neighbours(pairs(both)), "near")
    plain = both.select("id", "word", "n")
    linked = scratch.write(
        plain.join(near, "id", "left").select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("best.n") >= F.lit(ratio) * F.col("n"), F.struct((-F.col("best.minus_id")).alias("id"), F.col("best.n").alias("n"))).alias("best"),
        ),
        "linked",
    )
    scratch.drop(near)
    forms = linked.where("best is not null").select("id", F.col("best.id").alias("form"), F.col("best.n").alias("form_n"))
    roots = _roots(forms, scratch)
    names = linked.select("id", "word")
    named = (
        forms.join(roots, "id")
        .join(names.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
        .join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
        .select("id", "form_word", "root_word", "form_n")
    )
    return linked.drop("best").join(named, "id", "left").select(
        "word",
        F.col("form_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )
