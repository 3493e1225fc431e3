"""Personal data in documents: fixed patterns, and unseen identifiers by bootstrapped contexts.

The matches of four fixed patterns are the seeds. Every token group with a digit or an @ is a mention of an
instance (its value) in some lexical patterns (the words around it). The graph of patterns and instances
is scored in rounds: a pattern is as good for a kind as its different instances are on average, an
instance as its best trusted pattern. Instances that no fixed pattern knows but trusted patterns do
are reported as ``like_<kind>``. Everything is a DataFrame expression; scores are whole thousandths.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch, text_or_empty

_LOCAL, _LABEL, _BLANK = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]", r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Kind:
    """``pattern`` takes what the plain form in ``SQL`` terms would take, in time linear in the text.

    A match starts only where no longer run of its first characters is cut, or where the last one
    ended, and loops give nothing back: the leftmost matches are the same.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _small_parts(match: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _luhn(match: Column) -> Column:
    """14 to 19 digits whose sum is divisible by ten, every second one from the right doubled."""
    digits = F.reverse(_digits(match))

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == 0, doubled).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


#: In their listed order.
KINDS = (
    Kind(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
        lambda m: F.lit(True),
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _small_parts),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _luhn),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(10, 15)),
)
LIKE = tuple(f"like_{k.name}" for k in KINDS)

#: A token with a digit or @, and up to six more such tokens after single blanks.
_TOKEN = rf"[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
MENTION = rf"(?<![^{_BLANK}]){_TOKEN}(?:\x20{_TOKEN}){{0,6}}+"
#: What does not belong to a value at its ends, the longest value, the context characters looked at, the fewest digits.
EDGES, LONGEST, REACH, FEWEST = ".,;:!?\"'*$%&#<>[]{}|", 64, 64, 5
#: Score of a seed; a trusted pattern's least score and number of seeds; what doubts each pattern; rounds.
FULL, TRUSTED, SEEDS, DOUBT, ROUNDS = 1000, 600, 3, 2, 3
#: Parts that a hot pattern or value is split into.
SALTS = 16
#: Matches whose places are added up at a time.
_BLOCK = 512

_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def placed(text: str, pattern: str, *extra: tuple[str, Callable[[Column, Column], Column]]) -> Column:
    """Array of (match, start, end, ...) of the leftmost non-overlapping matches in the column ``text``, in code points.

    ``extra`` fields are made of the pieces of text before and after the match. Starts are running
    sums, taken within blocks and over blocks, so many matches in one text stay cheap.
    """
    names = [n for n, _ in extra]
    made = f"array<struct<{','.join(['match:string', 'start:int', 'end:int', *(f'{n}:string' for n in names)])}>>"

    def steps(pieces: Column) -> Column:
        both = F.zip_with(
            pieces, F.slice(pieces, F.lit(2), F.size(pieces)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))
        )
        # one piece more than matches
        return F.zip_with(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            F.slice(both, F.lit(1), F.size(pieces) - 1),
            lambda m, p: F.struct(
                m.alias("match"),
                F.length(p["a"]).alias("gap"),
                F.length(m).alias("size"),
                *(f(p["a"], p["b"]).alias(n) for n, f in extra),
            ),
        )

    def blocks(steps: Column) -> Column:
        last = F.floor(F.greatest(F.size(steps) - 1, F.lit(0)) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)))

    def begun(blocks: Column) -> Column:
        return F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, b: F.struct(
                F.aggregate(b, acc["at"], lambda at, s: at + s["gap"] + s["size"]).alias("at"),
                F.concat(acc["out"], F.array(acc["at"])).alias("out"),
            ),
        )["out"]

    def within(block: Column, at: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(at.alias("at"), F.array().cast(made).alias("out")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["size"]).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            s["match"].alias("match"),
                            (acc["at"] + s["gap"]).alias("start"),
                            (acc["at"] + s["gap"] + s["size"]).alias("end"),
                            *(s[n].alias(n) for n in names),
                        )
                    ),
                ).alias("out"),
            ),
        )["out"]

    return _let(
        F.split(text, pattern, -1),
        lambda pieces: _let(
            steps(pieces), lambda s: _let(blocks(s), lambda b: F.flatten(F.zip_with(b, begun(b), within)))
        ),
    )


def base_spans(kind: Kind, rank: int, text: str) -> Column:
    """Spans of one kind's valid matches; a match that fails its test is dropped and not tried again."""
    return F.transform(
        F.filter(placed(text, kind.pattern), lambda m: kind.valid(m["match"])),
        lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind.name).alias("kind")),
    ).cast(_SPANS)


def _words(piece: Column) -> Column:
    folded = F.translate(piece, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(folded, rf"[{_BLANK}]+", -1), lambda w: w != "")


def _before(a: Column, b: Column) -> Column:
    """Up to two words before the mention."""
    words = _words(F.right(a, F.lit(REACH)))
    return F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), " ")


def _after(a: Column, b: Column) -> Column:
    return F.coalesce(F.get(_words(F.left(b, F.lit(REACH))), F.lit(0)), F.lit(""))


def mentions(text: str) -> Column:
    """Array of (start, end, value, before, after): token groups that could be identifiers, without outer punctuation."""
    trimmed = lambda m: F.ltrim(m, F.lit(EDGES))
    return F.filter(
        F.transform(
            placed(text, MENTION, ("before", _before), ("after", _after)),
            lambda m: F.struct(
                (m["end"] - F.length(trimmed(m["match"]))).alias("start"),
                (m["end"] - F.length(trimmed(m["match"])) + F.length(F.rtrim(trimmed(m["match"]), F.lit(EDGES)))).alias("end"),
                F.translate(
                    F.rtrim(trimmed(m["match"]), F.lit(EDGES)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
                ).alias("value"),
                m["before"].alias("before"),
                m["after"].alias("after"),
            ),
        ),
        lambda m: F.length(m["value"]) <= LONGEST,
    )


def _patterns(before: str, after: str) -> Column:
    """The lexical patterns of a mention: the word before it, two words, the words on both sides."""
    one = F.element_at(F.split(before, " "), -1)
    return F.filter(
        F.array(
            F.when(F.col(before) != "", F.concat(F.lit("1 "), one)),
            F.when(F.contains(before, F.lit(" ")), F.concat(F.lit("2 "), before)),
            F.when((F.col(before) != "") & (F.col(after) != ""), F.concat(F.lit("3 "), one, F.lit(" "), after)),
        ),
        lambda p: p.isNotNull(),
    )


def _spread_join(large: DataFrame, small: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``small`` has one row per ``key``, of which ``large`` may have any number: each is dealt out by ``by``."""
    dealt = large.withColumn("salt_", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    copies = small.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, [key, "salt_"], how).drop("salt_")


def _seeds(values: DataFrame) -> DataFrame:
    """``(value, s0, s1, ...)``: full score for each kind that a fixed pattern finds in the value."""
    scores = []
    for i, kind in enumerate(KINDS):
        held = F.exists(F.regexp_extract_all("value", F.lit(kind.pattern), F.lit(0)), kind.valid)
        scores.append(F.when(held, FULL).otherwise(0).cast("long").alias(f"s{i}"))
    return values.select("value", *scores)


def trusted_patterns(edges: DataFrame) -> DataFrame:
    """``(pattern, c0, c1, ...)`` with at least one trusted score, from ``(pattern, value, s0, s1, ...)``.

    A pattern needs ``SEEDS`` different seeds of the kind; ``DOUBT`` unknown instances are added to its own.
    """
    kinds = range(len(KINDS))
    scored = edges.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(f"s{i}").alias(f"t{i}") for i in kinds),
        *(F.count_if(F.col(f"s{i}") == FULL).alias(f"seeds{i}") for i in kinds),
    )
    score = lambda i: F.expr(f"t{i} div (n + {DOUBT})")
    good = lambda i: (F.col(f"seeds{i}") >= SEEDS) & (score(i) >= TRUSTED)
    return scored.where(reduce(lambda a, b: a | b, (good(i) for i in kinds))).select(
        "pattern", *(F.when(good(i), score(i)).otherwise(0).alias(f"c{i}") for i in kinds)
    )


def instances(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(value, s0, s1, ...)`` of the values that trusted patterns reach, after all rounds.

    ``edges`` are different (pattern, value) with the seeds' scores. Every round starts from the seeds and the scores of the
    round before; when a round reaches no value, neither would the next.
    """
    kinds = range(len(KINDS))
    now = edges
    for _ in range(ROUNDS):
        patterns = scratch.write(trusted_patterns(now), "patterns")
        reached = scratch.write(
            _spread_join(edges, patterns, "pattern", "value")
            .groupBy("value")
            .agg(*(F.greatest(F.max(f"s{i}"), F.max(f"c{i}")).alias(f"r{i}") for i in kinds)),
            "reached",
        )
        now = _spread_join(edges, reached, "value", "pattern", "left").select(
            "pattern", "value", *(F.coalesce(f"r{i}", f"s{i}").alias(f"s{i}") for i in kinds)
        )
        now = scratch.write(now, "edges")
        if reached.isEmpty():
            break
    return reached.select("value", *(F.col(f"r{i}").alias(f"s{i}") for i in kinds))


def discovered(held: DataFrame, scratch: Scratch) -> DataFrame:
    """``(value, rank)``: values that no fixed pattern knows but trusted patterns do, from mentions ``(value, before, after)``.

    They hold an @ or at least ``FEWEST`` digits. ``rank`` is the place of the likeliest kind, the earlier
    one among equals.
    """
    pairs = held.select("value", F.explode(_patterns("before", "after")).alias("pattern")).distinct()
    pairs = scratch.write(pairs, "pairs")
    seeds = scratch.write(_seeds(pairs.select("value").distinct()), "values")
    edges = scratch.write(_spread_join(pairs, seeds, "value", "pattern"), "edges")
    kinds = range(len(KINDS))
    best = F.greatest(*(f"s{i}" for i in kinds))
    rank = F.coalesce(*(F.when(F.col(f"s{i}") == best, F.lit(i)) for i in kinds))
    identifier = F.contains("value", F.lit("@")) | (F.length(_digits(F.col("value"))) >= FEWEST)
    return (
        instances(edges, scratch)
        .where((best >= TRUSTED) & (best < FULL) & identifier)
        .select("value", rank.alias("rank"))
    )


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``, one row per row of ``docs``: array of (start, rank, end, kind), by start, then rank.

    Base kinds first in rank, then the discovered ones. Positions are code points, the end
    exclusive. Null text counts as empty and has no spans; rows that repeat an id are judged one by
    one, but copies of one value count once in the graph. A value of more than 64 code points is no
    identifier. Time is linear in the text also where it has no blanks. No documents give no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "personal")
    none, no_mentions = F.array().cast(_SPANS), F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    holds = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}
    base = [
        F.when(holds.get(k.name, F.col("text").rlike("[0-9]")) & F.col("text").rlike(k.pattern), base_spans(k, i, "text")).otherwise(none)
        for i, k in enumerate(KINDS)
    ]
    scanned = scratch.write(
        docs.select("doc_id", text_or_empty().alias("text")).select(
            "doc_id",
            F.xxhash64("doc_id", "text").alias("doc"),
            F.concat(*base).alias("base"),
            F.when(F.col("text").rlike("[0-9@]"), mentions("text")).otherwise(no_mentions).alias("mentions"),
        ),
        "scanned",
    )
    held = scanned.where("size(mentions) > 0")
    each = held.select("doc", F.explode("mentions").alias("m")).select("doc", "m.*")
    new = scratch.write(discovered(each, scratch), "discovered")
    # a document's own mentions decide; two rows that share a hash only share what is looked for
    wanted = scratch.write(
        _spread_join(each.select("doc", "value"), new, "value", "doc")
        .groupBy("doc")
        .agg(F.map_from_entries(F.collect_set(F.struct("value", "rank"))).alias("wanted")),
        "wanted",
    )
    more = F.transform(
        F.filter("mentions", lambda m: F.map_contains_key("wanted", m["value"])),
        lambda m: F.struct(
            m["start"].alias("start"),
            (F.element_at("wanted", m["value"]) + len(KINDS)).alias("rank"),
            m["end"].alias("end"),
            F.element_at(F.array(*map(F.lit, LIKE)), F.element_at("wanted", m["value"]) + 1).alias("kind"),
        ),
    ).cast(_SPANS)
    return scanned.join(wanted, "doc", "left").select(
        "doc_id", F.array_sort(F.concat("base", F.coalesce(more, none))).alias("spans")
    )


def _listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in span order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans and all spans; see ``scan``."""
    spans = F.col("spans")
    of_base = F.filter(spans, lambda s: s["rank"] < len(KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scan(docs).select(
        "doc_id",
        *(count(k.name).alias(f"n_{k.name}") for k in KINDS),
        F.sha2(F.encode(_listed(of_base), "UTF-8"), 256).alias("base_sha256"),
        _listed(spans).alias("spans"),
    )
