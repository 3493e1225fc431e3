"""Secrets in documents: a trigram inverted index narrows each rule down to candidates, which are verified.

Everything is a DataFrame expression; the only Python work is turning the rules into trigram queries.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch, fresh, text_or_empty
from .trigram import ANY, Query, trigram_query


@dataclass(frozen=True)
class Rule:
    """``value``: the group that must have ``least`` characters, 0 for the whole match."""

    kind: str
    pattern: str
    least: int
    value: int = 0


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: Base kinds, in their listed order (fixed values).
BASE = (
    Rule(
        "assign",
        "("
        + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
        + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    # runs are taken whole, so the least length can stand in the pattern without changing a match
    Rule("access", "AKIA[A-Z0-9]{14,}", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
)
#: Kinds of our own: prefixes of publicly documented credential formats (fixed values).
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{15,}", 20),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)
RULES = (*BASE, *MORE)

_GAP = r"(?:[ \t\r\n]|\\[nr])"  # line breaks may be written as escapes
_PEM_END = "-----END [A-Z ]*PRIVATE KEY-----"
#: What is masked: a private key up to its END line or, without one, over the base64 lines that follow.
#: Reports name the place of a key by its BEGIN line. Possessive loops keep Java off its stack.
MASKED = tuple(
    replace(
        r,
        pattern=r.pattern
        + rf"(?:(?:(?!-----BEGIN |{_PEM_END})[\s\S])*+{_PEM_END}"
        + rf"|(?:{_GAP}++(?:Proc-Type|DEK-Info): [^\r\n]*+)*+(?:{_GAP}++[A-Za-z0-9+/]{{32,}}+={{0,2}})++"
        + rf"(?:(?:[\r\n]|\\[nr])++[ \t]*+[A-Za-z0-9+/]{{1,31}}+={{0,2}}(?=[ \t]*(?:[\r\n]|\\[nr]|$)))?)?",
    )
    if r.kind == "pem"
    else r
    for r in RULES
)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index ``(gram, doc)`` over the trigrams that some rule asks for.

    ``doc`` is a hash of id and text: it needs no unique ids, equal rows share it, and two different
    rows that shared one would only add a candidate. One row per document and trigram it holds; no
    list is gathered, so a trigram found everywhere is as many short rows in as many tasks.
    """
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    held = F.filter(
        F.array(*(F.when(F.contains("folded", F.lit(g)), F.lit(g)) for g in grams)), lambda g: g.isNotNull()
    )
    return docs.select(_doc_key().alias("doc"), folded.alias("folded")).select("doc", F.explode(held).alias("gram"))


def _doc_key() -> Column:
    return F.xxhash64("doc_id", "text")


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``(doc, kinds)``: documents that satisfy the trigram query of at least one rule.

    Posting lists are intersected by document: a clause is met where all its trigrams meet. What is
    gathered for a document is bounded by the trigrams of the rules.
    """
    met = index.groupBy("doc").agg(F.collect_set("gram").alias("held"))
    kinds = []
    for kind, query in queries.items():
        clauses = (
            F.size(F.array_except(F.array(*map(F.lit, sorted(c))), F.col("held"))) == 0 for c in sorted(query, key=sorted)
        )
        kinds.append(F.when(reduce(lambda a, b: a | b, clauses), F.lit(kind)))
    return met.select("doc", F.filter(F.array(*kinds), lambda k: k.isNotNull()).alias("kinds")).where("size(kinds) > 0")


def found(rule: Rule, rank: int, text: str) -> Column:
    """In the column ``text``: array of (start, rank, end, kind): leftmost non-overlapping matches that are long enough.

    The pieces between matches give the positions: a match starts after all earlier pieces and
    matches. Lengths are in code points.
    """
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value))
    pieces = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    sizes = F.zip_with(
        F.zip_with(whole, value, lambda m, v: F.struct(F.length(m).alias("m"), F.length(v).alias("v"))),
        pieces,
        lambda mv, p: F.struct(mv["m"].alias("m"), mv["v"].alias("v"), F.length(p).alias("p")),
    )
    none = F.array().cast("array<struct<start:int,end:int,size:int>>")
    placed = F.aggregate(
        sizes,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["p"] + x["m"]).alias("at"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        (acc["at"] + x["p"]).alias("start"),
                        (acc["at"] + x["p"] + x["m"]).alias("end"),
                        x["v"].alias("size"),
                    )
                ),
            ).alias("spans"),
        ),
    )["spans"]
    return F.transform(
        F.filter(placed, lambda s: s["size"] >= rule.least),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")
        ),
    ).cast(_SPANS)


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "secret_spans") -> DataFrame:
    """``docs`` with a last column ``name``: array of (start, rank, end, kind), by start, then rank.

    Each rule's matches are leftmost and non-overlapping; those whose value is too short are dropped.
    Positions are code points, the end exclusive. Null text counts as empty and has no spans. Rows
    that repeat an id, even with another text, are judged one by one; a null id is as good as any.
    A rule whose query is empty (no certain trigram) scans every text; the others look only into the
    candidates of the index. No documents give no rows.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    narrowed = {k: q for k, q in queries.items() if q != ANY}
    scratch = Scratch(docs.sparkSession, "secrets")
    keyed = docs.select("doc_id", text_or_empty().alias("text"))
    grams = sorted({g for q in narrowed.values() for c in q for g in c})
    index = scratch.write(postings(keyed, grams).sortWithinPartitions("gram"), "postings")
    wanted = scratch.write(candidates(index, narrowed), "candidates")
    scratch.drop(index)
    text, doc, kinds = fresh(docs, "text_"), fresh(docs, "doc"), fresh(docs, "kinds")
    base = docs.withColumn(text, text_or_empty())
    joined = base.withColumn(doc, F.xxhash64("doc_id", text)).join(
        wanted.select(F.col("doc").alias(doc), F.col("kinds").alias(kinds)), doc, "left"
    )
    none = F.array().cast(_SPANS)

    def looked_at(rule: Rule) -> Column:
        """Candidates of the index; for rules outside it every text that matches at all."""
        if rule.kind in narrowed:
            return F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False))
        return F.col(text).rlike(rule.pattern)

    parts = [F.when(looked_at(r), found(r, i, text)).otherwise(none) for i, r in enumerate(rules)]
    return joined.select(*docs.columns, F.array_sort(F.concat(*parts)).alias(name))


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in span order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans and all spans; see ``scan``."""
    base = [r.kind for r in BASE]
    spans = F.col("secret_spans")
    of_base = F.filter(spans, lambda s: s["kind"].isin(base))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return scan(docs.select("doc_id", "text")).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(F.encode(listed(of_base), "UTF-8"), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


MASK = "[SECRET]"


def redact(docs: DataFrame, rules: tuple[Rule, ...] = MASKED) -> DataFrame:
    """``docs`` with every secret's span replaced by ``[SECRET]``; ``n_chars`` follows where it exists.

    Overlapping spans count as one. Texts without secrets, null ones included, stay as they are.
    """
    name = fresh(docs, "secret_spans")
    spans = F.col(name)
    # text before the first span, then for each span what follows it up to the next later start
    kept = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("made")),
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(acc["made"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK)).alias("made"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["made"].alias("made"))),
        lambda acc: F.concat(acc["made"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    out = scan(docs, rules, name).withColumn("text", F.when(F.size(spans) > 0, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
