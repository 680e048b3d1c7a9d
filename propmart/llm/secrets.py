"""Secret scan over a trigram inverted index, with built-in functions only.

From each rule's regular expression a Boolean trigram query is derived.  The
index holds, for the trigrams that the rules mention, the documents whose
lower-cased text has them; intersecting those postings gives the candidates of
a rule, and only they are searched with its expression.  A rule without
mandatory trigrams (such as long hexadecimal runs) scans every text.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propmart.llm.common import written

MOST_STRINGS = 64  # alternatives followed at once while a query is derived


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``pattern`` without anchors or look-around; matches whose
    group ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules.  Runs of 20 and 24 characters are written
# into the repetition, which drops the same matches as a test afterwards.
BASE_RULES = (
    Rule("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

# A query is a list of clauses that must all hold; a clause is a list of
# alternatives, each a set of trigrams that must all be there.
Query = list[list[frozenset[str]]]


def trigram_query(pattern: str) -> Query:
    """Trigrams that the lower-cased text of every match has; empty: none are mandatory."""
    clauses: Query = []

    def close(strings: set[str]) -> None:
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        if all(sets):
            least = {s for s in sets if not any(t < s for t in sets)}
            clauses.append(sorted(least, key=sorted))

    def fixed(nodes) -> set[str] | None:
        """All strings that the nodes match, if they are few."""
        out = {""}
        for node in nodes:
            some = one(node)
            if some is None or len(out) * len(some) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in some}
        return out

    def one(node) -> set[str] | None:
        code, value = node
        if code is op.LITERAL:
            return {chr(value).lower()}
        if code is op.SUBPATTERN:
            return fixed(value[3])
        if code is op.BRANCH:
            parts = [fixed(x) for x in value[1]]
            return None if None in parts else set().union(*parts)
        if code is op.IN and all(c is op.LITERAL for c, _ in value):
            return {chr(v).lower() for _, v in value}
        if code in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, inner = value
            some = fixed(inner)
            if some is not None and high <= 4:
                out: set[str] = set()
                for n in range(low, high + 1):
                    times = {""}
                    for _ in range(n):
                        times = {a + b for a in times for b in some}
                    out |= times
                return out if len(out) <= MOST_STRINGS else None
        return None

    def walk(nodes) -> None:
        held = {""}
        for node in nodes:
            some = one(node)
            if some is not None and len(held) * len(some) <= MOST_STRINGS:
                held = {a + b for a in held for b in some}
                continue
            close(held)
            held = {""}
            code, value = node
            if some is not None:
                held = some
            elif code is op.SUBPATTERN:
                walk(value[3])
            elif code in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] > 0:
                walk(value[2])
        close(held)

    walk(parser.parse(pattern))
    return clauses


def trigrams_of(query: Query) -> set[str]:
    return {t for clause in query for strings in clause for t in strings}


def build_index(docs: DataFrame, trigrams: set[str]) -> DataFrame:
    """Postings (trigram, doc_id, text_hash) of the given trigrams, written by trigram order.

    ``docs`` has doc_id, text and text_hash; rows that repeat id and text share a posting.
    """
    terms = F.array(*[F.lit(t) for t in sorted(trigrams)])
    # the lower-cased text is made once, by a lambda over an array of one text
    found = F.transform(F.array(F.lower("text")), lambda low: F.filter(terms, lambda t: F.contains(low, t)))[0]
    postings = docs.select(F.explode(found).alias("trigram"), "doc_id", "text_hash")
    return written(postings.sortWithinPartitions("trigram"), "secret-postings")


def candidates(postings: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(doc_id, text_hash, kinds): the kinds whose queries the postings of a text fulfil."""

    def holds(query: Query) -> Column:
        every = F.lit(True)
        for clause in query:
            some = F.lit(False)
            for strings in clause:
                need = F.array(*[F.lit(t) for t in sorted(strings)])
                some = some | (F.size(F.array_intersect(need, F.col("have"))) == len(strings))
            every = every & some
        return every

    texts = postings.groupBy("doc_id", "text_hash").agg(F.collect_set("trigram").alias("have"))
    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return texts.select("doc_id", "text_hash", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans (start, kind, end) of a rule's matches in code points, leftmost, non-overlapping.

    The text is cut behind each match; within a cut the match is the leftmost
    one again, as patterns have no anchors or look-around.
    """
    cuts = F.regexp_extract_all(text, F.lit(rf"(?s).*?(?:{rule.pattern}|\z)"), F.lit(0))
    sized = F.transform(
        cuts,
        lambda s: F.struct(
            F.char_length(s).alias("n"),
            F.char_length(F.regexp_extract(s, rule.pattern, 0)).alias("m"),
            F.char_length(F.regexp_extract(s, rule.pattern, rule.group)).alias("v"),
        ),
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        end = a["at"] + x["n"]
        span = F.struct((end - x["m"]).alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        good = (x["m"] > 0) & (x["v"] >= rule.least)
        return F.struct(end.alias("at"), F.when(good, F.concat(a["out"], F.array(span))).otherwise(a["out"]).alias("out"))

    return F.aggregate(sized, empty, step, lambda a: a["out"])


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """Per row: doc_id and its spans (start, kind number, end) by start, then kind.

    Null texts are empty; rows that repeat an id are rows of their own.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    postings = build_index(rows, set().union(*map(trigrams_of, queries.values()))) if queries else None
    if postings is not None:
        chosen = written(candidates(postings, queries), "secret-candidates")
        chosen = chosen.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "kinds")
        rows = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = []
    for number, rule in enumerate(rules):
        may = F.array_contains("kinds", rule.kind) if rule.kind in queries else F.col("text").rlike(rule.pattern)
        found.append(F.when(may, rule_spans(F.col("text"), rule, number)).otherwise(none))
    return rows.select("doc_id", F.sort_array(F.concat(*found)).alias("found"))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    rules = BASE_RULES + MORE_RULES
    # a generator keeps the optimizer from copying the scan into every use
    rows = scan(docs, rules).select("doc_id", F.explode(F.array(F.struct("found"))).alias("e")).select("doc_id", F.col("e.found").alias("found"))
    names = F.array(*[F.lit(r.kind) for r in rules])

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(number: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == number)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < len(BASE_RULES))
    return rows.select(
        "doc_id",
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE_RULES)],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
