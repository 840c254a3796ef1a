"""Secret scans over a trigram inverted index, in DataFrame operations alone.

From each rule's regex follows which trigrams a match must hold, as a Boolean query. Postings
of those trigrams are intersected per document; only documents that satisfy a rule's query are
verified with its regex. Rules without mandatory trigrams scan every document.
"""

from __future__ import annotations

import itertools
from re import _constants as op
from re import _parser as regex_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.sources import materialize


class Rule(NamedTuple):
    """Matches of ``pattern`` count if ``group`` (0: all) has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The rules of the contract, in its order, and further well-known key formats.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
RULES = (
    *BASE,
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
_MOST = 64  # spellings of a part that are followed before it counts as open

#: A conjunction of disjunctions of trigram sets.
Query = list[set[frozenset[str]]]


def _spellings(items) -> set[str] | None:
    """All texts a sequence of regex nodes matches; None if there are too many to list."""
    found = {""}
    for kind, value in items:
        part = _spelled(kind, value)
        if part is None or len(found) * len(part) > _MOST:
            return None
        found = {a + b for a, b in itertools.product(found, part)}
    return found


def _spelled(kind, value) -> set[str] | None:
    if kind is op.LITERAL:
        return {chr(value)}
    if kind is op.SUBPATTERN:
        return _spellings(value[3])
    if kind is op.BRANCH:
        parts = [_spellings(x) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is op.MAX_REPEAT and value[1] == 1 and value[0] == 0:
        inner = _spellings(value[2])
        return None if inner is None else inner | {""}
    if kind is op.MAX_REPEAT and value[0] == value[1] and value[0] <= 8:
        return _spellings(list(value[2]) * value[0])
    if kind is op.IN and all(k is op.LITERAL for k, _ in value):
        return {chr(v) for _, v in value}
    return None


def trigram_query(pattern: str) -> Query:
    """Lower-case trigrams any match holds; an empty query says nothing."""
    query: Query = []

    def close(run: set[str]) -> None:
        if run and min(map(len, run)) >= 3:
            sets = {frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in map(str.lower, run)}
            # a set that holds another asks for more than needed
            query.append({s for s in sets if not any(s > other for other in sets)})

    run = {""}
    for kind, value in regex_parser.parse(pattern):
        part = _spelled(kind, value)
        if part is not None and len(run) * len(part) <= _MOST:
            run = {a + b for a, b in itertools.product(run, part)}
            continue
        close(run)
        run = part or {""}
    close(run)
    return query


def trigram_index(docs: DataFrame, trigrams: list[str], keys: list[str], text_col: str) -> DataFrame:
    """``keys``, trigram: the postings of ``trigrams`` in the lower-cased texts."""
    # lower-cased once, below the many looks at it
    lowered = docs.select(*keys, F.lower(F.col(text_col)).alias("_low"))
    present = F.array_compact(F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select(*keys, F.explode(present).alias("trigram"))


def _satisfied(query: Query, held: Column) -> Column:
    def all_of(trigrams: frozenset[str]) -> Column:
        return F.size(F.array_intersect(held, F.array(*(F.lit(t) for t in sorted(trigrams))))) == len(trigrams)

    out = F.lit(True)
    for part in query:
        some = F.lit(False)
        for trigrams in sorted(part, key=sorted):
            some = some | all_of(trigrams)
        out = out & some
    return out


def candidates(index: DataFrame, queries: dict[str, Query], keys: list[str]) -> DataFrame:
    """``keys``, rules: which rules' queries the postings of a document satisfy."""
    held = index.groupBy(*keys).agg(F.collect_set("trigram").alias("held"))
    rules = F.array_compact(F.array(*(F.when(_satisfied(q, F.col("held")), F.lit(k)) for k, q in queries.items())))
    return held.select(*keys, rules.alias("rules")).where(F.size("rules") > 0)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """start, rank, end, kind of the leftmost matches that do not overlap, in order."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    tested = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))
    row = "struct<start: int, rank: int, end: int, kind: string>"
    walked = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), found.alias("found"), tested.alias("tested")),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{row}>").alias("out")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["gap"]) + F.length(x["found"])).alias("at"),
            F.when(
                F.length(x["tested"]) >= rule.least,
                F.array_append(
                    a["out"],
                    F.struct(
                        (a["at"] + F.length(x["gap"])).alias("start"),
                        F.lit(rank).alias("rank"),
                        (a["at"] + F.length(x["gap"]) + F.length(x["found"])).alias("end"),
                        F.lit(rule.kind).alias("kind"),
                    ).cast(row),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: a["out"],
    )
    return walked


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, spans: one row per row of ``docs``, spans ordered by start, rule and end.

    A span is (start, rank of its rule, end, kind) in code points, the end exclusive. Null and
    empty texts have no spans. Null ids and repeated rows are kept: rows are matched with the
    index by id and text. Very long texts are scanned whole; an empty table gives no rows. Only
    the two named columns are read.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("digest", F.xxhash64("text"))
    keys = ["doc_id", "digest"]
    trigrams = sorted({t for q in indexed.values() for part in q for s in part for t in s})
    known = candidates(trigram_index(rows, trigrams, keys, "text"), indexed, keys)
    # few documents are candidates; written, their real size decides whether texts move to the join
    known = materialize(known, "candidates").withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    joined = rows.join(known, same, "left")
    text, none = F.col("text"), F.array().cast("array<struct<start: int, rank: int, end: int, kind: string>>")
    parts = []
    for rank, rule in enumerate(rules):
        if rule.kind in indexed:
            due = F.coalesce(F.array_contains("rules", rule.kind), F.lit(False))
        else:
            due = text.rlike(rule.pattern)
        parts.append(F.when(due, _spans(text, rule, rank)).otherwise(none))
    return joined.select("doc_id", F.sort_array(F.concat(*parts)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
