"""Quality rules: a threshold table compiled into one projection, without user functions.

Every measure is a built-in expression over the words and lines of one row, so the
operator adds no shuffle; rows never meet.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.llm.text import SPACE, fresh, words_of


class Rule(NamedTuple):
    """A document passes if ``measure`` lies between the bounds; None is open."""

    measure: str
    least: float | None
    most: float | None


#: Frequent function words of the languages the rules are made for.
STOP_WORDS = (
    "the of and to in is that for it as with on be are this by from or an was at not have "
    "der die und das von zu mit den ist ein im für auf dem nicht eine sich des als auch "
    "de la le les et des en du un une est que pour dans qui sur par pas au avec "
    "el los las y del se por con una su para es lo como al más no o"
).split()

#: The table behind the verdict. Ratios are per word, or per line with a word.
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2, 12),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.02, None),
    Rule("dup_line_ratio", None, 0.5),
    Rule("repeat_word_ratio", None, 0.5),
    Rule("bullet_line_ratio", None, 0.9),
    Rule("ellipsis_line_ratio", None, 0.3),
    Rule("shout_ratio", None, 0.3),
    Rule("letter_word_ratio", 0.7, None),
)

_WORD_IN_LINE = rf"[^{SPACE}]"
_SYMBOL = r"[#*$%&|<>]"


def compile_rules(rules: tuple[Rule, ...], measures: dict[str, Column]) -> Column:
    """One Boolean column: all rules hold. A null measure fails its rule."""
    verdict = F.lit(True)
    for rule in rules:
        value = measures[rule.measure]
        if rule.least is not None:
            verdict = verdict & (value >= F.lit(rule.least))
        if rule.most is not None:
            verdict = verdict & (value <= F.lit(rule.most))
    return F.coalesce(verdict, F.lit(False))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def quality(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    text_col: str = "text",
    out: str = "quality",
) -> DataFrame:
    """``docs`` with a struct ``out`` of measures, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Repeated rows are judged one by one, extra
    columns are left alone, and ``out`` may not be a column already. The three-word windows
    of a text are sorted by hash, and neighbours with one hash are compared word by word, so
    that counts are exact and a very long text costs n log n. An empty table stays empty.
    """
    if out in docs.columns:
        raise ValueError(f"{out} is a column already")
    names = {k: fresh(docs, f"{k}_of_{out}") for k in ("text", "words", "lines", "keys", "spots")}
    text, words, lines, keys, spots = (F.col(names[k]) for k in names)
    n = F.size(words).cast("long")

    def window_key(i: Column) -> Column:
        i = i.cast("int")
        bins = F.expr(f"(bigint(4611686018427387904) div size({names['words']}))")
        return F.pmod(F.xxhash64(words[i], words[i + 1], words[i + 2]), bins) * n + i

    def spot(key: Column) -> Column:
        return F.pmod(key, n).cast("int")

    def same_words(a: Column, b: Column) -> Column:
        p, q = spot(a), spot(b)
        return (words[p] == words[q]) & (words[p + 1] == words[q + 1]) & (words[p + 2] == words[q + 2])

    def near(a: Column, b: Column) -> Column:
        """Keys of one bin differ by less than n and share the quotient."""
        return (F.abs(a - b) < n) & (a - F.pmod(a, n) == b - F.pmod(b, n))

    def repeated(key: Column, i: Column) -> Column:
        before = (i > 0) & near(key, F.get(keys, i - 1))
        after = (i < F.size(keys) - 1) & near(key, F.get(keys, i + 1))
        # windows that share a hash but not the words are looked up in full
        far = F.exists(keys, lambda k: (k != key) & near(k, key) & same_words(k, key))
        return (
            (before & same_words(key, F.get(keys, i - 1)))
            | (after & same_words(key, F.get(keys, i + 1)))
            | ((before | after) & far)
        )

    covered = F.aggregate(
        spots,
        F.struct(F.lit(-3).cast("long").alias("last"), F.lit(0).cast("long").alias("total")),
        lambda a, p: F.struct(
            p.alias("last"), (a["total"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("total")
        ),
        lambda a: a["total"],
    )
    bare = F.array_join(words, "")
    n_lines = F.size(lines).cast("long")
    measures = {
        "n_words": n,
        "word_chars": F.length(bare).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(_SYMBOL)).cast("long"),
        "n_dup_lines": n_lines - F.size(F.array_distinct(lines)),
        "n_repeat_words": covered,
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "n_lines": n_lines,
        "n_shouts": F.regexp_count(bare, F.lit("!")).cast("long"),
        "n_letter_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(rf"^[{SPACE}]*[-*•]"))).cast("long"),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(rf"(\.\.\.|…)[{SPACE}]*$"))).cast("long"),
    }
    counted = {k: F.col(out)[k] for k in measures}
    ratios = {
        "mean_word_chars": _share(counted["word_chars"], counted["n_words"]),
        "symbol_ratio": _share(counted["n_symbols"], counted["n_words"]),
        "stop_word_ratio": _share(counted["n_stop_words"], counted["n_words"]),
        "dup_line_ratio": _share(counted["n_dup_lines"], counted["n_lines"]),
        "repeat_word_ratio": _share(counted["n_repeat_words"], counted["n_words"]),
        "bullet_line_ratio": _share(counted["n_bullet_lines"], counted["n_lines"]),
        "ellipsis_line_ratio": _share(counted["n_ellipsis_lines"], counted["n_lines"]),
        "shout_ratio": _share(counted["n_shouts"], counted["n_words"]),
        "letter_word_ratio": _share(counted["n_letter_words"], counted["n_words"]),
    }
    failed = (counted["n_words"] < 50) | (100 * counted["n_repeat_words"] > 50 * counted["n_words"])
    passed = ~failed & compile_rules(rules, counted | ratios)
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window_key)
    no_keys = F.array().cast("array<bigint>")
    return (
        docs.withColumn(names["text"], F.coalesce(F.col(text_col), F.lit("")))
        .withColumns(
            {
                names["words"]: words_of(text),
                names["lines"]: F.filter(F.split(text, "\n"), lambda x: x.rlike(_WORD_IN_LINE)),
            }
        )
        .withColumn(names["keys"], F.when(F.size(words) >= 3, F.sort_array(windows)).otherwise(no_keys))
        .withColumn(
            names["spots"], F.sort_array(F.transform(F.filter(keys, repeated), lambda k: spot(k).cast("long")))
        )
        .withColumn(out, F.struct(*(v.alias(k) for k, v in measures.items())))
        .withColumn(
            out,
            F.struct(
                *(v.alias(k) for k, v in counted.items()),
                failed.alias("base_failed"),
                passed.alias("kept"),
            ),
        )
        .drop(*names.values())
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    out, row = fresh(docs, "quality"), fresh(docs, "row_number")
    # a filter is not pushed below a column that depends on the row's place; pushed down, it
    # would repeat every measure wherever another one uses it
    judged = quality(docs, rules, text_col, out).withColumn(row, F.monotonically_increasing_id())
    return judged.where(F.col(out)["kept"] & (F.col(row) >= 0)).select(*docs.columns)
