"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text: the ledger keeps its measurements and
one bit for each rule that failed. A policy is a versioned set of rules, that
is a mask over those bits, so policies are applied, compared and ablated from
the ledger without reading texts again.

Words are runs of characters other than U+0020 and U+0009-U+000D. A null or
empty text has no word, line or symbol and fails the length rule. Rows that
repeat are measured each; no row is dropped. Three-word windows are compared
by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pushback.llm.common import SPACE_CLASS

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition over the measurement columns."""

    name: str
    fails: str


#: In the order of their bits; new rules are added at the end.
RULES = [
    Rule("short", "n_words < 50"),
    Rule("repetitive", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines AND n_dup_lines >= 3"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
]
BASE = ["short", "repetitive"]
POLICIES = {"v1": ["short", "repetitive"], "v2": [r.name for r in RULES]}
CURRENT = "v2"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more: windows are
    sorted by hash, those equal to a neighbour are put in order of position,
    and each covers three words or those up to the next."""
    def windows(ws: Column) -> Column:
        starts = F.when(F.size(ws) >= 3, F.sequence(F.lit(0), F.size(ws) - 3)).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i"))))

    def twice(ordered: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(ordered, j)["h"] == x["h"], F.lit(False))
        found = F.filter(ordered, lambda x, k: same(x, k + 1) | (F.when(k > 0, same(x, k - 1)).otherwise(False)))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - p, F.lit(3)))),
                           F.lit(0).cast("bigint"), lambda total, n: total + n)

    return let(words, lambda ws: let(windows(ws), lambda o: let(twice(o), covered)))


def measure(docs: DataFrame, *, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and MEASURES of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def lines(t: Column) -> Column:
        return F.filter(F.split(t, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)

    found = let(text, lambda t: F.struct(
        let(words_of(t), lambda ws: F.struct(F.size(ws).cast("bigint").alias("n"), repeat_words(ws).alias("r"))).alias("w"),
        F.length(F.translate(t, SPACES, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines(t), lambda ls: F.struct(
            F.size(ls).cast("bigint").alias("n"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint").alias("dup"))).alias("l")))
    return docs.select(*[F.col(c) for c in keep], found.alias("_m")).select(
        *[F.col(c) for c in keep], F.col("_m.w.n").alias("n_words"), F.col("_m.word_chars").alias("word_chars"),
        F.col("_m.n_symbols").alias("n_symbols"), F.col("_m.l.dup").alias("n_dup_lines"),
        F.col("_m.w.r").alias("n_repeat_words"), F.col("_m.l.n").alias("n_lines"))


def bit(name: str, rules: list[Rule]) -> int:
    return 1 << [r.name for r in rules].index(name)


def mask(names: list[str], rules: list[Rule] = RULES) -> int:
    return sum(bit(n, rules) for n in set(names))


def ledger(docs: DataFrame, *, keep: list[str], text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The ``keep`` columns, the measurements and ``fail_bits``."""
    measured = measure(docs, keep=keep, text_col=text_col)
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(bit(r.name, rules))).otherwise(0).cast("bigint"))
    return measured.withColumn("fail_bits", bits)


def passes(names: list[str], rules: list[Rule] = RULES) -> Column:
    """Whether a ledger row fails none of the named rules."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(names, rules)).cast("bigint")) == 0


def apply_policy(rows: DataFrame, version: str = CURRENT, *, rules: list[Rule] = RULES,
                 policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """The ledger with ``kept`` under one version of the policy."""
    return rows.withColumn("kept", passes(policies[version], rules))


def ablation(rows: DataFrame, version: str = CURRENT, *, rules: list[Rule] = RULES,
             policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """(rule, n_failed, n_failed_only, n_kept_without): what each rule of a
    policy rejects, rejects alone, and what would be kept without it. Rows are
    first counted by their masked bits, of which there are at most 2^rules."""
    names = policies[version]
    whole = F.lit(mask(names, rules)).cast("bigint")
    counts = rows.groupBy(F.col("fail_bits").bitwiseAND(whole).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    per_rule = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(bit(n, rules)).cast("bigint").alias("own"))
                         for n in names])
    own, bits = F.col("r.own"), F.col("bits")
    total = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    return counts.withColumn("r", F.explode(per_rule)).groupBy(F.col("r.rule").alias("rule")).agg(
        total(bits.bitwiseAND(own) != 0).alias("n_failed"), total(bits == own).alias("n_failed_only"),
        total(bits.bitwiseAND(F.bitwise_not(own)) == 0).alias("n_kept_without"))
