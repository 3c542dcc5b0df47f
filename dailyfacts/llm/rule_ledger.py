"""Quality rules: a ledger of failure bits, policies over it, ablations.

Every rule is evaluated once per document. The ledger keeps the measurements and one
long with a bit per failed rule, so that another policy, or the effect of a rule, needs
no second look at the texts. All of it is built-in expressions.

Defined results: a null or empty text has no words and fails ``short``; very long texts
are measured whole; repeated rows get equal results; an empty table gives an empty
ledger; columns other than the two named are not read and so cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailyfacts.llm.common import free_name, words

#: Length of the windows in which repeats are looked for, in words.
WINDOW = 8

MEASUREMENTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
)


@dataclass(frozen=True)
class Rule:
    """``failed`` is a SQL predicate over the measurements; ``bit`` its place in the ledger."""

    name: str
    bit: int
    failed: str


@dataclass(frozen=True)
class Policy:
    """A version of what counts: the rules of which none may fail."""

    version: str
    rules: tuple[str, ...]


BASE = ("short", "repeated_words")

#: Bits are never reused: a rule that is given up leaves a gap.
RULES = (
    Rule("short", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "100 * n_symbols > 5 * word_chars"),
    Rule("capitals", 3, "100 * n_capitals > 30 * word_chars"),
    Rule("repeated_lines", 4, "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", 5, "word_chars < 2 * n_words or word_chars > 30 * n_words"),
)

POLICY = Policy("v1", tuple(rule.name for rule in RULES))
BASE_POLICY = Policy("base-v1", BASE)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    """The bits of a policy's rules; a name that no rule has is an error."""
    bits = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bits[name] for name in policy.rules)


def _from(array: Column, place: int) -> Column:
    """The array from an element on, counted from 1."""
    return F.slice(array, place, F.greatest(F.size(array), F.lit(0)))


def _paired(hashes: Column, apart: int) -> Column:
    """Hash of each element and the one so many places on; the last ones have no partner."""
    return F.zip_with(hashes, _from(hashes, 1 + apart), lambda a, b: F.xxhash64(a, b))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column of the measurements; its name is the last column's.

    Windows are compared by 64-bit hashes. A text without a repeated window, the usual
    case, costs one hash set; only the others sort their windows.
    """
    base = free_name(docs, "_ledger")
    given = docs.columns

    def name(part: str) -> str:
        return f"{base}_{part}"

    def col(part: str) -> Column:
        return F.col(f"`{name(part)}`")

    def step(df: DataFrame, **parts: Column) -> DataFrame:
        return df.withColumns({name(k): v for k, v in parts.items()})

    df = step(docs, text=F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = step(
        df,
        words=words(col("text")),
        lines=F.filter(F.split(col("text"), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    )
    df = step(df, n=F.size(col("words")))
    # Lambdas see elements only: a column of another step inside one would be computed
    # again for every element. Hashes of 2, 4 and 8 words follow from each other.
    df = step(df, one=F.transform(col("words"), lambda word: F.xxhash64(word)))
    df = step(df, two=_paired(col("one"), 1))
    df = step(df, four=_paired(col("two"), 2))
    df = step(
        df,
        windows=F.slice(_paired(col("four"), 4), 1, F.greatest(col("n") - (WINDOW - 1), F.lit(0))),
    )
    df = step(
        df, repeats=F.size(F.array_distinct(col("windows"))) < F.size(col("windows"))
    )
    # Windows by hash and place: equal ones are neighbours.
    df = step(
        df,
        sorted=F.when(
            col("repeats"),
            F.array_sort(F.transform(col("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    df = step(
        df,
        same=F.zip_with(
            col("sorted"), _from(col("sorted"), 2), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        ),
    )
    df = step(
        df,
        either=F.zip_with(
            col("same"), F.concat(F.array(F.lit(False)), col("same")), lambda after, before: after | before
        ),
    )
    df = step(
        df,
        places=F.array_sort(
            F.array_compact(
                F.zip_with(col("sorted"), col("either"), lambda x, again: F.when(again, x["i"]))
            )
        ),
    )
    # Each repeated window covers its words up to the next one, eight at most.
    covered = F.aggregate(
        F.zip_with(
            col("places"),
            _from(col("places"), 2),
            lambda here, after: F.least(F.lit(WINDOW), after - here),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    symbols = F.regexp_replace(col("text"), r"[^#*$%&|<>]+", "")
    capitals = F.regexp_replace(col("text"), r"\P{Lu}+", "")
    values = {
        "n_words": col("n"),
        "word_chars": F.length(F.array_join(col("words"), "")),
        "n_symbols": F.length(symbols),
        "n_dup_lines": F.size(col("lines")) - F.size(F.array_distinct(col("lines"))),
        "n_repeat_words": F.when(col("repeats"), covered).otherwise(0),
        "n_lines": F.size(col("lines")),
        "n_capitals": F.length(capitals),
    }
    result = F.struct(*[values[m].cast("long").alias(m) for m in MEASUREMENTS]).alias(base)
    return df.select(*[F.col(f"`{c}`") for c in given], result)


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    """A long with the bit of every failed rule, over columns named as the measurements."""
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(
            F.when(F.expr(rule.failed), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
        )
    return bits


def rule_ledger(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``key``, the measurements and ``failed_bits`` for every row."""
    measured = measure(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), "_text")
    flat = measured.select("_key", F.col(f"`{measured.columns[-1]}`.*"))
    return flat.withColumn("failed_bits", failure_bits(rules)).withColumnRenamed("_key", key)


def passes(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """True where no rule of the policy failed, over a ledger."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def keep_passing(
    docs: DataFrame, policy: Policy = POLICY, text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The rows that the policy keeps, with their own columns only."""
    measured = measure(docs, text)
    ledger = measured.columns[-1]
    # A filter would be pushed below the measurements and repeat them for every rule.
    stays = F.explode(F.when(~_fails(policy, ledger, rules), F.array(F.lit(True))))
    return measured.withColumn(f"{ledger}_stays", stays).select(*[F.col(f"`{c}`") for c in docs.columns])


def _fails(policy: Policy, ledger: str, rules: Sequence[Rule]) -> Column:
    bits = F.lit(0).cast("long")
    known = {rule.name: rule for rule in rules}
    for name in policy.rules:
        rule = known[name]
        predicate = rule.failed
        for m in sorted(MEASUREMENTS, key=len, reverse=True):
            predicate = predicate.replace(m, f"`{ledger}`.`{m}`")
        bits = bits.bitwiseOR(
            F.when(F.expr(predicate), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
        )
    return bits != 0


def ablations(ledger: DataFrame, policy: Policy = POLICY, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``rule, failed, failed_alone, kept, kept_without`` for each rule of the policy.

    Rows are counted by failure pattern first, so at most 2 to the number of rules
    reach the second step. ``kept_without`` is what the policy would keep without the rule.
    """
    patterns = ledger.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    all_bits = mask(policy, rules)
    known = {rule.name: 1 << rule.bit for rule in rules}
    counts = []
    for i, name in enumerate(policy.rules):
        has = F.col("failed_bits").bitwiseAND(F.lit(known[name]).cast("long")) != 0
        rest = F.col("failed_bits").bitwiseAND(F.lit(all_bits & ~known[name]).cast("long")) == 0
        zero = F.lit(0).cast("long")
        counts += [
            F.coalesce(F.sum(F.when(has, F.col("n"))), zero).alias(f"failed_{i}"),
            F.coalesce(F.sum(F.when(has & rest, F.col("n"))), zero).alias(f"alone_{i}"),
            F.coalesce(F.sum(F.when(rest & ~has, F.col("n"))), zero).alias(f"kept_{i}"),
            F.coalesce(F.sum(F.when(rest, F.col("n"))), zero).alias(f"without_{i}"),
        ]
    lines = [
        F.struct(
            F.lit(policy.version).alias("policy"),
            F.lit(name).alias("rule"),
            F.col(f"failed_{i}").alias("failed"),
            F.col(f"alone_{i}").alias("failed_alone"),
            F.col(f"kept_{i}").alias("kept"),
            F.col(f"without_{i}").alias("kept_without"),
        )
        for i, name in enumerate(policy.rules)
    ]
    return patterns.agg(*counts).select(F.inline(F.array(*lines)))
