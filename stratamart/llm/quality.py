"""Quality rules as a ledger: every rule is evaluated once, decisions are bit operations.

``ledger`` reads each text once and stores the measurements and one long with a bit per
failed rule. Policies are versioned masks over those bits: a new policy, or the effect of
leaving a rule out, needs no text again.

Defined cases: a null text counts as empty (no words, so it fails ``few_words``); other
columns, null or not, are passed over untouched; repeated rows give repeated ledger rows;
an empty table gives an empty ledger. Columns of the input other than the id and the text
are not read, so they cannot clash. Whole texts are read, whatever their length.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from stratamart.llm.common import SPACES, WORD

MEASURES = {
    "n_words": "non-space runs",
    "word_chars": "code points in words",
    "n_symbols": "characters of #*$%&|<>",
    "n_upper": "letters A-Z",
    "n_lines": "lines with a word",
    "n_dup_lines": "lines with a word, equal to an earlier line",
    "n_repeat_words": "words in three-word windows found twice or more",
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule fails where the SQL condition over the measurements holds."""

    bit: int
    name: str
    fails: str

    @property
    def mask(self) -> int:
        return 1 << self.bit


# Bits are never reused: stored ledgers keep their meaning.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "shouting", "100 * n_upper > 40 * word_chars"),
)
#: Policies by version: the rules that reject a document. The base is part of each.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"


def mask_of(names) -> int:
    masks = {rule.name: rule.mask for rule in RULES}
    return sum(masks[name] for name in names)


def _repeat_words(words: list[str]) -> int:
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict = {}
    repeated = set()
    for window in windows:
        if window in seen:
            repeated.add(window)
        seen[window] = True
    count, covered = 0, 0
    for i, window in enumerate(windows):
        if window in repeated:
            count += i + 3 - max(i, covered)
            covered = i + 3
    return count


MEASURED = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])


@F.pandas_udf(MEASURED)
def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """All measurements of a column of texts."""
    find, upper = re.compile(WORD).findall, re.compile("[A-Z]").findall

    def row(text: str | None) -> tuple:
        text = text or ""
        words = find(text)
        lines = [line for line in text.split("\n") if line.strip(SPACES)]
        return (
            len(words),
            len(text) - sum(map(text.count, SPACES)),
            sum(map(text.count, SYMBOLS)),
            len(upper(text)),
            len(lines),
            len(lines) - len(set(lines)),
            _repeat_words(words),
        )

    for batch in batches:
        yield pd.DataFrame([row(text) for text in batch], columns=list(MEASURES))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the measurements, ``failures`` (a bit per rule)."""
    measured = docs.select(F.col(id_col), measure(F.col(text_col)).alias("measured"))
    failures = " + ".join(f"IF({rule.fails}, {rule.mask}L, 0L)" for rule in RULES)
    return measured.select(id_col, "measured.*").withColumn("failures", F.expr(failures))


def kept(policy: str = CURRENT):
    """Column over a ledger: true where no rule of the policy failed."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(POLICIES[policy]))) == 0


def ablation(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it fails, those only it fails, those kept without it.

    Ledger rows are first counted per combination of bits (at most 2^rules rows), so the
    rules are compared on a few rows however many documents there are.
    """
    mask = mask_of(POLICIES[policy])
    combos = ledger.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    rules = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(r.mask).cast("long").alias("mask"))
            for r in RULES
            if r.mask & mask
        ]
    )

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias

    bit = F.col("r.mask")
    return (
        combos.select("bits", "n", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            total(F.col("bits").bitwiseAND(bit) != 0)("n_failed"),
            total(F.col("bits") == bit)("n_failed_alone"),
            total((F.col("bits") == bit) | (F.col("bits") == 0))("n_kept_without"),
        )
    )


def filter_documents(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows a policy keeps, with all their columns and no shuffle."""
    rows = docs.select(F.struct("*").alias("row"))
    judged = ledger(rows.select("row", F.col("row.text").alias("text")), "row")
    return judged.filter(kept(policy)).select("row.*")
