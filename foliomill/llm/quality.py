"""Quality rules: a decision list learned by sequential covering from labelled statistics."""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_capitals", "n_marks",
)


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text; null gives zeros.

    Words are runs without ASCII white space. n_dup_lines: lines with a word, equal to an earlier line.
    n_repeat_words: words in 3-word windows found twice or more. n_lines: lines with a word. n_capitals:
    A-Z. n_marks: exclamation and question marks.
    """
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    spaces = sum(map(text.count, " \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        reached = 0  # words up to here are counted
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, reached)
                reached = i + 3
    capitals = len(raw) - len(raw.translate(None, string.ascii_uppercase.encode()))
    return (
        len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
        len(lines), len(set(words)), capitals, text.count("!") + text.count("?"),
    )


def counts(text: Column) -> Column:
    """text_counts() of a column, as a struct of longs."""

    @F.pandas_udf(", ".join(f"{c} long" for c in COUNTS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in texts], columns=list(COUNTS))

    return run(text)


def _share(a: str, b: str):
    return lambda c: c(a) / F.greatest(c(b), F.lit(1))


#: What rules test: name -> column, from a function that gives the column of a count.
STATISTICS = {
    "words": lambda c: c("n_words").cast("double"),
    "word_length": _share("word_chars", "n_words"),
    "symbols": _share("n_symbols", "word_chars"),
    "capitals": _share("n_capitals", "word_chars"),
    "marks": _share("n_marks", "n_words"),
    "repeated_lines": _share("n_dup_lines", "n_lines"),
    "repeated_words": _share("n_repeat_words", "n_words"),
    "distinct_words": _share("n_distinct_words", "n_words"),
    "words_in_a_line": _share("n_words", "n_lines"),
}


@dataclass(frozen=True)
class Rule:
    """Rejects what meets all conditions (statistic, ">" or "<=", threshold)."""

    conditions: tuple[tuple[str, str, float], ...]

    def meets(self, x: dict[str, np.ndarray]) -> np.ndarray:
        found = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, at in self.conditions:
            found &= x[name] > at if sign == ">" else x[name] <= at
        return found

    def column(self, statistic) -> Column:
        tests = [statistic(n) > F.lit(at) if sign == ">" else statistic(n) <= F.lit(at) for n, sign, at in self.conditions]
        return reduce(lambda a, b: a & b, tests)

    def __str__(self):
        return " and ".join(f"{n} {sign} {at:.4g}" for n, sign, at in self.conditions)


def _thresholds(x: np.ndarray, most: int = 64) -> np.ndarray:
    """Midpoints between neighbouring values; quantiles of those where there are many."""
    values = np.unique(x)
    between = (values[1:] + values[:-1]) / 2
    if len(between) > most:
        between = np.unique(np.quantile(x, np.linspace(0, 1, most + 2)[1:-1]))
    return between


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most_conditions: int) -> Rule:
    """Adds the condition of most information gain until no good row meets the rule."""
    rule = Rule(())
    inside = np.ones(len(bad), bool)
    while len(rule.conditions) < most_conditions and (p := int((bad & inside).sum())) and p < inside.sum():
        base, best = np.log2(p / inside.sum()), (1e-9, None)
        for name, v in x.items():
            own, wrong = v[inside], bad[inside]
            for at in _thresholds(own):
                above = own > at
                for sign, met in ((">", above), ("<=", ~above)):
                    hit = int((met & wrong).sum())
                    if hit and (gain := hit * (np.log2(hit / met.sum()) - base)) > best[0]:
                        best = (gain, (name, sign, float(at)))
        if best[1] is None:
            break
        rule = Rule((*rule.conditions, best[1]))
        inside = rule.meets(x)
    return rule


def _pruned(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The rule cut after the condition where rows held back speak best for it; its precision, its hits."""
    best = (-2.0, rule, 0.0, 0)
    for k in range(1, len(rule.conditions) + 1):
        short = Rule(rule.conditions[:k])
        met = short.meets(x)
        p, n = int((bad & met).sum()), int((~bad & met).sum())
        worth = (p - n) / max(1, p + n)
        if worth > best[0]:
            best = (worth, short, p / max(1, p + n), p)
    return best[1:]


def learn(
    x: dict[str, np.ndarray], bad: np.ndarray, *, least_precision: float = 0.95, most_rules: int = 32,
    most_conditions: int = 4, seed: int = 7,
) -> list[Rule]:
    """Sequential covering. Each rule is grown on two thirds of the rows that no earlier rule meets and
    pruned on the last third. A rule that is not least_precision precise there is dropped; three in a row
    end the covering.

    No rows, or rows of one class, give no rules: nothing is rejected.
    """
    rules: list[Rule] = []
    left, draw, dropped = np.ones(len(bad), bool), np.random.default_rng(seed), 0
    while len(rules) < most_rules and dropped < 3:
        grow = draw.random(len(bad)) < 2 / 3
        part = lambda rows: ({n: v[rows] for n, v in x.items()}, bad[rows])
        if not (bad & left & grow).any() or not (bad & left & ~grow).any():
            break
        rule = _grow(*part(left & grow), most_conditions)
        if not rule.conditions:
            break
        rule, precision, hits = _pruned(rule, *part(left & ~grow))
        if precision < least_precision or hits < 2:
            dropped += 1
            continue
        dropped = 0
        rules.append(rule)
        left &= ~rule.meets(x)
    return rules


def verdict(rules: list[Rule], count) -> Column:
    """The decision list as one ordered conditional expression: the number of the first rule met, or null.

    count: gives the column of one of COUNTS.
    """
    statistic = lambda name: STATISTICS[name](count)
    if not rules:
        return F.lit(None).cast("int")
    chain = F.when(rules[0].column(statistic), F.lit(0))
    for k, rule in enumerate(rules[1:], 1):
        chain = chain.when(rule.column(statistic), F.lit(k))
    return chain


def fit(
    docs: DataFrame, labels: DataFrame, *, most_labelled: int = 10_000, id_col: str = "doc_id", text_col: str = "text", **kwargs
) -> list[Rule]:
    """Learn from the texts of labelled documents; quality 0 is what rules reject.

    Sees the labelled documents that come first by a hash of id and text, most_labelled at most, so the sample does not
    depend on the order of rows; ties of the hash are rows alike. Only their statistics reach the driver. Labels with a
    null id or quality and those of no document are left out; a document labelled twice, or an id that repeats, counts
    twice. Very long texts are counted whole.
    """
    sample = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_id"), "quality")
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "quality").limit(most_labelled)
    rows = docs.join(F.broadcast(sample), F.col(id_col) == F.col("_id"))  # most_labelled rows of two numbers
    rows = rows.select("quality", F.xxhash64("_id", text_col).alias("_at"), F.col(text_col).alias("_text"))
    rows = rows.select("quality", "_at", counts(F.col("_text")).alias("c")).orderBy("_at", "quality", "c").limit(most_labelled)
    found = rows.select("quality", *[STATISTICS[n](lambda c: F.col(f"c.{c}")).alias(n) for n in STATISTICS]).toPandas()
    found = found.sort_values(list(found.columns), ignore_index=True)  # the same rows however Spark deals the rows
    return learn({n: found[n].to_numpy(float) for n in STATISTICS}, found["quality"].to_numpy() == 0, **kwargs)


def judge(docs: DataFrame, rules: list[Rule], *, text_col: str = "text") -> DataFrame:
    """docs with a struct column quality_: COUNTS, base_failed, rule (that rejected, or null), kept.

    base_failed: under 50 words, or over half of the words repeat in 3-word windows. A document is kept
    if neither that nor a rule speaks against it. Null and empty texts have no words and fail. Very long texts are
    counted whole. A statistic equal to a threshold counts as "<=". Every row, repeated ones too, gives one row; an empty
    table gives none. An input column named quality_ is replaced.
    """
    out = docs.withColumn("quality_", counts(F.col(text_col)))
    count = lambda c: F.col(f"quality_.{c}")
    failed = (count("n_words") < 50) | (100 * count("n_repeat_words") > 50 * count("n_words"))
    rule = verdict(rules, count)
    return out.withColumn(
        "quality_",
        F.struct("quality_.*", failed.alias("base_failed"), rule.alias("rule"), (~failed & rule.isNull()).alias("kept")),
    )
