"""Quality rules: a decision list learned by sequential covering, applied as one Spark conditional expression.

Statistics of each text come from one Arrow-batched pass. From labelled statistics, rules (conjunctions of
thresholds that name low quality) are grown condition by condition, pruned on documents not used for growing, and put
in order; documents that a rule covers leave before the next is grown. A rule that fails is left out, and learning goes on
without the low quality it was grown for, until no first condition gains more than it takes to name it. The list becomes ``CASE WHEN`` over the
statistics' columns.

Defined cases: a null text has no words; an empty text has none either; a text without a line feed is one line. A list
learned from no usable labels (none, or of one class) is empty and keeps every document that passes the base rules.
Repeated rows get equal results. Extra columns of the input do not matter.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import free_name, labelled_sample, ready, stored

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS_TYPE = ", ".join(f"{c} long" for c in (*COUNTS, "n_lines", "n_distinct", "n_digits", "n_upper", "n_ends"))
SPACES = " \t\n\x0b\x0c\r"


def text_counts(text: str | None) -> tuple[int, ...]:
    """The statistics of one text, in the order of ``STATS_TYPE``."""
    text = text or ""
    words = text.encode().split()  # bytes split at exactly the six white-space characters
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(triples)) < len(triples):
        found, until = Counter(triples), 0
        for at, triple in enumerate(triples):
            if found[triple] > 1:
                repeated += at + 3 - max(at, until)
                until = at + 3
    filled = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, "#*$%&|<>")),
        len(filled) - len(set(filled)),
        repeated,
        len(filled),
        len(set(words)),
        sum(map(text.count, "0123456789")),
        sum(word[:1].isupper() for word in words),
        sum(word.endswith((b".", b"!", b"?")) for word in words),
    )


def statistics(docs: DataFrame, text: str = "text") -> Column:
    """A struct column with the statistics of a text column."""
    ready(docs.sparkSession)

    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_counts(t) for t in texts], columns=[p.split()[0] for p in STATS_TYPE.split(", ")])

    return F.pandas_udf(count, STATS_TYPE)(F.col(text))


def ratios(s: str) -> dict[str, Column]:
    """The measures that rules may test, from the struct column ``s``."""
    words, lines = F.greatest(F.col(f"{s}.n_words"), F.lit(1)), F.greatest(F.col(f"{s}.n_lines"), F.lit(1))
    chars = F.greatest(F.col(f"{s}.word_chars"), F.lit(1))
    return {
        "words": F.col(f"{s}.n_words") * 1.0,
        "mean_word": F.col(f"{s}.word_chars") / words,
        "symbols_per_word": F.col(f"{s}.n_symbols") / words,
        "dup_lines": F.col(f"{s}.n_dup_lines") / lines,
        "repeated": F.col(f"{s}.n_repeat_words") / words,
        "distinct": F.col(f"{s}.n_distinct") / words,
        "digits": F.col(f"{s}.n_digits") / chars,
        "capitals": F.col(f"{s}.n_upper") / words,
        "sentence_ends": F.col(f"{s}.n_ends") / words,
        "line_words": F.col(f"{s}.n_words") / lines,
    }


@dataclass(frozen=True)
class Rule:
    """All of ``conditions`` (measure, ``<=`` or ``>``, threshold) together name low quality."""

    conditions: tuple[tuple[str, str, float], ...]

    def covers(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), bool)
        for name, sign, threshold in self.conditions:
            out &= table[name] <= threshold if sign == "<=" else table[name] > threshold
        return out

    def column(self, measures: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, sign, threshold in self.conditions:
            out = out & (measures[name] <= threshold if sign == "<=" else measures[name] > threshold)
        return out


def learn(table: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.9) -> list[Rule]:
    """Sequential covering. ``table`` has an array per measure, ``bad`` is true for low quality.

    Every third document is kept from growing and used to prune; a rule enters the list when at least three pruning
    documents of low quality, and the stated share of those it covers, agree with it, and if that is no chance among the
    rules refused so far. The low quality that a refused rule was grown for is set aside; the good documents beside it
    still count against other rules.
    """
    bad = np.asarray(bad, bool)
    grow = np.arange(len(bad)) % 3 != 0
    left, sought, rules, refused = np.ones(len(bad), bool), bad & grow, [], 0
    orders = {n: np.argsort(v, kind="stable") for n, v in table.items()}
    while sought.any():
        grown = _grow(table, sought, left & grow & (sought | ~bad), orders)
        if not grown.conditions:
            break
        rule = _prune(grown, table, bad, left & ~grow)
        covered = rule.covers(table) & left
        held = covered & ~grow
        hits = (held & bad).sum()
        enough = hits >= 3 and hits >= precision * held.sum()
        if not enough or _evidence(rule, table, bad, left & ~grow) < np.log2(20 * (1 + refused)):
            sought &= ~grown.covers(table)
            refused += 1
            continue
        rules.append(rule := _centred(rule, table, covered & bad))
        left &= ~rule.covers(table)
        sought &= left
    return rules


def _grow(table, bad, rows, orders) -> Rule:
    """Add the condition of highest information gain until only low quality is covered or nothing gains.

    Thresholds lie between any two neighbouring values of the rows still covered. The first condition must save more
    bits than it takes to name it among all that could be taken; pruning judges the others.
    """
    rule, rows = Rule(()), rows.copy()
    while (rows & ~bad).any():
        p, n = (rows & bad).sum(), (rows & ~bad).sum()
        best, found, choices = 0.0, None, 0
        for name, order in orders.items():
            order = order[rows[order]]
            values, low = table[name][order], np.cumsum(bad[order])
            cut = np.flatnonzero(values[1:] > values[:-1])
            if not len(cut):
                continue
            choices += 2 * len(cut)
            p_below, n_below = low[cut], cut + 1 - low[cut]
            for sign, pp, nn in (("<=", p_below, n_below), (">", p - p_below, n - n_below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p / (p + n))), -1.0)
                at = int(np.argmax(gain))
                if gain[at] > best:
                    below, above = float(values[cut[at]]), float(values[cut[at] + 1])
                    middle = below + (above - below) / 2.0
                    best, found = gain[at], (name, sign, middle if middle < above else below)
        if not found or not rule.conditions and best <= np.log2(choices):
            break
        rule = Rule((*rule.conditions, found))
        rows &= Rule((found,)).covers(table)
    return rule


def _evidence(rule: Rule, table, bad, rows) -> float:
    """Bits against chance: how unlikely the rule's hits are at the best share of its beginnings, or at a half if that is less."""
    covered = rule.covers(table) & rows
    share, chance = bad[covered].mean(), 0.0
    for size in range(len(rule.conditions)):
        chance = max(chance, bad[Rule(rule.conditions[:size]).covers(table) & rows].mean())
    chance = min(chance, 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        bits = share * np.log2(share / chance) + np.nan_to_num((1 - share) * np.log2((1 - share) / (1 - chance)))
    return float(covered.sum() * bits)


def _prune(rule: Rule, table, bad, rows) -> Rule:
    """The shortest beginning of the conditions with the best share of hits among the documents kept apart."""
    best, kept = -1.0, rule
    for size in range(1, len(rule.conditions) + 1):
        part = Rule(rule.conditions[:size])
        covered = part.covers(table) & rows
        worth = (covered & bad).sum() / (covered.sum() + 1.0)
        if worth > best + 1e-9:
            best, kept = worth, part
    return kept


def _centred(rule: Rule, table, hits) -> Rule:
    """Each threshold halfway towards the nearest of the rule's own hits: all stay covered, no others come in.

    Growing takes thresholds from the documents it has seen, often the last good one's value. A good document that is
    a little beyond all of those seen is then left alone.
    """
    conditions = []
    for name, sign, threshold in rule.conditions:
        nearest = float(table[name][hits].max() if sign == "<=" else table[name][hits].min())
        conditions.append((name, sign, (threshold + nearest) / 2.0))
    return Rule(tuple(conditions))


def verdict(rules: list[Rule], s: str) -> Column:
    """The list as one conditional expression: false where a rule applies, else true."""
    measures, out = ratios(s), None
    for rule in rules:
        condition = rule.column(measures)
        out = F.when(condition, False) if out is None else out.when(condition, False)
    return F.lit(True) if out is None else out.otherwise(True)


def fit(stats: DataFrame, labels: DataFrame, max_rows: int = 30_000) -> list[Rule]:
    """Learn from at most ``max_rows`` labelled documents (``quality`` 0 is low) of a table (doc_id, stats)."""
    sample = labelled_sample(stats, labels, "quality", max_rows, train_only=False)
    measures = ratios("stats")
    rows = sample.select("doc_id", "quality", *(c.alias(n) for n, c in measures.items())).toPandas()
    rows = rows.sort_values(["doc_id", "words"], kind="stable")
    return learn({n: rows[n].to_numpy(float) for n in measures}, rows["quality"].to_numpy() == 0)


def quality_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, ``base_failed`` and ``kept``."""
    stats = stored(docs.select("doc_id", statistics(docs).alias("stats")), "quality-stats")
    return stats.select(
        "doc_id",
        *(F.col(f"stats.{c}").alias(c) for c in COUNTS),
        base_failed("stats").alias("base_failed"),
        (~base_failed("stats") & verdict(fit(stats, labels), "stats")).alias("kept"),
    )


def base_failed(s: str) -> Column:
    return (F.col(f"{s}.n_words") < 50) | (F.col(f"{s}.n_repeat_words") * 100 > F.col(f"{s}.n_words") * 50)


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, "quality", 30_000, train_only=False)
    stats = stored(sample.select("doc_id", statistics(sample).alias("stats")), "quality-stats")
    rules = fit(stats, labels)
    name = free_name(docs, "_quality_stats_")
    scored = docs.withColumn(name, statistics(docs))
    return scored.where(~base_failed(name) & verdict(rules, name)).drop(name)
