"""Language identification by interpolated Kneser-Ney character models.

A model is over the characters themselves: every letter of any script is a symbol, a run of anything else is the
symbol 0. Three symbols of 21 bits are one number, and a bijective mixing of it its hash, so different grams never
meet. Trigrams of all learning texts are counted by Spark (sums in the tasks, then one shuffle of counts). From these
counts alone come the continuation counts of bigrams and symbols. Grams of each order are a sorted array of hashes;
beside it stand the languages that have the gram with their log-probabilities, so a model is as large as what the
languages use, whatever their number. A gram that a language lacks is explained by the order below, weighted by the
context's back-off.

All that a gram needs, except for single symbols, has the gram's middle symbol in it. The counts are therefore dealt out
to parts by middle symbol, each of at most ``part_entries`` counts (or of one symbol): only one part at a time is on the
driver and in a broadcast. A text's sums over the parts are added up. Small models, which are the usual ones, are one
part and one pass over the texts; each further part costs a pass and no shuffle of texts.

A text is given the language of the least cross-entropy per symbol, of equal ones the first by name. ``score`` is the
share that this language gets among all, by a temperature fitted on all learning texts; ``rejected`` says that the text is
less like its language than all but one in ``1 / REJECT`` of the language's own texts.

Defined cases: a null text, or one without a letter, is ``und`` with score 0. Labels with too few characters still make
a model; a label without any letter makes none. Without any labelled text everything is ``und``. Repeated rows get equal
results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.common import fold, ready, stored

SYMBOL_BITS = 21
LOW = (1 << SYMBOL_BITS) - 1
PAIR = (1 << 2 * SYMBOL_BITS) - 1
REJECT = 0.005
#: The temperatures that calibration tries.
TEMPERATURES = np.geomspace(0.5, 64, 22)
#: How finely the places of a language's texts by entropy are told apart.
RANKS = 100_000
#: Characters of a text that are turned into trigrams at once.
SLICE = 1 << 20
#: The range of all symbols.
ALL = (0, LOW + 1)
#: Trigram counts of one part of the model: 8 + 12 bytes each where the part is used.
PART_ENTRIES = 4_000_000


def has_letter(text: str) -> bool:
    """Some character is of a letter category; number forms such as a half or a Roman numeral are none."""
    return any(map(str.isalpha, text))


@cache
def symbol_table() -> np.ndarray:
    """The symbol of each code point: itself for letters, otherwise 0."""
    points = np.arange(0x110000, dtype=np.int32)
    return points * np.fromiter((chr(p).isalpha() for p in range(len(points))), bool, len(points))


def trigrams(text: str, size: int = SLICE) -> Iterator[np.ndarray]:
    """Packed trigrams of the lower-case text, one for each symbol after two leading 0, in arrays of about ``size``."""
    table, text = symbol_table(), text.lower()
    first = last = 0
    for at in range(0, len(text), size):
        points = np.frombuffer(text[at : at + size].encode("utf-32-le", "surrogatepass"), "<u4")
        end = [0] if at + size >= len(text) else []
        row = np.concatenate([[first, last], table[points], end]).astype(np.int64)
        keep = np.r_[True, True, (row[2:] != 0) | (row[1:-1] != 0)]
        row = row[keep]
        first, last = int(row[-2]), int(row[-1])
        if len(row) > 2:
            yield (row[:-2] << 2 * SYMBOL_BITS) | (row[1:-1] << SYMBOL_BITS) | row[2:]


def mixed(grams: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash."""
    x = grams.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order with the sums of their numbers."""
    unique, place = np.unique(keys, return_inverse=True)
    return unique, np.bincount(place, n, len(unique)).astype(np.int64)


def count_trigrams(docs: DataFrame, held: int = 2_000_000) -> DataFrame:
    """(lang, gram, n): trigram counts of all texts with a language. A task holds about ``held`` grams of a language."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def add(lang: str) -> None:
            keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            if lang in sums:
                keys, n = np.concatenate([sums[lang][0], keys]), np.concatenate([sums[lang][1], n])
            sums[lang] = _summed(keys, n)

        def rows(lang: str) -> pd.DataFrame:
            keys, n = sums.pop(lang)
            return pd.DataFrame({"lang": lang, "gram": keys, "n": n})

        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                for grams in trigrams(text):
                    waiting.setdefault(lang, []).append(grams)
                    sizes[lang] = sizes.get(lang, 0) + len(grams)
                    if sizes[lang] > held:
                        add(lang)
                        sizes[lang] = 0
                        if sum(len(k) for k, _ in sums.values()) > held:
                            yield from [rows(x) for x in list(sums)]
            if sum(sizes.values()) > held:
                for lang in list(waiting):
                    add(lang)
                sizes.clear()
                if sum(len(k) for k, _ in sums.values()) > held:
                    yield from [rows(x) for x in list(sums)]
        for lang in list(waiting):
            add(lang)
        yield from [rows(x) for x in list(sums)]

    part = docs.where("text is not null and lang is not null").select("lang", "text")
    return part.mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Table:
    """Sorted hashes of grams; entries ``starts[i]`` to ``starts[i + 1]`` are the languages that have gram i."""

    keys: np.ndarray
    starts: np.ndarray
    languages: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, grams: np.ndarray, languages: np.ndarray, values: np.ndarray) -> Table:
        hashes = mixed(grams)
        order = np.argsort(hashes, kind="stable")
        keys, starts = np.unique(hashes[order], return_index=True)
        return cls(keys, np.append(starts, len(order)), languages[order].astype(np.int32), values[order].astype(np.float64))

    def fill(self, grams: np.ndarray, out: np.ndarray) -> np.ndarray:
        """``out`` (a row for each gram, a column for each language) with the values that the table has."""
        if not len(self.keys) or not len(grams):
            return out
        hashes = mixed(grams)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == hashes)
        begin = self.starts[at[hit]]
        number = self.starts[at[hit] + 1] - begin
        rows = np.repeat(hit, number)
        entries = np.arange(len(rows)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(begin, number)
        out[rows, self.languages[entries]] = self.values[entries]
        return out


@dataclass
class Symbols:
    """What all parts share: languages, discounts of bigrams and trigrams, log-probabilities of symbols."""

    languages: list[str]
    discounts: np.ndarray
    table: Table
    unseen: np.ndarray


@dataclass
class Part:
    """The grams whose middle symbols are in a range (its end exclusive): log-probabilities by order and log back-off weights of their contexts."""

    symbols: Symbols
    middles: tuple[int, int]
    three: Table
    two: Table
    back_three: Table
    back_two: Table

    def sums(self, text: str | None) -> tuple[np.ndarray, int]:
        """Of the part's grams in a text: the sum of negated log-probabilities by language, and their number."""
        n_languages = len(self.symbols.languages)
        total, size = np.zeros(n_languages), 0
        for grams in trigrams(text or ""):
            grams, n = np.unique(grams, return_counts=True)
            if self.middles != ALL:
                middle = (grams >> SYMBOL_BITS) & LOW
                own = (middle >= self.middles[0]) & (middle < self.middles[1])
                grams, n = grams[own], n[own]
            if len(grams):
                total -= n @ self.log_probs(grams)
                size += int(n.sum())
        return total, size

    def log_probs(self, grams: np.ndarray) -> np.ndarray:
        shape = (len(grams), len(self.symbols.languages))
        out = self.three.fill(grams, np.full(shape, np.nan))
        rows = np.flatnonzero(np.isnan(out).any(1))
        if not len(rows):
            return out
        short = grams[rows]
        shape = (len(rows), shape[1])
        one = self.symbols.table.fill(short & LOW, np.tile(self.symbols.unseen, (len(rows), 1)))
        one += self.back_two.fill((short >> SYMBOL_BITS) & LOW, np.zeros(shape))
        two = self.two.fill(short & PAIR, one)
        two += self.back_three.fill(short >> SYMBOL_BITS, np.zeros(shape))
        out[rows] = np.where(np.isnan(out[rows]), two, out[rows])
        return out


def _discount(once: float, twice: float) -> float:
    """The absolute discount n1 / (n1 + 2 n2)."""
    return float(np.clip(once / (once + 2.0 * twice), 0.1, 0.9)) if once and twice else 0.5


def build_symbols(symbols: pd.DataFrame, pairs: pd.DataFrame, triples: pd.DataFrame) -> Symbols:
    """From (lang, symbol, n), n being the different symbols before it, and (lang, once, twice) of both higher orders."""
    languages = sorted(triples["lang"])
    number = {x: i for i, x in enumerate(languages)}
    lang = symbols["lang"].map(number).to_numpy(np.int64)
    n = symbols["n"].to_numpy(np.float64)
    discounts = np.zeros((len(languages), 2))
    for column, rows in enumerate((pairs, triples)):
        for row in rows.itertuples():
            discounts[number[row.lang], column] = _discount(row.once, row.twice)
    kinds = np.bincount(lang, minlength=len(languages))
    totals = np.bincount(lang, n, len(languages))
    d1 = np.array([_discount((n[lang == i] == 1).sum(), (n[lang == i] == 2).sum()) for i in range(len(languages))])
    # One more than the symbols of all languages: those that none of them has.
    even = d1 * kinds / totals / (symbols["symbol"].nunique() + 1)
    values = np.log((n - d1[lang]) / totals[lang] + even[lang])
    return Symbols(languages, discounts, Table.of(symbols["symbol"].to_numpy(np.int64), lang, values), np.log(even))


def build_part(symbols: Symbols, counts: pd.DataFrame, middles: tuple[int, int] = ALL) -> Part:
    """Interpolated Kneser-Ney from all (lang, gram, n) whose middle symbols are in a range."""
    number = {x: i for i, x in enumerate(symbols.languages)}
    lang = counts["lang"].map(number).to_numpy(np.int64)
    grams, n = counts["gram"].to_numpy(np.int64), counts["n"].to_numpy(np.float64)
    d2, d3 = symbols.discounts.T
    pairs, pair_of, before = _groups(lang, grams & PAIR)
    pair_lang, pair_gram = pairs
    # Bigrams by the number of different symbols before them; contexts are their first symbols.
    heads, head_of, kinds = _groups(pair_lang, pair_gram >> SYMBOL_BITS)
    sums = np.bincount(head_of, before, len(kinds))
    weight = d2[heads[0]] * kinds / sums
    single = np.full((len(pair_gram), len(symbols.languages)), np.nan)
    single = symbols.table.fill(pair_gram & LOW, single)[np.arange(len(pair_gram)), pair_lang] if len(pair_gram) else np.zeros(0)
    two = (before - d2[pair_lang]) / sums[head_of] + weight[head_of] * np.exp(single)
    # Trigrams by their counts; contexts are their first two symbols.
    contexts, context_of, kinds3 = _groups(lang, grams >> SYMBOL_BITS)
    sums3 = np.bincount(context_of, n, len(kinds3))
    weight3 = d3[contexts[0]] * kinds3 / sums3
    three = (n - d3[lang]) / sums3[context_of] + weight3[context_of] * two[pair_of]
    return Part(
        symbols,
        middles,
        Table.of(grams, lang, np.log(three)),
        Table.of(pair_gram, pair_lang, np.log(two)),
        Table.of(contexts[1], contexts[0], np.log(weight3)),
        Table.of(heads[1], heads[0], np.log(weight)),
    )


def _groups(lang: np.ndarray, grams: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Different (language, gram), the place of each row among them, and their numbers of rows."""
    order = np.lexsort((grams, lang))
    new = np.ones(len(order), bool)
    new[1:] = (lang[order][1:] != lang[order][:-1]) | (grams[order][1:] != grams[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    return (lang[first], grams[first]), place, np.bincount(place, minlength=len(first))


@dataclass
class Model:
    """Counts as a table, what the parts share, and the range of middle symbols of each part."""

    counts: DataFrame
    symbols: Symbols
    parts: list[tuple[int, int]]
    temperature: float = 1.0
    limits: np.ndarray | None = None

    @property
    def languages(self) -> list[str]:
        return self.symbols.languages

    def part(self, middles: tuple[int, int]) -> Part:
        own = self.counts.where((_middle() >= middles[0]) & (_middle() < middles[1]))
        return build_part(self.symbols, own.toPandas(), middles)


def _middle() -> Column:
    return F.shiftright("gram", SYMBOL_BITS).bitwiseAND(F.lit(LOW))


def count_model(docs: DataFrame, part_entries: int = PART_ENTRIES) -> Model:
    """The models of all languages, from all texts with a language."""
    counts = stored(count_trigrams(docs), "language-counts")
    pairs = counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(PAIR)).alias("pair")).agg(F.count("*").alias("n"))
    symbols = pairs.groupBy("lang", F.col("pair").bitwiseAND(F.lit(LOW)).alias("symbol")).agg(F.count("*").alias("n"))
    rare = [F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")]
    # At most a row for each language and letter of Unicode, and a row for each language.
    shared = build_symbols(symbols.toPandas(), pairs.groupBy("lang").agg(*rare).toPandas(), counts.groupBy("lang").agg(*rare).toPandas())
    by_middle = counts.groupBy(_middle().alias("middle")).agg(F.count("*").alias("n")).orderBy("middle").toPandas()
    starts, size = [0], 0
    for middle, n in zip(by_middle["middle"].tolist(), by_middle["n"].tolist(), strict=True):
        if size and size + n > part_entries:
            starts.append(middle)
            size = 0
        size += n
    return Model(counts, shared, list(zip(starts, [*starts[1:], ALL[1]], strict=True)))


def entropies(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``sums`` and ``n_grams``: negated log-probabilities by language over ``n_grams`` symbols."""
    spark = docs.sparkSession
    ready(spark)

    def summed(middles: tuple[int, int]) -> Column:
        sent = spark.sparkContext.broadcast(model.part(middles))  # at most part_entries counts, or one middle symbol's

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                rows = [sent.value.sums(t) for t in texts]
                yield pd.DataFrame({"sums": [r[0] for r in rows], "n_grams": [r[1] for r in rows]})

        return F.pandas_udf(run, "sums array<double>, n_grams long")(F.col("text"))

    if len(model.parts) == 1:
        return docs.withColumn("_s", summed(ALL)).select(*docs.columns, "_s.sums", "_s.n_grams")
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "language-texts")
    out = None
    for middles in model.parts:
        part = rows.select("_row", summed(middles).alias("_s")).select("_row", "_s.sums", "_s.n_grams")
        part = stored(part, "language-sums")
        out = part if out is None else out.unionByName(part)
    n_languages = len(model.languages)
    added = out.groupBy("_row").agg(
        F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(n_languages))).alias("sums"), F.sum("n_grams").alias("n_grams")
    )
    return rows.join(added, "_row").select(*docs.columns, "sums", "n_grams")


def fit(docs: DataFrame, part_entries: int = PART_ENTRIES) -> Model:
    """Count over all documents outside the held-out fold, and calibrate on all of them."""
    learning = docs.select("doc_id", "text", "lang").where(F.coalesce(fold(F.col("doc_id")) != 2, F.lit(False)))
    model = count_model(learning, part_entries)
    if model.languages:
        labelled = learning.where(F.col("lang").isin(model.languages)).select("lang", "text")
        # Written before they are filtered: a filter on what the model gives would score every text twice.
        rows = stored(entropies(labelled, model).select("lang", "sums", "n_grams"), "language-entropies")
        calibrate(model, rows.where("n_grams > 0"))
    return model


def calibrate(model: Model, rows: DataFrame) -> None:
    """Set the temperature of highest likelihood and each language's entropy limit, from (lang, sums, n_grams) of all rows.

    A row for each language comes to the driver. The limit is an entropy of one of the language's texts, whose place among
    them is right to one in ``RANKS``.
    """
    number = F.array_position(F.lit(model.languages), F.col("lang")).cast("int")
    entropy = F.transform("sums", lambda x: x / F.col("n_grams"))
    rows = rows.select("lang", entropy.alias("e"), F.array_min(entropy).alias("least"), F.get(entropy, number - 1).alias("own"))

    def likelihood(t: float) -> Column:
        others = F.aggregate("e", F.lit(0.0), lambda a, x: a + F.exp((F.col("least") - x) * t))
        return F.sum((F.col("least") - F.col("own")) * t - F.log(others))

    likelihoods = [likelihood(t) for t in TEMPERATURES.tolist()]
    limit = F.percentile_approx("own", F.lit(1 - REJECT), F.lit(RANKS))
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), limit.alias("limit"), F.array(*likelihoods).alias("likelihoods")).collect()
    if not found:
        return
    total = np.sum([row["likelihoods"] for row in sorted(found, key=lambda row: row["lang"])], axis=0)
    model.temperature = float(TEMPERATURES[int(np.argmax(total))])
    limits = {row["lang"]: row["limit"] for row in found if row["n"] >= 20}
    model.limits = np.array([limits.get(lang, np.inf) for lang in model.languages])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``text`` give doc_id, lang_pred, score, cross_entropy, rejected."""
    if not model.languages:
        return docs.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("cross_entropy"), F.lit(True).alias("rejected"))
    limits = model.limits if model.limits is not None else np.full(len(model.languages), np.inf)
    out = entropies(docs.select("doc_id", "text"), model).select("doc_id", "sums", "n_grams", F.array_min("sums").alias("least"))
    size = F.greatest("n_grams", F.lit(1))
    share = F.aggregate("sums", F.lit(0.0), lambda a, x: a + F.exp((F.col("least") - x) / size * model.temperature))
    best = (F.array_position("sums", F.col("least")) - 1).cast("int")
    known, entropy = F.col("n_grams") > 0, F.col("least") / size
    return out.select(
        "doc_id",
        F.when(known, F.get(F.lit(model.languages), best)).otherwise("und").alias("lang_pred"),
        F.when(known, 1.0 / share).otherwise(0.0).alias("score"),
        F.when(known, entropy).otherwise(0.0).alias("cross_entropy"),
        F.when(known, entropy > F.get(F.lit(limits.tolist()), best)).otherwise(True).alias("rejected"),
    )


def language_table(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    out = identify(docs, fit(docs))
    held = F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
