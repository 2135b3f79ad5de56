"""How the sources of a language differ in their words, ranked by count cells.

Two terms of a language that have the same counts on both sides of a comparison get the same value, so nothing is
evaluated by term: terms are grouped into cells of two counts, the value is computed once per cell and weighted by the
cell's multiplicity. For a ranking, cells of equal value are merged, their cumulative multiplicity gives the first rank
of each value, and only the values that reach the wanted ranks are expanded into terms, in UTF-8 order.

Comparisons between two sources need the cells of their joint counts. Each term's counts by source make a vector; equal
vectors are one row with a multiplicity, and only the joint counts of sources that both have a term are expanded from
it. Cells with a zero follow by subtraction from each source's own cells, and the cell of two zeros from the number of
terms, so absent terms cost nothing. All arithmetic is on integers.

Defined cases: null text, language and source read as empty. Repeated rows are documents of their own. A source without
terms takes part with zero counts; in a language without kept terms every pair has the value 0. Terms of equal value
are ranked by their UTF-8 bytes. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import ready, stored

MIN_DOCS = 3
TOP = 200
SCALE = 10**9
#: Counts held per task before they are handed on.
HELD = 500_000
GROUP = ["lang", "source"]
#: Letters A-Z in lower case, a blank for each other ASCII byte, bytes of longer characters as they are.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; one row with an empty term per group."""
    ready(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                n, seen = held.setdefault((lang, source), (Counter(), Counter()))
                words = bytes(text).translate(LETTERS).split()
                size -= len(n)
                n.update(words)
                size += len(n)
                seen.update(set(words))
                if size > HELD:
                    yield from _frames(held)
                    held, size = {}, 0
        yield from _frames(held)

    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    plain = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), text)
    parts = plain.mapInPandas(count, "lang string, source string, term binary, n long, docs long")
    return parts.groupBy(*GROUP, F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _frames(held: dict) -> Iterator[pd.DataFrame]:
    for (lang, source), (n, seen) in held.items():
        n[b""] = 0
        yield pd.DataFrame({"lang": lang, "source": source, "term": list(n), "n": list(n.values()), "docs": [seen[t] for t in n]})


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + terms))``, in decimals where a product leaves 64 bits."""
    whole = F.call_function("div", (count + 1) * SCALE, total + terms)
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    long = F.call_function("div", scaled, (total + terms).cast("decimal(20,0)"))
    return F.when(count < 9 * SCALE, whole).otherwise(long) + 1


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / q)``; shares are at most ``SCALE + 1``, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


class Corpus:
    """The counts that both rankings read: written once, every further table is small beside them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        counts = stored(term_counts(docs), "divergence-counts")
        found = counts.where("term <> ''")
        kept = found.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
        #: (lang, source, term, n, whole): kept terms that occur in the group, with their count in the language.
        self.terms = stored(found.drop("docs").join(kept.drop("docs"), ["lang", "term"]), "divergence-terms")
        once = self.terms.groupBy("lang", "term").agg(F.first("whole").alias("whole"))
        langs = once.groupBy("lang").agg(F.count("*").alias("v"), F.sum("whole").alias("lang_n"))
        totals = self.terms.groupBy(*GROUP).agg(F.sum("n").alias("group_n"))
        groups = counts.where("term = ''").select(*GROUP).join(totals, GROUP, "left").join(langs, "lang", "left")
        #: (lang, source, group_n, v, lang_n): every group, also those without terms.
        self.groups = stored(groups.na.fill(0, ["group_n", "v", "lang_n"]), "divergence-groups")


def joint_cells(corpus: Corpus) -> DataFrame:
    """(lang, source, item, n, m, terms): how many kept terms have n > 0 occurrences in a source and m > 0 in a later one."""
    vector = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("vector")
    vectors = corpus.terms.groupBy("lang", "term").agg(vector).groupBy("lang", "vector").agg(F.count("*").alias("terms"))
    both = vectors.select("lang", "terms", "vector", F.explode("vector").alias("a"))
    both = both.select("lang", "terms", "a", F.explode("vector").alias("b")).where("a.source < b.source")
    sides = ["lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.col("a.n").alias("n"), F.col("b.n").alias("m")]
    return both.groupBy(*sides).agg(F.sum("terms").alias("terms"))


def rank_pairs(corpus: Corpus) -> DataFrame:
    """Every other source of the language by its divergence, summed over the cells of both counts.

    A joint cell's terms are taken from the cells where one side counts as absent, and these from the cell of both
    absent, which holds all terms: so only cells that occur are evaluated.
    """
    zero, key = F.lit(0).cast("long"), ["lang", "source", "item"]
    groups = corpus.groups.select("lang", "source", "group_n", "v")
    others = groups.select("lang", F.col("source").alias("item"), F.col("group_n").alias("item_n"))

    def value(n: Column, m: Column, back: bool = False) -> Column:
        """A cell's divergence of the source from the item, or the other way round."""
        p, q = share(n, F.col("group_n"), F.col("v")), share(m, F.col("item_n"), F.col("v"))
        return (divergence(q, p) if back else divergence(p, q)).cast("decimal(20,0)")

    def parts(rows: DataFrame, weight: Column) -> DataFrame:
        return rows.select(*key, (weight * F.col("terms").cast("decimal(17,0)")).cast("decimal(38,0)").alias("value"))

    n, m = F.col("n"), F.col("m")
    joint = joint_cells(corpus).join(groups, GROUP).join(others, ["lang", "item"])
    above, below = (value(n, m, back) - value(n, zero, back) - value(zero, m, back) + value(zero, zero, back) for back in (False, True))
    turned = parts(joint, below).select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")

    pairs = groups.join(others, "lang").where("source <> item")
    own = corpus.terms.groupBy(*GROUP, "n").agg(F.count("*").alias("terms"))
    left = parts(pairs.join(own, GROUP), value(n, zero) - value(zero, zero))
    right = parts(pairs.join(own.withColumnRenamed("source", "item"), ["lang", "item"]), value(zero, n) - value(zero, zero))
    # Without kept terms there is nothing to divide by.
    absent = pairs.select(*key, F.when(F.col("v") > 0, value(zero, zero) * F.col("v")).otherwise(0).cast("decimal(38,0)").alias("value"))

    cells = parts(joint, above).unionByName(turned).unionByName(left).unionByName(right).unionByName(absent)
    sums = cells.groupBy(*key).agg(F.sum("value").cast("long").alias("value"))
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")
    return sums.select(*GROUP, F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def rank_terms(corpus: Corpus, top: int = TOP) -> DataFrame:
    """The terms that are more frequent in a source than in its language, by divergence, to rank ``top``."""
    cells = corpus.terms.groupBy(*GROUP, "n", "whole").agg(F.count("*").alias("terms")).join(corpus.groups, GROUP)
    p, q = share(F.col("n"), F.col("group_n"), F.col("v")), share(F.col("whole"), F.col("lang_n"), F.col("v"))
    cells = cells.withColumns({"p": p, "q": q}).where("p > q").withColumn("value", divergence(F.col("p"), F.col("q")))
    values = cells.groupBy(*GROUP, "value").agg(F.sum("terms").alias("terms"))
    above = Window.partitionBy(*GROUP).orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("above", F.coalesce(F.sum("terms").over(above), F.lit(0))).where(F.col("above") < top)
    cells = cells.select(*GROUP, "n", "whole", "value").join(values.drop("terms"), [*GROUP, "value"])
    terms = corpus.terms.join(cells, [*GROUP, "n", "whole"])
    within = Window.partitionBy(*GROUP, "value").orderBy("term")
    # The limit on the place within a value is a constant, so each task keeps only its first terms before the shuffle.
    terms = terms.withColumn("place", F.row_number().over(within)).where(F.col("place") <= top)
    rank = (F.col("above") + F.col("place")).cast("int")
    return terms.select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= top)


def divergence_table(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: sources by their distance to each other, and each source's own terms."""
    corpus = Corpus(docs)
    return rank_pairs(corpus).unionByName(rank_terms(corpus))
