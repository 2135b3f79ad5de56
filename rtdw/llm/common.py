"""What several text operators share: tables in the shared folder, labelled samples, connected components."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rtdw.session import run_dir, ship_package

#: White space that separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_SPACE = "\\x20\\x09-\\x0D"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, without lineage, safe when executors go."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> None:
    """Workers can import this package, and ``checkpoint()`` has a folder (its own only where none is set)."""
    ship_package(spark)
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="rtdw-"))


def fold(doc_id):
    """The document's fold of four, by the CRC-32 of its id as text; ids that are null have none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, train_only: bool) -> DataFrame:
    """At most ``max_rows`` rows (a pseudo-random choice by id) with a 0/1 ``label``, as a column of that name.

    The labels are cut down before the join, so that a bounded number of ids meets the documents and only chosen rows are
    shuffled: the ids are broadcast (``max_rows`` of 16 bytes). Of rows that share an id the least one stands for all.
    """
    chosen = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if train_only:
        chosen = chosen.where(fold(F.col("doc_id")) != 2)
    chosen = chosen.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = docs.join(F.broadcast(chosen), "doc_id")
    rest = [c for c in docs.columns if c != "doc_id"]
    least = found.groupBy("doc_id", label).agg(F.min(F.struct(*rest)).alias("least"))
    return least.select("doc_id", "least.*", label)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the least node of its connected component, for all nodes of edges ``(a, b)``.

    Large-star and small-star steps in turn until no edge changes: each step groups edges by node (with partial
    minima on the map side) and joins the minimum back, so a node of very high degree is a skewed join that adaptive
    execution splits, never a list in one task. Steps are cut by checkpoints in the shared folder. Edges with a null
    end are left out; a node without edges does not appear.
    """
    ready(edges.sparkSession)
    edges = edges.where("a is not null and b is not null and a <> b").distinct().checkpoint()
    seen = _digest(edges)
    for _ in range(rounds):
        if not seen[0]:
            break
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", "a"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these; afterwards ``a`` is always the least."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    spread = down.join(least, "a").select(F.col("m").alias("a"), "b")
    return spread.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
