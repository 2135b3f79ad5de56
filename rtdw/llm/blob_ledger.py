"""Secret scans by an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text. The ledger is a table of what has been
scanned: one row per blob and rule version, with the findings (none is a finding too). A scan reads only the blobs
that the ledger lacks under the present rules, each once however many paths and versions hold it, appends them, and
joins the ledger's findings back to all paths. Changing a rule changes the rule version and so scans anew.

Everything is DataFrame expressions. Copies of a blob are reduced on the map side before the one shuffle that texts
take; findings go back by a join on the blob, whose hot blobs adaptive execution splits. A ledger has one writer at a
time, so it holds a blob once per rule version.

Defined cases: a null text is the empty blob; repeated rows and copies get equal findings; a ledger that does not exist
is empty. Extra columns of the versions do not matter.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rtdw.llm.spans import joined, matches, of_kind

KINDS = ("assign", "access", "hex", "pem", "jwt", "service")
# What counts as each kind.
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
# Added by this scanner: private key headers, signed web tokens, service tokens with well-known beginnings.
PEM = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
JWT = r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
SERVICE = r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+)"
SHORTEST_VALUE = 6
RULES = (ASSIGN, ACCESS, HEX, PEM, JWT, SERVICE)
RULE_VERSION = hashlib.sha256("\n".join((*RULES, str(SHORTEST_VALUE))).encode()).hexdigest()[:16]
LEDGER_TYPE = "blob string, rule_version string, spans array<struct<start:bigint,kind:int,end:bigint>>"


def blob_spans(text: Column) -> Column:
    """All findings of a text, by start and kind."""

    def kind(number: int, found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))

    assigned = matches(text, ASSIGN, text.contains(":") | text.contains("="))
    long_enough = F.filter(assigned, lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= SHORTEST_VALUE)
    return F.array_sort(
        F.concat(
            kind(0, long_enough),
            kind(1, matches(text, ACCESS, text.contains("AKIA"))),
            kind(2, matches(text, HEX, text.rlike(HEX))),
            kind(3, matches(text, PEM, text.contains("PRIVATE KEY-----"))),
            kind(4, matches(text, JWT, text.contains("eyJ"))),
            kind(5, matches(text, SERVICE, text.contains("gh") & text.contains("_") | text.contains("xox") | text.contains("sk_live_"))),
        )
    )


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan(versions: DataFrame, ledger: str, first_time: bool = False, text: str = "text") -> DataFrame:
    """Bring the ledger (a folder in shared storage) up to date with all versions; the ledger under the present rules.

    ``first_time`` says that the ledger does not exist yet.
    """
    spark = versions.sparkSession
    blobs = versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(text, F.lit("")).alias("content"))
    if not first_time:
        known = spark.read.schema(LEDGER_TYPE).parquet(f"{ledger}/*").where(F.col("rule_version") == RULE_VERSION)
        blobs = blobs.join(known.select("blob").distinct(), "blob", "left_anti")
    unseen = blobs.groupBy("blob").agg(F.first("content").alias("content"))
    scanned = unseen.select("blob", F.lit(RULE_VERSION).alias("rule_version"), blob_spans(F.col("content")).alias("spans"))
    scanned.write.parquet(f"{ledger}/batch-{uuid.uuid4().hex[:12]}")
    return spark.read.schema(LEDGER_TYPE).parquet(f"{ledger}/*").where(F.col("rule_version") == RULE_VERSION)


def findings(versions: DataFrame, ledger: DataFrame, text: str = "text") -> DataFrame:
    """Every version with its columns other than the text, its ``blob`` and the blob's ``spans``."""
    paths = versions.withColumn("blob", blob_id(F.col(text))).drop(text)
    return paths.join(ledger.select("blob", "spans"), "blob", "left")


def secrets_table(docs: DataFrame, ledger: str, first_time: bool = True) -> DataFrame:
    """Per document: doc_id, counts of the three fixed kinds, digest of their spans, and all spans."""
    seen = scan(docs.select("doc_id", "text"), ledger, first_time)
    out = findings(docs.select("doc_id", "text"), seen)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [of_kind(F.col("spans"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return out.select("doc_id", *counts, F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(F.col("spans"), KINDS).alias("spans"), "blob")
