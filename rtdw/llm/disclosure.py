"""Information-theoretic sanitisation: words that give a protected entity away are taken out along with the entity.

Protected entities are e-mail addresses, network addresses, card and phone numbers found by fixed patterns. A word that
keeps company with an entity carries information about it: their pointwise mutual information, estimated from the
whole corpus as ``log2(p(c|t) * N / n(c))`` over documents (rows; c and t stand together in n(c,t) of them, however
far apart). Its share of the entity's own information ``log2(N / n(c))`` says how much of the entity the word discloses:
near 1 the word alone names it. From ``generalise`` on the word is replaced by a general one, from ``remove`` on it is
removed, wherever it stands in the documents of that entity. ``p(c|t) = (n(c,t) + PRIOR * n(c) / N) / (n(t) + PRIOR)``
is drawn towards the entity's own frequency by ``PRIOR`` of a document, the more the rarer the word.

There is no least number of documents, but a test against chance. Were the ``n(t)`` places of a word dealt to documents at
random, each would fall among the entity's documents by ``q``, their share of all distinct words of all documents. With
``V`` words in the corpus, about ``V * exp(-n(t) * KL(n(c,t) / n(t), q))`` of them (Chernoff's bound) would keep such company
with the entity by chance; only where this is at most ``CHANCE`` of a word does a word disclose. So the rare words that any
text holds stay beside an entity that is seen once, and an entity loses at most about ``CHANCE`` words for nothing.

Everything is DataFrame expressions: spans come from :mod:`rtdw.llm.spans`. Documents of words and of entities are
counted before any join. An entity's documents are joined to their distinct words, but only entities that a word could
pass the test with (one that stands in all of their documents and nowhere else), and only to words that could reach
``generalise`` if all of their documents, or all of the entity's, held both: the others, among them all that are common
in the corpus, cannot disclose it. Entities that stand in the same documents disclose and are disclosed alike and count as
one, so a page that lists thousands of addresses seen nowhere else does not pair each of them with each of its words.
Patterns are possessive and begin at run borders, so they are linear in the text; long texts and those with many spans are
rewritten in pieces of ``PIECE`` code points, each with the spans inside it, so that neither their length nor the number of
spans is squared.

Defined cases: a null or empty text has no spans and stays as it is; repeated rows get equal results. Overlapping spans
of different kinds are all reported; in sanitised text the earlier span's mark covers what they share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rtdw.llm.common import free_name, stored
from rtdw.llm.spans import joined, matches, of_kind
from rtdw.operators.lookup import join_scattered, lookup

KINDS = ("email", "ip", "card", "phone", "term")
# What counts as each kind.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
GENERAL, REMOVED = "[WORD]", ""
PRIOR = 0.5
CHANCE = 0.5
TERM = r"\p{L}++"
WORDS_TYPE = "array<struct<start:bigint,end:bigint,term:string>>"
#: Code points of a text that are rewritten at a time.
PIECE = 256
#: Up to so many spans and code points a text is rewritten as a whole.
SPANS_HERE = 64
TEXT_HERE = 1 << 15


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    parts = F.split(value, r"\.")
    return F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)


def _is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def base_spans(text: Column) -> Column:
    """All spans of the four fixed kinds, by start and kind, with their value."""

    def kind(number: int, found: Column, good=None) -> Column:
        kept = F.filter(found, lambda m: good(m["value"])) if good else found
        fields = ("end", "value")
        return F.transform(
            kept, lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), *(m[f].alias(f) for f in fields))
        )

    digit_runs = text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}")
    return F.array_sort(
        F.concat(
            kind(0, matches(text, EMAIL, text.contains("@"))),
            kind(1, matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), _is_ip),
            kind(2, matches(text, CARD, digit_runs), _is_card),
            kind(3, matches(text, PHONE, text.contains("+")), _is_phone),
        )
    )


def with_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc_id, print, base, text, terms), stored: the fixed spans of every row, numbered by ``row``.

    Where there are any, ``text`` is the text and ``terms`` null; elsewhere the text is done with, and ``terms`` has its words.
    """
    found = docs.select("doc_id", F.col(text).alias("text"), base_spans(F.col(text)).alias("base"))
    has_base = F.size("base") > 0
    return stored(
        found.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.xxhash64("text").alias("print"),
            "base",
            F.when(has_base, F.col("text")).alias("text"),
            F.when(~has_base, distinct_words(F.col("text"))).alias("terms"),
        ),
        "disclosure-base",
    )


def distinct_words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def find_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, doc_id, print, base, words, terms) of every row, stored, so that texts are searched once."""
    return add_words(with_texts(docs, text))


def add_words(found: DataFrame) -> DataFrame:
    """(row, doc_id, print, base, words, terms) of :func:`with_texts`.

    ``terms`` has the distinct lower-case words outside of the fixed spans and ``words``, for texts with a fixed span, the
    places of all of them.
    """
    own = ("doc_id", "print", "base")
    with_base = found.where(F.size("base") > 0).select("row", *own, "text", F.col("base").alias("spans"))
    rest = stored(replaced(with_base, own), "disclosure-rest")
    places = F.transform(matches(F.col("text"), TERM), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lower(m["value"]).alias("term")))
    words = rest.select("row", *own, places.alias("words"), distinct_words(F.col("text")).alias("terms"))
    full = stored(words, "disclosure-places")
    none = F.array().cast(WORDS_TYPE)
    return found.where(F.size("base") == 0).select("row", "doc_id", "print", "base", none.alias("words"), "terms").unionByName(full)


def replaced(rows: DataFrame, keep: tuple[str, ...] = (), spans_here: int = SPANS_HERE, text_here: int = TEXT_HERE) -> DataFrame:
    """(row, text) and ``keep`` of rows (row, text, spans): each span replaced by its ``mark``, or blanked where spans have no mark.

    ``spans`` come in order. Where they overlap, the earlier one's mark stands for all that both cover. Short texts with few
    spans are rewritten where they are, without a shuffle; all others in pieces.
    """
    here = (F.size("spans") <= spans_here) & (F.length("text") <= text_here)
    pieces = rows.where(~here)
    whole = in_pieces(pieces.select("row", "text", "spans"))
    if keep:
        whole = pieces.select("row", *keep).join(whole, "row")
    return in_place(rows.where(here), keep).unionByName(whole)


def _marked(rows: DataFrame) -> bool:
    return "mark" in rows.schema["spans"].dataType.elementType.names


def in_place(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`replaced` by one expression for each text; its cost is the text's length times the number of its spans."""
    return rows.select("row", *keep, _rewritten(F.col("text"), F.col("spans"), _marked(rows)).alias("text"))


def in_pieces(rows: DataFrame) -> DataFrame:
    """:func:`replaced` by pieces of ``PIECE`` code points, which are dealt out and put together again."""
    marked = _marked(rows)
    upto = F.max("end").over(Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    spans = rows.select("row", F.posexplode("spans").alias("place", "s")).select(
        "row", "place", "s.start", "s.end", (F.col("s.mark") if marked else F.lit("")).alias("mark")
    )
    spans = spans.withColumn("upto", F.coalesce(upto, F.lit(0).cast("long"))).where("end > upto")
    first = F.greatest("start", "upto")
    spans = spans.select("row", first.alias("start"), "end", F.when(F.col("start") >= F.col("upto"), F.col("mark")).otherwise("").alias("mark"))
    size = F.lit(PIECE).cast("long")
    spans = spans.withColumn("piece", F.explode(F.sequence(F.expr(f"start div {PIECE}"), F.expr(f"(end - 1) div {PIECE}"))))
    begin = F.greatest(F.col("start") - F.col("piece") * size, F.lit(0).cast("long"))
    end = F.least(F.col("end") - F.col("piece") * size, size)
    here = F.when(F.expr(f"start div {PIECE}") == F.col("piece"), F.col("mark")).otherwise("")
    mark = here if marked else F.repeat(F.lit(" "), (end - begin).cast("int"))
    local = spans.groupBy("row", "piece").agg(
        F.array_sort(F.collect_list(F.struct(begin.alias("start"), end.alias("end"), mark.alias("mark")))).alias("spans")
    )
    pieces = rows.select("row", F.posexplode(F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))).alias("piece", "part"))
    joined_pieces = pieces.withColumn("piece", F.col("piece").cast("long")).join(local, ["row", "piece"], "left")
    part = F.when(F.col("spans").isNull(), F.col("part")).otherwise(_rewritten(F.col("part"), F.col("spans"), True))
    whole = joined_pieces.select("row", F.struct("piece", part.alias("part")).alias("p")).groupBy("row")
    return whole.agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["part"]), "").alias("text"))


def share(n_ct: Column, n_c: Column, n_t: Column, total: float) -> Column:
    """The share of an entity that a word discloses; null if all documents have the entity."""
    given = (n_ct + F.lit(PRIOR) * n_c / total) / (n_t + PRIOR)
    own = F.log2(total / n_c)
    return F.when(own > 0, F.least(F.lit(1.0) + F.log2(given) / own, F.lit(1.0)))


def by_chance(n_ct: Column, n_t: Column, q: Column, n_terms: Column | float) -> Column:
    """A bound of the number of words that would stand in ``n_ct`` of ``n_t`` documents with an entity by chance."""
    p = n_ct / n_t
    rest = F.when(p < 1, (1 - p) * F.ln((1 - p) / (1 - q))).otherwise(0.0)
    return F.when((p > q) & (q < 1), n_terms * F.exp(-n_t * (p * F.ln(p / q) + rest))).otherwise(n_terms)


def candidates(base: DataFrame, generalise: float, total: float) -> DataFrame:
    """(row, docs, n_c, q, n_terms, term, n_t): entities of each document with its words that may disclose them.

    ``docs`` stands for all entities with the same documents: their number and two digests of them.
    """
    value = lambda s: F.when(s["kind"] == 0, F.lower(s["value"])).when(s["kind"] == 1, s["value"]).otherwise(_digits(s["value"]))
    with_base = base.where(F.size("base") > 0)
    # Distinct by a shuffle: array_distinct compares all pairs of structs.
    owners = with_base.select("row", F.size("terms").alias("size"), F.explode("base").alias("s"))
    owners = owners.select("row", "size", "s.kind", value(F.col("s")).alias("entity")).distinct()
    counted = stored(base.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n_t")), "disclosure-words")
    n_terms, n_places = counted.agg(F.count("*").cast("double"), F.coalesce(F.sum("n_t"), F.lit(1)).cast("double")).first()
    digests = [F.bit_xor(F.xxhash64("row", F.lit(i))).alias(f"x{i}") for i in (1, 2)]
    entities = owners.groupBy("kind", "entity").agg(F.count("*").alias("n_c"), (F.sum("size") / n_places).alias("q"), *digests)
    entities = entities.where((F.col("q") > 0) & (by_chance(F.col("n_c"), F.col("n_c"), F.col("q"), F.lit(n_terms)) <= CHANCE))
    entities = entities.withColumn("_n", F.col("n_c"))
    owners = lookup(owners, entities, ["kind", "entity"], "c", F.col("row"), "_n").where("c.n_c is not null")
    owners = owners.select("row", F.struct("c.n_c", "c.x1", "c.x2").alias("docs"), "c.n_c", "c.q").distinct()
    owners = owners.withColumn("n_terms", F.lit(n_terms))
    words = with_base.select("row", F.explode("terms").alias("term"))
    words = lookup(words, counted.withColumn("_n", F.col("n_t")), ["term"], "t", F.col("row"), "_n").select("row", "term", "t.n_t")
    n_c, n_t = F.col("n_c"), F.col("n_t")
    return owners.join(words, "row").where(share(F.least(n_c, n_t), n_c, n_t, total) >= generalise)


def disclosing(pairs: DataFrame, generalise: float, total: float) -> DataFrame:
    """(docs, term, share) of all pairs that disclose at least ``generalise`` of the entity, and not by chance."""
    counted = pairs.groupBy("docs", "term", "n_c", "n_t", "q", "n_terms").agg(F.count("*").alias("n_ct"))
    counted = counted.where(by_chance(F.col("n_ct"), F.col("n_t"), F.col("q"), F.col("n_terms")) <= CHANCE)
    told = share(F.col("n_ct"), F.col("n_c"), F.col("n_t"), total)
    return counted.select("docs", "term", told.alias("share")).where(F.col("share") >= generalise)


def term_spans(base: DataFrame, generalise: float) -> DataFrame:
    """(row, terms): every place of the disclosing words in each text that has any, with their share."""
    total = float(max(base.count(), 2))
    pairs = stored(candidates(base, generalise, total), "disclosure-pairs")
    told = disclosing(pairs, generalise, total)
    hits = join_scattered(pairs.select("row", "docs", "term"), told, ["docs", "term"], F.col("row"))
    hits = hits.groupBy("row", "term").agg(F.max("share").alias("share"))
    words = base.where(F.size("words") > 0).select("row", F.explode("words").alias("w")).select("row", "w.term", "w.start", "w.end")
    return words.join(hits, ["row", "term"]).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(4).alias("kind"), "end", "share")).alias("marked")
    )


def all_spans(base: DataFrame, generalise: float = 0.8) -> DataFrame:
    """(row, doc_id, print, base, terms) of every row of :func:`add_words`."""
    marked = stored(term_spans(base, generalise), "disclosure-terms")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,share:double>>")
    return base.select("row", "doc_id", "print", "base").join(marked, "row", "left").withColumn("terms", F.coalesce("marked", none)).drop("marked")


def disclosure_table(docs: DataFrame, generalise: float = 0.8) -> DataFrame:
    """Per document: doc_id, counts of the four kinds and of words, digest of the fixed spans, and all spans."""
    spans = all_spans(find_base(docs), generalise)
    simple = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    words = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    counts = [of_kind(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(joined(simple, KINDS), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat(simple, words)), KINDS).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def _rewritten(text: Column, spans: Column, marked: bool) -> Column:
    """The text with each span replaced by its mark, or blanked; spans come in order, and overlaps are covered once."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["at"])
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        mark = F.when(s["start"] >= acc["at"], s["mark"]).otherwise("") if marked else F.repeat(F.lit(" "), (s["end"] - begin).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], F.array(gap, mark)).alias("parts"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.lit(1 << 30)))

    return F.aggregate(spans, first, step, finish)


def sanitise(docs: DataFrame, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """The documents with entities replaced by marks and disclosing words generalised or removed; same columns."""
    mark = F.array(*(F.lit(m) for m in MARKS))
    found = with_texts(docs)
    spans = all_spans(add_words(found), generalise).where(F.size("base") > 0)

    def marks(name: str, of) -> Column:
        fields = ("start", "kind", "end")
        return F.transform(name, lambda s: F.struct(*(s[f].alias(f) for f in fields), of(s).alias("mark")))

    both = F.concat(
        marks("base", lambda s: F.get(mark, s["kind"])),
        marks("terms", lambda s: F.when(s["share"] >= remove, REMOVED).otherwise(GENERAL)),
    )
    spans = spans.select("row", F.array_sort(both).alias("spans"))
    keyed = found.where(F.size("base") > 0).select("row", "doc_id", "print", "text")
    clean = replaced(stored(keyed.join(spans, "row"), "disclosure-marked"), ("doc_id", "print"))
    id_name, print_name, text_name = (free_name(docs, n) for n in ("_id_", "_print_", "_clean_"))
    clean = clean.dropDuplicates(["doc_id", "print"])
    clean = clean.select(F.col("doc_id").alias(id_name), F.col("print").alias(print_name), F.col("text").alias(text_name))
    same = (F.xxhash64("text") == F.col(print_name)) & F.col("doc_id").eqNullSafe(F.col(id_name))
    out = docs.join(clean, same, "left")
    return out.withColumn("text", F.coalesce(text_name, "text")).select(*docs.columns)
