"""Divergence, vector codes and repeats against brute force, with the awkward cases."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rtdw.llm import bpe, common, decision_list, disclosure, divergence, induced, langid, packing, repeats, simhash, toxicity, vector_codes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, anchor string, rank int, t1 string"
PAIR, TERM = "pair", "term"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, None, "x", "y", 1, "z")[:9] for r in rows], DOCS)


# Divergence


def plain_divergence(rows, top=200, least=3):
    """Part, ranks and values from the definition, with Python integers."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in mine for t in set(d[2]))
        kept = sorted((t for t, n in seen.items() if n >= least), key=str.encode)
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2]) for s in {d[1] for d in mine}}
        counts[None] = sum((Counter(d[2]) for d in mine), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in counts.items()}

        def p(s, t):
            return 1 + 10**9 * (counts[s][t] + 1) // (total[s] + len(kept))

        def f(a, b):
            return (a - b) ** 2 // b

        for s in counts.keys() - {None}:
            pairs = [(sum(f(p(s, t), p(o, t)) for t in kept), o) for o in counts.keys() - {None, s}]
            terms = [(f(p(s, t), p(None, t)), t) for t in kept if counts[s][t] and p(s, t) > p(None, t)]
            for part, found, last in ((PAIR, pairs, None), (TERM, terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(found[:last], 1)]
    return sorted(out)


def test_divergence(spark):
    rng = np.random.default_rng(3)
    words = ["a", "B", "b", "é", "É", "zz", "日本", "x1y", "🎉", "k"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 150))), ["en", "de", None][i % 3], ["s", "t", "é", None][int(rng.integers(0, 4))]) for i in range(240)]
    rows += [rows[0], rows[0], (None, None, None, None), (1, "", "xx", "s"), (2, "Ab;ab_AB", "yy", "s"), (3, "ab", "yy", "t"), (4, None, "yy", "u")]
    got = sorted(tuple(r) for r in divergence.divergence_table(docs_of(spark, rows)).collect())
    assert got == plain_divergence(rows)
    assert any(r[2] == TERM and r[5] == 200 for r in got)
    assert divergence.divergence_table(docs_of(spark, [])).count() == 0


# Vector codes


@given(st.integers(1, 4), st.integers(1, 40), st.integers(1, 30), st.integers(1, 6), st.integers(0, 2**31))
@settings(max_examples=80, deadline=None)
def test_equal_average_search(dim, entries, rows, spread, seed):
    rng = np.random.default_rng(seed)
    book, data = rng.integers(-spread, spread + 1, (entries, dim)), rng.integers(-spread, spread + 1, (rows, dim))
    code, best = vector_codes.Codebook(book).nearest(data)
    every = ((data[:, None, :] - book[None]) ** 2).sum(2)
    assert code.tolist() == every.argmin(1).tolist() and best.tolist() == every.min(1).tolist()


def plain_codes(rows):
    kept = [(v, label, [int(np.floor(1024 * np.float64(x))) for x in e]) for v, label, e in rows if e and all(x is not None and np.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    data = np.array([r[2] for r in kept])
    parts = np.split(data, 4, axis=1)
    books = [p[:256].copy() for p in parts]
    for turn in range(5):
        every = [((p[:, None, :] - b[None]) ** 2).sum(2) for p, b in zip(parts, books, strict=True)]
        code, error = np.stack([e.argmin(1) for e in every], 1), sum(e.min(1) for e in every)
        if turn < 4:
            for p, b, c in zip(parts, books, code.T, strict=True):
                for k in set(c.tolist()):
                    b[k] = p[c == k].sum(0) // (c == k).sum()
    whole = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel()).encode()).hexdigest()
    by_label = Counter()
    for (_, label, _), e in zip(kept, error, strict=True):
        by_label[label] += int(e)
    return [(v, bytes(c.tolist()).hex(), int(e), by_label[label], whole) for (v, label, _), c, e in zip(kept, code, error, strict=True)]


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), None if i % 7 == 0 else int(i % 3), [float(np.float32(x)) for x in rng.normal(size=8)]) for i in rng.permutation(400)]
    rows += [rows[0], (2**60 + 1, 1, rows[1][2]), (None, 1, rows[2][2]), (7, None, None), (8, 2, [1.0, None] * 4), (9, 2, [float("nan")] * 8), (10, 2, [float("inf")] * 8), (11, 2, [])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<float>, code string")
    got = [tuple(r) for r in vector_codes.codes_table(table).collect()]
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted(got, key=key) == sorted(plain_codes(rows), key=key)
    assert vector_codes.codes_table(table.limit(0)).count() == 0
    few = spark.createDataFrame([(1, None, [0.5, 1.0, 1e30, -1e30]), (1, None, [0.5, 1.0, 2.0, 3.0]), (2, 1, [1.0, 2.0])], "vec_id long, label int, embedding array<float>")
    assert [r.error for r in vector_codes.codes_table(few).collect()] == [0, 0]
    assert vector_codes.codes_table(few.where("vec_id = 2")).count() == 0


# Suffix sorting


def plain_suffixes(text, cap):
    order = sorted(range(len(text) + 1), key=lambda i: text[i:])

    def common(a, b):
        k = 0
        while k < cap and a + k < len(text) and b + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        return k

    return order, [0] + [common(a, b) for a, b in zip(order, order[1:], strict=False)]


texts = st.builds(
    lambda unit, times, run, tail: (unit * times + [2] * run + tail)[:300],
    st.lists(st.integers(1, 4), max_size=40), st.integers(1, 8), st.integers(0, 30), st.lists(st.integers(1, 250), max_size=40),
)


@pytest.mark.parametrize("block, band, dense, budget", [(1 << 16, 1 << 13, 512, 1 << 26), (7, 5, 1, 1 << 26), (50, 20, 1, 64), (3, 2, 512, 64)])
def test_suffix_array(monkeypatch, block, band, dense, budget):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "RANGE", band)
    monkeypatch.setattr(induced, "DENSE", dense)

    @given(texts, st.sampled_from([3, 20, 1000]))
    @settings(max_examples=60, deadline=None)
    def check(text, cap):
        symbols = np.array([*text, 0], np.uint16)
        level = induced.Level(symbols, 258, np.ones(258, np.int64), np.zeros(258, np.int64), None, cap, budget)
        order, common = induced._sort(level)
        assert (order.tolist(), common.tolist()) == plain_suffixes(text, cap)

    check()


# Repeats


@given(st.binary(max_size=300), st.integers(1, 40))
@settings(max_examples=60, deadline=None)
def test_rolling_hash_depends_on_its_bytes(data, width):
    hashes = repeats.rolling(np.frombuffer(data, np.uint8), width).tolist()
    assert len(hashes) == max(0, len(data) - width + 1)
    strings = [data[i : i + width] for i in range(len(hashes))]
    assert all((a == b) == (x == y) for x, a in zip(hashes, strings, strict=True) for y, b in zip(hashes, strings, strict=True))


def plain_repeats(rows, size):
    seen, out = Counter(), []
    data = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, text in data:
        seen.update(text[i : i + size] for i in range(len(text) - size + 1))
    for doc_id, text in data:
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if seen[text[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot, shard, budget, piece", [(1000, 4 << 20, 1 << 26, 1 << 20), (2, 700, 4096, 64)])
def test_repeats(spark, monkeypatch, hot, shard, budget, piece):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = np.random.default_rng(9)
    noise = ["".join(rng.choice(list("abcdeé 🎉\x00\n"), 90)) for _ in range(60)]
    passage = "this passage stands in many texts, é, " * 2
    rows = [(i, n + (passage if i % 2 else "") + noise[(i * 7) % 50][:45], "en", "s") for i, n in enumerate(noise)]
    rows += [rows[3], (100, rows[4][1], None, None), (None, None, None, None), (101, "", "en", "s"), (102, "x" * 500, "en", "s"), (103, "ab" * 300, "en", "s"), (104, "short", "", "")]
    rows += [(200 + i, noise[0][:i] + "#" + noise[0][i:], "en", "s") for i in range(0, 80, 4)]
    got = repeats.repeats_table(docs_of(spark, rows), 40, gram=8, shard=shard, budget=budget, piece_bytes=piece)
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(plain_repeats(rows, 40), key=key)
    assert repeats.repeats_table(docs_of(spark, [])).count() == 0
    spans = {r.t1: r for r in repeats.repeats(repeats.texts(docs_of(spark, rows)), 40, gram=8).collect()}
    assert any(len(r.kept) for r in spans.values()) and all(s.begin < s.end for r in spans.values() for s in r.spans)


def test_packing_keeps_large_ids_beside_nulls(spark):
    ids = [2**60 + 1, None, 7, -(2**62) - 1]
    docs = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string").coalesce(1)
    pieces = packing.pack(docs, bpe.Vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))).collect()
    assert {p.doc_id for p in pieces} == set(ids)


def test_rewriting_in_pieces_equals_plain_python(spark, monkeypatch):
    """Marks that overlap, touch, span several pieces, or end the text; astral letters count as one."""
    rng, rows = random.Random(4), []
    for row in range(40):
        text = "".join(rng.choice("ab é\n😀") for _ in range(rng.choice([1, 7, 8, 60])))
        spans = sorted({(a, k, min(len(text), a + rng.choice([1, 2, 9, 30]))) for k in range(3) for a in [rng.randrange(len(text))]})
        rows.append((row, text, [(a, k, b, f"<{k}>") for a, k, b in spans]))
    monkeypatch.setattr(disclosure, "PIECE", 8)
    df = spark.createDataFrame(rows, "row long, text string, spans array<struct<start:long,kind:int,end:long,mark:string>>")
    got = {r.row: r.text for r in disclosure.replaced(df).collect()}
    for row, text, spans in rows:
        at, out = 0, []
        for a, _, b, mark in spans:
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        assert got[row] == "".join(out) + text[at:]


def test_a_text_of_very_many_addresses(spark):
    """100,000 addresses in one text: found, blanked and replaced in time that grows with the text."""
    text = " ".join(f"u{i}@firm.com" for i in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id long, text string")
    start = time.monotonic()
    out = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert out == {1: " ".join(["[EMAIL]"] * 100_000), 2: "nothing here"}
    assert time.monotonic() - start < 120


def test_stages_leave_any_column_alone(spark, tmp_path):
    """Columns that are named like the stages' own, in either case, come out as they went in."""
    names = ["_spans_", "_id_", "_print_", "_KEY_", "_toxicity_", "_quality_stats_", "_clean_"]
    text = "a plain text of many different words " + " ".join(f"w{i}" for i in range(80)) + " a@b.co"
    docs = spark.createDataFrame([(1, text, *range(7)), (2, text + " other end", *range(7))], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for out in (disclosure.sanitise(docs), simhash.simhash_filter(docs), toxicity.toxicity_filter(docs, labels), decision_list.quality_filter(docs, labels)):
        assert out.columns == docs.columns
        for row in out.collect():
            assert row[2:] == tuple(range(7))


def test_scoring_reads_a_sentence_as_training_does():
    """A feature that several words of a sentence have counts once."""
    model = toxicity.Model({"idi*": 2.0, "fool": 1.5})
    z = 2.0 + 1.5
    expected = float(toxicity.sentence_probability(np.float64(z)))
    for text in ("idiot idiots idiotic fool", "idiot fool", "idiot, (idiots) idiotic-fool."):
        assert model.score(text, {})[0] == pytest.approx(expected)


def test_long_documents_are_learnt_from(spark):
    """Toxic words that stand only in long texts get a weight; rows that share an id count once."""
    calm = "a quiet day in the garden. " * 600
    rows = [(i, calm + ("you rotten scoundrel. " if i % 2 else "") + f"end {i}") for i in range(160)] + [(0, calm)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(160)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.score("you rotten scoundrel", {})[0] > 0.5 > model.score(calm, {})[0]
    assert common.labelled_sample(docs, labels, "toxic", 50, train_only=False).count() == 50


def test_language_calibration_takes_every_learning_text(spark):
    """Temperature and limits of 6,000 texts against plain numpy over all of them (a sample had fewer than 4,000)."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(6000):
        lang = "ab"[i % 2]
        letters = "abcdefgh" if lang == "a" else "efghijkl"
        rows.append((i, "".join(rng.choice(list(letters), 30 + i % 40)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    learning = docs.where(langid.fold(F.col("doc_id")) != 2)
    found = langid.entropies(learning, model).toPandas()
    entropy = np.stack(found["sums"]) / found["n_grams"].to_numpy()[:, None]
    truth = np.array([model.languages.index(x) for x in found["lang"]])
    assert len(found) > 4000
    likelihoods = []
    for t in langid.TEMPERATURES:
        z = -entropy * t
        z -= z.max(1, keepdims=True)
        likelihoods.append((z[np.arange(len(z)), truth] - np.log(np.exp(z).sum(1))).sum())
    assert model.temperature == langid.TEMPERATURES[int(np.argmax(likelihoods))]
    for i in range(2):
        own = np.sort(entropy[truth == i, i])
        assert model.limits[i] == pytest.approx(own[int(np.ceil(len(own) * (1 - langid.REJECT))) - 1], rel=1e-12)


def test_range_minima_by_level():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 100, 5000):
        values = rng.integers(0, 1000, n)
        first = rng.integers(0, n, 400)
        last = np.minimum(n - 1, first + rng.integers(0, n, 400) // rng.integers(1, 50, 400))
        found = induced.range_min(values, first, last)
        assert found.tolist() == [values[a : b + 1].min() for a, b in zip(first, last, strict=True)]
    assert not len(induced.range_min(values, first[:0], last[:0]))
