"""A dictionary that is joined: texts are packed once, in blocks that ask for their pairs of characters."""

import os

import pyarrow as pa
import pytest

from rtdw.operators import segment

HAN = [chr(0x4E00 + 37 * i) for i in range(26)]


def words_by(frame, max_words, texts, mode="longest"):
    found = segment.segment_words(texts, "k", "t", frame, max_words=max_words, mode=mode)
    return sorted(map(tuple, found.collect()), key=str)


def prose(i, n):
    """Words of a small vocabulary without blanks between them, and commas."""
    seed, out = i * 7919 + 1, []
    for _ in range(n):
        seed = (seed * 1103515245 + 12345) % 2**31
        word = seed // 7 % 500
        out.append("".join(HAN[(word * (j + 3) + j * j) % 26] for j in range(2 + word % 6)) + ("，" if seed // 11 % 4 == 0 else ""))
    return "".join(out)


def test_texts_are_stored_once_and_packed(spark, tmp_path, monkeypatch):
    """Before: each run twice, beside 32 bytes of digest."""
    texts = {i: prose(i, 400) for i in range(200)}
    dictionary = spark.createDataFrame([(HAN[i] + HAN[j],) for i in range(26) for j in range(i)], "word string")
    monkeypatch.setattr(segment, "run_dir", lambda _spark, name: str(tmp_path / name))
    frame = spark.createDataFrame(list(texts.items()), "k int, t string").coalesce(2)
    found = segment.segment_words(frame, "k", "t", dictionary, max_words=0)
    assert found.count() > 200
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(tmp_path) for f in files)
    assert size < sum(len(t.encode()) for t in texts.values()) / 3
    # Packed text and words of blocks travel by block; nothing is dealt by key or by run to be made different or joined again.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Repartition") == 1 and "Distinct" not in plan and "run_id" not in plan


ODD = {
    1: "⼀一丁⼀丁",  # radicals are of the Han script and no letters
    2: "々〇一丁〡",  # marks and numerals of the script
    3: "\U00020000\U00020001一\U00020000",
    4: "ＡＢｃ　一丁ａ1２٠ 一丁",
    5: "é一丁́一 \U0001f600 Straße İ ǅ",
    6: "",
    7: None,
    8: " \t\n，。",
    9: "abc\tabc\nabc一丁\nabc",
    10: "一",
}
ODD_WORDS = ["一丁", "一丁一", "\U00020000\U00020001", "々〇", "⼀一"]


@pytest.mark.parametrize("mode", segment.MODES)
def test_odd_characters_are_cut_alike_by_set_and_by_join(spark, mode):
    texts = spark.createDataFrame(list(ODD.items()), "k int, t string")
    words = spark.createDataFrame([(w,) for w in ODD_WORDS], "word string")
    assert words_by(words, 0, texts, mode) == words_by(words, 100, texts, mode)


def test_keys_keep_their_values_and_repeated_keys_are_one_text(spark):
    words = spark.createDataFrame([("一丁",)], "word string")
    for kind, keys in (("long", [2**60 + 1, None, 2**60 + 2]), ("string", ["a", None, ""]), ("decimal(20,3)", None)):
        keys = keys or [__import__("decimal").Decimal("12345678901234567.125"), None]
        rows = [(key, "一丁 x") for key in keys] + [(keys[0], "一丁, y")]
        texts = spark.createDataFrame(rows, f"k {kind}, t string")
        expected = [(key, word) for key in keys for word in ("一丁", "x")] + [(keys[0], "y")]
        assert words_by(words, 0, texts) == sorted(expected, key=str)


def test_no_words_and_no_texts(spark):
    none = spark.createDataFrame([], "word string")
    texts = spark.createDataFrame([(1, "一丁 a")], "k int, t string")
    assert words_by(none, 0, texts) == [(1, "a"), (1, "一"), (1, "丁")]
    assert words_by(spark.createDataFrame([("一丁",)], "word string"), 0, texts.limit(0)) == []


def test_the_expression_cuts_as_the_set():
    for number in range(300):
        letters = HAN[: 2 + number % 3]
        words = sorted({"".join(letters[(number * (j + 1) + i * j + i) % len(letters)] for j in range(2 + (i * number) % 5)) for i in range(1 + number % 9)})
        runs = ["".join(letters[(i * i * (number + 1) + i // 3 + k) % len(letters)] for i in range(1 + number % 30)) for k in range(3)]
        cut = segment._text_cutter(words, "longest")
        assert set(cut(" ".join(runs))) == set(segment._word_lister(segment._run_cutter(words, "longest"))(runs))


def test_long_texts_are_taken_in_parts(monkeypatch):
    text = " ".join(prose(i, 20).replace("，", "") for i in range(30))
    words = sorted({text[i : i + 2 + i % 3] for i in range(0, 900, 3) if " " not in text[i : i + 2 + i % 3]})
    whole, pairs = segment._text_cutter(words, "longest")(text), segment._Pairs()
    pairs.add(text)
    taken = sorted(pairs.taken())
    for size in (1, 7, 64):
        monkeypatch.setattr(segment, "PIECE", size)
        assert segment._text_cutter(words, "longest")(text) == whole
        pairs.add(text)
        assert sorted(pairs.taken()) == taken


def test_many_leading_characters_take_the_set(monkeypatch):
    monkeypatch.setattr(segment, "_expression", None)
    words = [chr(0x4E00 + i) + HAN[i % 26] for i in range(segment.BRANCHES + 1)]
    assert segment._text_cutter(words, "longest")("一" + HAN[0] + HAN[1])[0] == "一" + HAN[0]
    assert segment._text_cutter(["一" * (segment.DEPTH + 1)], "longest")("一" * (segment.DEPTH + 2)) == ["一" * (segment.DEPTH + 1), "一"]


@pytest.mark.parametrize("marked", [2, 5, 100])
def test_blocks_and_pieces_hold_all_texts_and_pairs(monkeypatch, marked):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 3)

    for name, value in (("TaskContext", Task), ("MARKED", marked), ("BLOCK", 300), ("PIECE", 70), ("ASKED", 7), ("PIECES", 2)):
        monkeypatch.setattr(segment, name, value)
    texts = [(i, (prose(i, 1 + i * 13 % 40) if i % 7 else "").replace("，", " "), "a b a" if i % 3 else " ") for i in range(60)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("key", "runs", "others"), row, strict=True)) for row in texts[at : at + 9]]) for at in range(0, 60, 9)]
    rows = [row for batch in segment._packer(iter(batches)) for row in batch.to_pylist()]
    seen, runs_of, asked = {}, {}, {}
    for row in rows:
        assert row["block"] >> 32 == 3
        if row["packed"] is None:
            assert row["keys"] == [] and len(row["pairs"]) <= 7
            asked.setdefault(row["block"], []).extend(row["pairs"])
            continue
        lines = segment._unpacked(row["packed"]).split("\n")
        for key, line in zip(row["keys"], lines, strict=True):
            runs, others = line.split("\t")
            seen[key] = (runs.split(), others.split())
            runs_of.setdefault(row["block"], []).extend(runs.split())
    assert seen == {k: (list(dict.fromkeys(r.split())), list(dict.fromkeys(o.split()))) for k, r, o in texts if r.split() or o.split()}
    assert len(runs_of) > 5
    for block, runs in runs_of.items():
        assert sorted(asked.get(block, [])) == sorted({run[i : i + 2] for run in runs for i in range(len(run) - 1)})
