import pandas as pd
import pytest
from pyspark.sql import functions as F

from rtdw.operators import keywords, segment


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "seq bigint, page map<string,string>, et timestamp_ntz").withColumn(
        "et", F.col("et").cast("timestamp")
    )


def test_search_filter(spark):
    good = {"last_page_id": "search", "item_type": "keyword", "item": "x"}
    rows = [
        good, {**good, "last_page_id": "home"}, {**good, "last_page_id": "cart"}, {**good, "item_type": "sku"},
        {**good, "item": None}, {"item_type": "keyword", "item": "x"}, None,
    ]
    frame = spark.createDataFrame(list(enumerate(rows)), "seq bigint, page map<string,string>")
    assert [r.seq for r in keywords.search_phrases(frame).collect()] == [0, 1]


def test_split_words(spark):
    frame = spark.createDataFrame([(1, "macbook M2 15寸 M2"), (2, None), (3, "!!")], "seq bigint, kw string")
    assert sorted(r.keyword for r in keywords.split_words(frame).collect()) == ["15寸", "m2", "macbook"]


def test_kw_split_in_sql(spark):
    keywords.register_kw_split(spark)
    spark.createDataFrame([("macbook M2 Ｍ2 it's",), (None,)], "kw string").createOrReplaceTempView("phrases")
    for call in (", LATERAL kw_split(kw)", "JOIN LATERAL kw_split(kw) ON true"):
        rows = spark.sql(f"SELECT keyword FROM phrases {call}").collect()
        assert sorted(r.keyword for r in rows) == ["it", "m2", "macbook", "s"]


def test_window_bounds(spark):
    frame = spark.sql(
        "SELECT 'w' AS keyword, t AS et FROM VALUES (timestamp'2023-07-11 14:14:14.999'), "
        "(timestamp'2023-07-11 14:14:15'), (timestamp'2023-07-11 14:14:19.999') AS v(t)"
    )
    rows = keywords.window_counts(frame).orderBy("stt").collect()
    assert [tuple(r) for r in rows] == [
        ("2023-07-11 14:14:10", "2023-07-11 14:14:15", "20230711", "w", 1),
        ("2023-07-11 14:14:15", "2023-07-11 14:14:20", "20230711", "w", 2),
    ]


DICTIONARY = ["华为", "手机", "白色", "白色手机", "笔记本", "笔记本电脑", "电脑包"]
TEXTS = {
    1: "华为手机白色手机",
    2: "macbook M2 15寸 笔记本电脑",
    3: "笔记本电脑包",
    4: "电",
    5: None,
    6: "，。!",
    7: "华为手机白色手机abc手机",
}
CUT = {
    1: {"华为", "手机", "白色手机"},
    2: {"macbook", "m2", "15", "寸", "笔记本电脑"},
    3: {"笔记本电脑", "包"},
    4: {"电"},
    7: {"华为", "手机", "白色手机", "abc"},
}


@pytest.mark.parametrize("max_words", [100, 0])
def test_segmentation(spark, max_words):
    texts = spark.createDataFrame(list(TEXTS.items()), "id int, text string")
    words = spark.createDataFrame([(w,) for w in DICTIONARY], "word string")
    rows = segment.segment_words(texts, "id", "text", words, max_words=max_words).collect()
    found = {}
    for row in rows:
        assert row.keyword not in found.setdefault(row.id, set())
        found[row.id].add(row.keyword)
    assert found == CUT


def test_segmentation_against_brute_force(spark):
    letters = "一二三四"
    words = sorted({letters[i % 4] + letters[i * 7 // 4 % 4] + letters[i * 5 % 3] * (i % 3) for i in range(12)})
    texts = {i: "".join(letters[(i * 31 + j * j * 7 + j) % 4] for j in range(3 + i)) for i in range(40)}

    def brute(text):
        out, at = set(), 0
        while at < len(text):
            fits = [w for w in words if text.startswith(w, at)]
            word = max(fits, key=len) if fits else text[at]
            out.add(word)
            at += len(word)
        return out

    frame = spark.createDataFrame(list(texts.items()), "id int, text string")
    dictionary = spark.createDataFrame([(w,) for w in words], "word string")
    for max_words in (100, 0):
        found = {i: set() for i in texts}
        for row in segment.segment_words(frame, "id", "text", dictionary, max_words=max_words).collect():
            found[row.id].add(row.keyword)
        assert found == {i: brute(t) for i, t in texts.items()}


def test_long_runs_are_cut_alike_by_set_and_by_join(spark):
    letters = [chr(0x4E00 + i) for i in range(5)]
    words = ["".join(letters[(i * j) % 5] for j in range(1, 2 + i % 4)) for i in range(1, 40)]
    dictionary = spark.createDataFrame([(w,) for w in words if len(w) > 1], "word string")
    runs = [(n, "".join(letters[(i * i + i // 7) % 5] for i in range(n))) for n in (1, 1_000, 2_003, segment.ASKED + 1)]
    texts = spark.createDataFrame(runs, "k int, t string")
    by_set, by_join = (segment.segment_words(texts, "k", "t", dictionary, max_words=m) for m in (1000, 0))
    assert sorted(map(tuple, by_set.collect())) == sorted(map(tuple, by_join.collect()))


def _paths(run, words):
    """All ways through a run."""
    if not run:
        return [[]]
    return [[run[:n], *rest] for n in range(1, len(run) + 1) if n == 1 or run[:n] in words for rest in _paths(run[n:], words)]


def test_smart_mode_takes_fewest_then_longest_words():
    letters = "\u4e2d\u56fd\u4eba"
    for number in range(400):
        run = "".join(letters[(number * (i + 3) + number // (i + 1)) % 3] for i in range(1 + number % 9))
        words = sorted({run[i : i + 2 + (number + i) % 3] for i in range(len(run)) if (number >> i) & 1 and len(run[i : i + 2]) == 2})
        best = min(_paths(run, words), key=lambda path: (len(path), [-len(word) for word in path]))
        assert segment.cut_run(run, segment.hits_in(run, segment.automaton(words)), "smart") == best


def test_smart_mode_solves_an_overlap(spark):
    texts = spark.createDataFrame([(1, "\u4e2d\u56fd\u4eba\u6c11\u5927")], "id int, text string")
    words = spark.createDataFrame([("\u4e2d\u56fd\u4eba",), ("\u4e2d\u56fd",), ("\u4eba\u6c11\u5927",)], "word string")
    for max_words in (100, 0):
        cut = {m: {r.keyword for r in segment.segment_words(texts, "id", "text", words, max_words=max_words, mode=m).collect()} for m in segment.MODES}
        assert cut["longest"] == {"\u4e2d\u56fd\u4eba", "\u6c11", "\u5927"}
        assert cut["smart"] == {"\u4e2d\u56fd", "\u4eba\u6c11\u5927"}


def test_a_joined_dictionary_cuts_the_texts_into_runs_once(spark):
    """The plan reads stored runs: no split of texts in it, and no row for each place of a run."""
    texts = spark.createDataFrame([(1, "中国" * 300_000), (2, "中国人, ab"), (3, None)], "id int, text string")
    words = spark.createDataFrame([("中国",), ("中国人",)], "word string")
    found = segment.segment_words(texts, "id", "text", words, max_words=0)
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [(1, "中国"), (2, "ab"), (2, "中国人")]


def test_words_of_a_batch_are_shared_and_handed_on_in_parts():
    runs = ["".join(chr(0x4E00 + (i * k) % 7) for i in range(50)) for k in range(1, 40)]
    for mode in segment.MODES:
        words_of = segment._word_lister(segment._run_cutter([r[2:4] for r in runs], mode))
        lists = [words_of([run]) for run in runs]
        every = [word for words in lists for word in words]
        assert len({id(word) for word in every}) == len(set(every)) < len(every)
    texts = pd.Series(["ab", None, "", "abcdef", "a", "b"])
    parts = list(segment._slices(texts, 3))
    assert [len(p) for p in parts] == [4, 2] and pd.concat(parts).equals(texts)
    assert [len(p) for p in segment._slices(pd.Series([], dtype="object"), 3)] == [0]
