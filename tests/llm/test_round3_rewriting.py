"""Short texts are rewritten where they are, to the same texts as in pieces."""

import random

import pytest

from rtdw.llm import disclosure


@pytest.mark.parametrize("marked", [True, False])
def test_in_place_equals_in_pieces(spark, monkeypatch, marked):
    """Marks or blanks that overlap, lie in one another, touch or end the text; columns that are kept stay with their row."""
    rng, rows = random.Random(6), []
    for row in range(40):
        text = "".join(rng.choice("ab é\n😀") for _ in range(rng.choice([1, 7, 8, 60])))
        spans = sorted({(a, k, min(len(text), a + rng.choice([1, 2, 9, 30]))) for k in range(3) for a in [rng.randrange(len(text))]})
        rows.append((row, f"d{row}", text, [(a, k, b, f"<{k}>") if marked else (a, k, b) for a, k, b in spans]))
    monkeypatch.setattr(disclosure, "PIECE", 8)
    fields = "start:long,kind:int,end:long" + (",mark:string" if marked else "")
    df = spark.createDataFrame(rows, f"row long, doc_id string, text string, spans array<struct<{fields}>>")
    here, apart, mixed = (
        {(r.row, r.doc_id, r.text) for r in disclosure.replaced(df, ("doc_id",), *limits).collect()} for limits in ((64, 1 << 15), (-1, 0), (2, 8))
    )
    assert here == apart == mixed and len(here) == 40
    if not marked:
        assert all(len(text) == len(rows[row][2]) for row, _, text in here)


def test_short_texts_are_not_shuffled(spark):
    """One window and two groupings of every text's pieces held pages of each of them in an executor's memory."""
    df = spark.createDataFrame([(1, "a b", [(0, 1)])], "row long, text string, spans array<struct<start:long,end:long>>")
    plan = disclosure.in_place(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and disclosure.in_place(df).first().text == "  b"
