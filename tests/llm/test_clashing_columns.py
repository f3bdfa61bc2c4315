"""The pipeline's Jaccard stage on tables whose further columns have the names it uses inside."""

from __future__ import annotations

from reportwide.llm import jaccard_join


def test_one_of_each_with_clashing_columns(spark):
    text = "one two three four five six seven"
    rows = [(1, text, 10, "a", 3, 4, 5), (2, text, 20, "b", 3, 4, 5), (3, "", 30, "c", 3, 4, 5), (4, None, 40, "d", 3, 4, 5),
            (5, "quite another text of some words", 50, "e", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__th` int, `__key` string, `__n` int, `__id` int, `__rest` int")
    got = sorted(tuple(r) for r in jaccard_join.one_of_each(docs).collect())
    assert got == sorted(rows[:1] + rows[2:])
    assert jaccard_join.one_of_each(docs).columns == docs.columns
    plain = docs.select("doc_id", "text")
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(plain).collect()) == [1, 3, 4, 5]
