"""Rows that share an id but not their text, in the near-duplicate join."""

from tradewind.llm import neardup

A = "one two three four five six seven eight nine ten"
B = "red orange yellow green blue indigo violet black white grey"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, key string")


def test_an_id_links_its_texts_and_no_text_is_lost(spark):
    rows = [(3, A), (5, A), (5, B), (7, B), (9, "alone here"), (None, B), (11, None)]
    got = {(r.doc_id, r.component_id) for r in neardup.find(docs(spark, rows)).collect()}
    assert got == {(3, 3), (5, 3), (7, 3), (9, 9), (None, 3), (11, 11)}
    kept = [(r.doc_id, r.text) for r in neardup.drop(docs(spark, rows)).collect()]
    assert sorted(kept, key=repr) == sorted([(3, A), (5, A), (5, B), (9, "alone here"), (None, B), (11, None)], key=repr)


def test_rows_that_repeat_id_and_text_are_copies_like_others(spark):
    rows = [(4, A), (4, A), (6, A), (6, A)]
    assert {(r.doc_id, r.component_id) for r in neardup.find(docs(spark, rows)).collect()} == {(4, 4), (6, 4)}
    assert {r.doc_id for r in neardup.drop(docs(spark, rows)).collect()} == {4}
