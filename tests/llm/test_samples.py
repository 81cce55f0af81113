"""Labelled samples are bounded in rows, whatever is repeated."""

from tidemark.llm import common, quality_classifier


def test_a_repeated_id_does_not_enlarge_the_sample(spark):
    docs = spark.createDataFrame([(1, f"copy {k % 3}") for k in range(200)] + [(d, f"text {d}") for d in range(2, 400)] + [(None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 200 + [(d, d % 2) for d in range(2, 400)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = quality_classifier.labelled_sample(docs, labels, "quality", (4, 2), 1_000).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 1 in ids  # crc32('1') % 4 is 3
    assert quality_classifier.labelled_sample(docs, labels, "quality", (4, 2), 60).count() == 60


def test_one_text_is_the_same_however_rows_are_dealt(spark):
    rows = spark.createDataFrame([(k % 5, f"text {k}") for k in range(100)] + [(9, None)], "doc_id long, text string")
    one, two = (sorted(map(tuple, common.one_text(rows.repartition(n), "doc_id").collect())) for n in (1, 7))
    assert one == two and len(one) == 6 and one[-1] == (9, None)
