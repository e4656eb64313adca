"""One kept row for every group of near-duplicates, whatever the ids."""

import pytest

from tidemark.llm import near_dedup

SHAPE = "doc_id long, text string, n long"
FOX = "the quick brown fox jumps over the lazy dog again"
SEA = "nine small ships sailed out of the old harbour today"
SUN = "every morning the sun comes up behind those tall hills"


@pytest.mark.parametrize("ids", [(None, None, None), (7, 7, 7), (7, None, None)])
def test_groups_that_share_an_id_each_keep_a_row(spark, ids):
    data = [(doc_id, text, 10 * k + copy) for k, (doc_id, text) in enumerate(zip(ids, (FOX, SEA, SUN))) for copy in range(2)]
    docs = spark.createDataFrame([*data, (1, "a b c", 90), (9, FOX + " x", 91)], SHAPE).repartition(3)
    kept = [r["class"] for r in near_dedup.links(docs).where("kept").collect()]
    assert len(kept) == len({*kept}) == 4
    left = near_dedup.keep_one(docs)
    assert left.columns == docs.columns
    texts = [r.text for r in left.collect()]
    # FOX and its extended copy (6 of 7 shingles shared) are one group; the smaller id stands for it.
    first = FOX if ids[0] == 7 else FOX + " x"
    assert sorted(texts) == sorted([first, SEA, SUN, "a b c"])


def test_rows_without_id_are_not_dealt_by_id(spark):
    docs = spark.createDataFrame([(None, f"{n} words that no other text of this table has {n}", n) for n in range(300)], SHAPE)
    assert near_dedup.keep_one(docs.unionByName(docs)).count() == 300
    assert near_dedup.links(docs.unionByName(docs)).where("kept").count() == 300
