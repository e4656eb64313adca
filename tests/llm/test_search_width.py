"""How many results a search asks for follows from the query ids alone."""

from pyspark.sql import functions as F

from tidemark.llm import metric_search


def test_null_ids_do_not_widen_the_search(spark, monkeypatch):
    data = [(None, [float(n), 1.0]) for n in range(200)] + [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (7, [3.0, 0.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    asked, search = [], metric_search.search_trees
    monkeypatch.setattr(metric_search, "search_trees", lambda queries, trees, k, *rest: asked.append(k) or search(queries, trees, k, *rest))
    got = metric_search.top_k(frame, F.col("vec_id") == 0, k=3).collect()
    assert {*asked} == {5}  # k and the two rows of the query's id
    assert len(got) == 6 and all(r.vec_id is None for r in got)
    assert sorted({r.score for r in got}, reverse=True)[0] == 2 * 256 * 199 * 256
