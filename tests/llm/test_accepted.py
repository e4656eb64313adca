"""What the language stage turns away."""

import random

from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.texts import table

SF = "/root/testdata/sf0.01"
SHAPE = "doc_id long, text string, lang string"


def test_texts_in_no_learned_language_go(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    draw = random.Random(1)
    texts = {r.lang: r.text for r in docs.where(F.length("text") > 3000).collect()}
    noise = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(2000))
    strange = [noise, "Все счастливые семьи похожи друг на друга " * 5, "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności"]
    mixed = " ".join(t[:1000] for _, t in sorted(texts.items()))
    extra = [(-1 - k, t, None) for k, t in enumerate(strange)] + [(-100, mixed, None), (-101, "le la", None), (-102, "12 34", None)]
    left = {r.doc_id for r in language_id.accepted(docs.unionByName(spark.createDataFrame(extra, SHAPE))).collect()}
    assert {n for n in left if n < 0} == {-100, -101}
    assert len(left) - 2 >= 0.999 * docs.count()


def test_without_labels_every_text_with_a_letter_stays(spark):
    data = [(0, "some words", None), (1, "другие слова", None), (2, "12 34", "en"), (3, None, None), (4, "x", None)]
    docs = spark.createDataFrame(data, SHAPE)
    assert sorted(r.doc_id for r in language_id.accepted(docs).collect()) == [0, 1, 4]
