import pytest

from codalith.llm import toxicity

from cases import documents


@pytest.mark.parametrize("grades", [(0, 1, 2), (1, 2)])
def test_training_sees_every_grade(spark, grades):
    mark = {0: "fine", 1: "rude", 2: "vicious"}
    rows = [(k, " ".join([mark[grades[k % len(grades)]]] + [f"w{(k * 7 + i * i) % 211}" for i in range(20)])) for k in range(300)]
    labels = spark.createDataFrame([(k, grades[k % len(grades)]) for k in range(300)], "doc_id long, toxic int")
    docs = documents(spark, rows)
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r.severity for r in toxicity.score(docs, model).collect()}
    assert all(round(found[k]) == grades[k % len(grades)] for k in range(300))
