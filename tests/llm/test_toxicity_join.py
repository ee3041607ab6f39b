"""Plan of the join of texts and labels."""

from spanfeat.llm.toxicity import training_texts


def test_labels_are_not_broadcast(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(20)], "doc_id long, text string")
    known = spark.createDataFrame([(k, k % 2, 0) for k in range(20)], "doc_id long, toxic int, fold int")
    plan = training_texts(docs, known)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
