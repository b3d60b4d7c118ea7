"""The fitted models on rows they did not learn from, and samples of repeated rows."""

import pytest
from pyspark.sql import functions as F

from catloom.llm import quality_model, registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, floor", [("op8_nb_svm_quality", 0.93)])
def test_quality_of_held_out_rows(spark, name, floor):
    found = registry.load()[0][name](spark, SF).where("held_out")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    right = found.join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[0] >= floor and right[1] > 50


def test_an_id_on_a_third_of_the_rows_is_one_example(spark):
    rows = [(7, "the same text again")] * 3000 + [(7, f"another text {i}") for i in range(5)] + [(i + 10, f"text {i % 50} of {i}") for i in range(3000)]
    docs = spark.createDataFrame([*rows, (None, "no id")], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(3010)] + [(7, 1), (None, 1)], "doc_id long, quality int")
    chosen, counts = quality_model.sample_ids(docs, labels, 40)
    assert len(chosen) == len(set(chosen)) == 80 and counts == {1: 1506, 0: 1500}
    again, _ = quality_model.sample_ids(docs.repartition(3), labels, 40)
    assert chosen == again
    all_of, _ = quality_model.sample_ids(docs, labels, 10**6)
    assert sum(i == 7 for i, _, _ in all_of) == 6 and len(all_of) == 3006
    assert quality_model.train(docs, labels, 40).weights.any()
