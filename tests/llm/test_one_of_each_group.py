"""The near-dedup stage leaves one row of each group, also where rows repeat or have no id."""

import corpus_pipeline


def test_stage_leaves_one_row_of_each_group(spark):
    def words(k, n=60):
        return " ".join(f"w{k}x{j}" for j in range(n))

    near = words(1) + " end"
    rows = [(7, words(0)), (7, words(0)), (7, words(0)), (None, words(0)), (None, words(0))]
    rows += [(4, words(1)), (4, near), (3, near), (3, near), (None, words(2)), (None, words(2)), (9, words(3)), (None, None), (5, "")]
    docs = spark.createDataFrame([(*row, k) for k, row in enumerate(rows)], "doc_id long, text string, row_number int").repartition(5)
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    found = sorted(((row.doc_id, row.text) for row in out.collect()), key=repr)
    assert found == sorted([(7, words(0)), (3, near), (None, words(2)), (9, words(3)), (None, None), (5, "")], key=repr)
    assert stage(spark, docs.limit(0), "").isEmpty()
