from intake_spark.llm import ann
from pyspark.sql import functions as F


def test_odd_smallest_id_filters_no_others(spark):
    rows = [(0, [1.0, 2.0, 3.0])] + [(i, [float(i), 1.0]) for i in range(1, 8)] + [(8, [1.0] * 4)]
    got = ann.search(ann.index(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")), F.col("vec_id") == 1, k=10).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, float(i - 1)) for i in range(2, 8)]
    even = [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0]), (3, [1.0, 2.0, 4.0]), (4, [1.0, 3.0])]
    assert {r.vec_id for r in ann.index(spark.createDataFrame(even, "vec_id bigint, embedding array<float>")).collect()} == {2, 3}
