"""Packed weights of the quality ratio."""

from pyspark.sql import functions as F

from lifeloom.llm import quality as q


def test_sums_of_packed_weights_are_sums_of_both(spark):
    fine = [-90_000, 70_001, 0, -1, 90_000, 5]
    coarse = [120_000, -120_000, -1, 0, 3, -7]
    total = sum(f * q.SPAN + c for f, c in zip(fine, coarse, strict=True))
    row = spark.range(1).select(F.lit(total).alias("t")).select(q.fine_part(F.col("t")), q.coarse_part(F.col("t"))).first()
    assert tuple(row) == (sum(fine), sum(coarse))


def test_every_fine_class_has_the_weight_of_its_coarse_class(spark):
    n = 4 * q.FINER
    fine = spark.createDataFrame([(0, 5), (n - 1, -6)], "bucket long, weight long")
    coarse = spark.createDataFrame([(1, -9), (3, 8)], "bucket long, weight long")
    got = {r[0]: (r[1], r[2]) for r in q.packed_weights(coarse, fine, 4).select(
        "bucket", q.fine_part(F.col("weight")), q.coarse_part(F.col("weight"))).collect()}
    assert got == {b: ({0: 5, n - 1: -6}.get(b, 0), {1: -9, 3: 8}.get(b % 4, 0)) for b in range(n)}
