import pytest

from modtally.operators.narrow import rows_with_ids


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])
def test_the_bit_set_keeps_the_result_exact(spark, bits):
    rows = spark.range(5000).selectExpr("cast(id % 1700 as string) AS id", "id AS n")
    ids = spark.range(0, 3000, 7).selectExpr("cast(id as string) AS id")
    key = lambda df: sorted(r.n for r in df.collect())
    expected = [n for n in range(5000) if (n % 1700) % 7 == 0]
    assert key(rows_with_ids(rows, ids)) == expected
    filtered = rows_with_ids(rows, ids, filter_bits=bits)
    assert key(filtered) == expected
    assert filtered.columns == rows.columns


def test_one_hot_id(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) AS id", "id AS n")
    ids = spark.createDataFrame([("hot",), ("7",)], "id string")
    assert rows_with_ids(rows, ids, filter_bits=1 << 10).count() == 1001
