import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.json import as_variant, variant_field
from tidemark.operators.unnest import promote_variant, unnest_variant
from tidemark.plans.record_queries import promote_variant as promote_query, unnest_variant_lines

ODD = [
    (1, '{"a": 5, "o": {"x": "7"}, "l": [{"id": 1, "price": "2.50"}, {"id": "2"}, {}, null]}'),
    (2, '{"a": "no number", "o": [], "l": {}}'), (3, "not json"), (4, None), (5, ""), (6, "[]"),
    (7, '{"a": null, "a.b": 1, "l": []}'), (8, '{"a": 1, "a": 2}'), (1, '{"a": 5}'), (9, '{"a": 99999999999}'),
]


@pytest.fixture(scope="module")
def stored_variants(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("variant") / "t")
    rows = spark.createDataFrame(ODD, "id long, _raw string").withColumn("_raw", as_variant(F.col("_raw")))
    rows.write.parquet(folder)
    return spark.read.parquet(folder)


def test_promote(stored_variants):
    rows = promote_variant(promote_variant(stored_variants, "a", "int"), "o.x", "bigint", "x")
    got = sorted(((r.id, r.a, r.x) for r in rows.collect()), key=repr)
    assert got == sorted([
        (1, 5, 7), (2, None, None), (3, None, None), (4, None, None), (5, None, None), (6, None, None),
        (7, None, None), (8, None, None), (1, 5, None), (9, None, None),
    ], key=repr)
    with pytest.raises(ValueError):
        variant_field(F.col("_raw"), "a'b", "int")


def test_unnest(stored_variants):
    lines = unnest_variant(stored_variants.withColumnRenamed("id", "order"), "l", {"id": "bigint", "price": "decimal(12,2)"}, ["order"])
    got = sorted(((r.order, r.id, r.price) for r in lines.collect()), key=repr)
    assert got == sorted([(1, 1, Decimal("2.50")), (1, 2, None), (1, None, None), (1, None, None)], key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], "id long, _raw string").withColumn("_raw", as_variant(F.col("_raw")))
    assert promote_variant(none, "a", "int").count() == 0 and unnest_variant(none, "l", {"id": "int"}).count() == 0


@pytest.mark.parametrize("build", [promote_query, unnest_variant_lines])
def test_reading_parses_no_text(spark, build):
    plan = build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("from_json|parse_json|Python", plan, re.I)
