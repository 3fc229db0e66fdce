import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.model import RESOURCES
from tidemark.operators import unnest
from tidemark.operators.buckets import dense_index
from tidemark.sources.pages import accepted, explode_pages, project_records, read_pages, usable_ids

ORDERS, LEVELS = RESOURCES["orders"], RESOURCES["inventory_levels"]


def project(rows, resource):
    return project_records(rows, resource, "s", F.lit("2026-04-01 00:00:00").cast("timestamp"))


def records(spark, *nodes):
    return spark.createDataFrame([(n if isinstance(n, str) or n is None else json.dumps(n),) for n in nodes], "_raw string")


def test_pages_without_records(spark, tmp_path):
    bodies = ['{"orders": [{"id": 1, "x": {"y": [1.50]}}, {"id": 2}]}', "", '{"other": [{"id": 3}]}', '{"orders": []}', " \n", '{"orders": null}']
    for n, body in enumerate(bodies):
        (tmp_path / f"{n}.json").write_text(body)
    got = explode_pages(read_pages(spark, str(tmp_path)), ORDERS).orderBy("_pos").collect()
    assert [(r._page[-6:], r._pos, json.loads(r._raw)["id"]) for r in got] == [("0.json", 0, 1), ("0.json", 1, 2)]
    assert json.loads(got[0]._raw) == {"id": 1, "x": {"y": [1.50]}}


@pytest.mark.parametrize("body", ["oops", '{"orders": [{"id": 1}, {"id"', "[]", '"x"', '{"orders": {"id": 1}}', "{",
    '{"orders": {"id": 1}, "id": 5, "updated_at": "2026-01-01T00:00:00Z"}'])
def test_broken_pages(spark, body):
    pages = spark.createDataFrame([('{"orders": [{"id": 1}]}', "p0"), (body, "p1")], "value string, _page string")
    with pytest.raises(Exception, match="page is no readable envelope: p1"):
        explode_pages(pages, ORDERS).collect()
    rows = project(explode_pages(pages, ORDERS, broken="reject"), ORDERS)
    assert {(r._page, r._reject) for r in rows.collect()} == {("p0", "no_updated_at"), ("p1", "bad_json")}


def test_other_envelope_name(spark):
    page = spark.createDataFrame([('{"inventory_locations": [{"inventory_item_id": 1, "location_id": 2}]}',)], "value string")
    row = project(explode_pages(page, LEVELS), LEVELS).first()
    assert (row.inventory_item_id, row.location_id, row.updated_at, row._reject) == (1, 2, None, None)


@pytest.mark.parametrize(
    "node, reason",
    [
        ({"id": 1, "updated_at": "2026-04-01T10:00:00Z"}, None),
        ({"id": 0, "updated_at": "2026-04-01"}, None),
        ({"id": "7", "updated_at": "2026-04-01"}, None),
        ({"updated_at": "2026-04-01T10:00:00Z"}, "no_key"),
        ({"id": None, "updated_at": "2026-04-01T10:00:00Z"}, "no_key"),
        ({"id": "x", "updated_at": "2026-04-01T10:00:00Z"}, "no_key"),
        ({"id": 1}, "no_updated_at"),
        ({"id": 1, "updated_at": "soon"}, "no_updated_at"),
        ('{"id": 1, "upd', "bad_json"),
        (None, "bad_json"),
    ],
)
def test_reject_reasons(spark, node, reason):
    rows = project(records(spark, node), ORDERS)
    assert rows.first()._reject == reason
    assert accepted(rows).count() == (reason is None)


def test_locations_need_no_time_and_levels_no_id(spark):
    assert project(records(spark, {"id": 1}), RESOURCES["locations"]).first()._reject is None
    level = project(records(spark, {"id": 9, "inventory_item_id": 1, "location_id": 2}), LEVELS)
    assert "id" not in level.columns and level.first()._reject is None
    assert project(records(spark, {"id": 9, "location_id": 2}), LEVELS).first()._reject == "no_key"


def test_json_is_parsed_once(spark):
    rows = accepted(project(records(spark, {"id": 1}), ORDERS)).filter("id > 0 AND updated_at > '2020-01-01'")
    assert rows._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
    lines = unnest.unnest(records(spark, {"v": [{"id": 1}]}), "v", {"id": "bigint"}).filter("id > 0")
    assert lines._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_variant_ids(spark):
    products = spark.createDataFrame(
        [(json.dumps({"variants": [{"id": 1}, {"id": 2}, {"id": None}, {}, {"id": 0}]}), None),
         (json.dumps({"variants": [{"id": 2}, {"id": "3"}]}), None),
         (json.dumps({"variants": [{"id": 9}]}), "deleted"),
         (json.dumps({}), None), (json.dumps({"variants": "none"}), None)],
        "_raw string, _deleted_at string",
    )
    assert sorted(r.id for r in unnest.variant_ids(products).collect()) == [1, 2, 3]
    assert [r.id for r in usable_ids(spark.createDataFrame([(0,), (None,), (5,)], "id bigint")).collect()] == [5]


def test_201_ids_make_two_batches(spark):
    ids, places = spark.range(1, 202), spark.createDataFrame([(8,), (3,)], "id bigint")
    got = unnest.request_batches(ids, places).orderBy("batch_no").collect()
    assert [len(r.variant_ids.split(",")) for r in got] == [200, 1]
    assert got[1].variant_ids == "201" and {r.location_ids for r in got} == {"3,8"}


def test_dense_index(spark):
    rng = random.Random(5)
    ids = sorted({rng.choice([rng.randrange(-300, 300), rng.randrange(10**5), rng.randrange(-(2**62), 2**62)]) for _ in range(2000)})
    shuffled = spark.createDataFrame([(i,) for i in rng.sample(ids, len(ids))], "id bigint")
    got = {r.id: r.n for r in dense_index(shuffled, "id", "n").collect()}
    assert got == {v: n for n, v in enumerate(ids)}


def test_flatten_and_promote(spark):
    rows = records(spark, {"id": 1, "customer": {"id": 7, "email": "a@b"}, "total_price": "350000.00"}, {"customer": None, "total_price": "x"})
    got = unnest.flatten(rows, unnest.ORDER_COLUMNS).collect()
    assert (got[0].customer_id, got[0].customer_email, str(got[0].total_price), got[0].shipping_city) == (7, "a@b", "350000.00", None)
    assert got[1].customer_id is None and got[1].total_price is None
    assert unnest.promote_field(rows, "total_price", "string", "p").first().p == "350000.00"
    with pytest.raises(ValueError):
        unnest.flatten(rows, {"a": ("customer", "string"), "b": ("customer.id", "bigint")})


def test_mapping(spark):
    rows = spark.createDataFrame([(1, "1.5", "n"), (2, "abc", "n"), (3, None, "n")], "id bigint, price string, note string")
    got = unnest.apply_mapping(rows, ["id"], {"price": "revenue"}, ["note"], {"price": "decimal(12,2)"}).collect()
    assert got[0].asDict().keys() == {"id", "revenue", "_reject"}
    assert [r._reject for r in got] == [None, "type of price", None]
    for bad in ({"rename": {"price": "id"}}, {"skip": ["id"]}, {"types": {"nope": "int"}}):
        with pytest.raises(ValueError):
            unnest.apply_mapping(rows, ["id"], **bad)
