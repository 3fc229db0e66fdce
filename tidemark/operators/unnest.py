"""Nested record fields as columns and child tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json import parse_once, variant_field
from tidemark.model import ID_BATCH_SIZE
from tidemark.operators.buckets import dense_index
from tidemark.operators.merge import active_rows

MONEY = "decimal(12,2)"

LINE_FIELDS = {
    "id": "bigint", "product_id": "bigint", "variant_id": "bigint", "sku": "string",
    "title": "string", "quantity": "int", "price": MONEY,
}
VARIANT_FIELDS = {
    "id": "bigint", "product_id": "bigint", "sku": "string", "title": "string", "price": MONEY,
    "compare_at_price": MONEY, "inventory_item_id": "bigint", "inventory_quantity": "int",
}
PAYMENT_FIELDS = {"gateway": "string", "amount": MONEY}


def unnest(
    records: DataFrame, array: str, fields: Mapping[str, str], keep: Sequence[str] = (), raw: str = "_raw"
) -> DataFrame:
    """One row per element of a JSON array field, with typed columns; a bad value becomes NULL.

    Only the named fields are read from the text.
    """
    inner = ", ".join(f"`{f}`: string" for f in fields)
    parsed = F.from_json(F.col(raw), f"`{array}` array<struct<{inner}>>")
    rows = parse_once(records, parsed, "_p").select(*keep, F.explode(F.col("_p")[array]).alias("_e"))
    return rows.select(*keep, *(F.col(f"_e.{f}").try_cast(t).alias(f) for f, t in fields.items()))


def unnest_variant(
    records: DataFrame, array: str, fields: Mapping[str, str], keep: Sequence[str] = (), raw: str = "_raw"
) -> DataFrame:
    """The same from a VARIANT column; nothing is parsed. What is no array has no rows."""
    elements = F.explode(variant_field(F.col(raw), array, "array<variant>"))
    rows = records.select(*keep, elements.alias("_e"))
    return rows.select(*keep, *(variant_field(F.col("_e"), f, t).alias(f) for f, t in fields.items()))


def order_lines(orders: DataFrame) -> DataFrame:
    return unnest(orders.withColumnRenamed("id", "order_id"), "line_items", LINE_FIELDS, ["order_id"])


def product_variants(products: DataFrame) -> DataFrame:
    return unnest(products.select("_raw"), "variants", VARIANT_FIELDS)


def amount_by_gateway(orders: DataFrame) -> DataFrame:
    payments = unnest(orders, "transactions", PAYMENT_FIELDS)
    return payments.groupBy("gateway").agg(F.sum("amount").alias("total"))


def variant_rows(products: DataFrame) -> DataFrame:
    """Variant ids of active products, without NULL and zero, one for each variant."""
    return unnest(active_rows(products), "variants", {"id": "bigint"}).filter(F.col("id") != 0)


def variant_ids(products: DataFrame) -> DataFrame:
    """The same ids, each once."""
    return variant_rows(products).distinct()


def request_batches(
    ids: DataFrame, locations: DataFrame, id_column: str = "id", location_column: str = "id",
    size: int = ID_BATCH_SIZE,
) -> DataFrame:
    """Ids in ascending batches of ``size``, comma-joined, each next to the list of all locations."""
    batch = F.floor(F.col("_n") / size)
    where = locations.agg(F.array_join(F.sort_array(F.collect_list(location_column)), ",")).scalar()
    return (
        dense_index(ids.select(id_column), id_column, "_n")
        .groupBy(batch.alias("batch_no"))
        .agg(F.array_join(F.sort_array(F.collect_list(id_column)), ",").alias("variant_ids"))
        .withColumn("location_ids", where)
    )


def flatten(records: DataFrame, paths: Mapping[str, tuple[str, str]], raw: str = "_raw") -> DataFrame:
    """Add a typed column per ``{column: (path, type)}``; a path is ``field`` or ``object.field``.

    All columns come from one pass over the text, an unusable value is NULL.
    """
    tree: dict[str, list[str] | None] = {}
    for path, _ in paths.values():
        top, _, leaf = path.partition(".")
        if not leaf:
            tree.setdefault(top, None)
        elif tree.setdefault(top, []) is None:
            raise ValueError(f"{top!r} is read both as a value and as an object")
        elif leaf not in tree[top]:
            tree[top].append(leaf)
    schema = ", ".join(
        f"`{top}` string" if leaves is None
        else f"`{top}` struct<{', '.join(f'`{x}`: string' for x in leaves)}>"
        for top, leaves in tree.items()
    )
    parsed = parse_once(records, F.from_json(F.col(raw), schema), "_p")
    columns = {c: F.col(f"_p.{path}").try_cast(kind) for c, (path, kind) in paths.items()}
    return parsed.withColumns(columns).drop("_p")


ORDER_COLUMNS = {
    "order_number": ("order_number", "string"),
    "total_price": ("total_price", MONEY),
    "financial_status": ("financial_status", "string"),
    "customer_id": ("customer.id", "bigint"),
    "customer_email": ("customer.email", "string"),
    "customer_phone": ("customer.phone", "string"),
    "shipping_name": ("shipping_address.name", "string"),
    "shipping_city": ("shipping_address.city", "string"),
    "shipping_country": ("shipping_address.country", "string"),
}


def promote_field(table: DataFrame, field: str, kind: str, column: str = "", raw: str = "_raw") -> DataFrame:
    """One more typed column out of ``_raw``."""
    return flatten(table, {column or field: (field, kind)}, raw)


def promote_variant(table: DataFrame, field: str, kind: str, column: str = "", raw: str = "_raw") -> DataFrame:
    """One more typed column out of a VARIANT ``_raw``; ``field`` may be ``object.field``."""
    return table.withColumn(column or field, variant_field(F.col(raw), field, kind))


def apply_mapping(
    table: DataFrame,
    key: Sequence[str],
    rename: Mapping[str, str] | None = None,
    skip: Sequence[str] = (),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Skip, re-type and rename columns; a row with a value that cannot be cast gets ``_reject``.

    Names in ``skip`` and ``types`` are source names.
    """
    rename, types = dict(rename or {}), dict(types or {})
    unknown = (set(rename) | set(skip) | set(types)) - set(table.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    if set(skip) & set(key):
        raise ValueError("a key column cannot be skipped")
    names = [rename.get(c, c) for c in table.columns if c not in skip]
    if len(set(names)) < len(names):
        raise ValueError("a column is renamed to a name that is taken")

    def cast(c: str) -> Column:
        return F.col(c).try_cast(types[c]) if c in types else F.col(c)

    reason = F.lit(None).cast("string")
    for c in types:
        if c not in skip:
            reason = F.when(F.col(c).isNotNull() & cast(c).isNull(), f"type of {c}").otherwise(reason)
    kept = [c for c in table.columns if c not in skip]
    return table.select(*(cast(c).alias(rename.get(c, c)) for c in kept), reason.alias("_reject"))
