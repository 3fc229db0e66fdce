"""Landed response pages: JSON envelopes ``{"<resource>": [record, ...]}`` and their records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import parse_once
from tidemark.functions.timestamps import parse_iso
from tidemark.model import Resource


def read_pages(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Pages as text, one per file or one per line, with the file they came from."""
    reader = spark.read.option("wholetext", one_per_file).option("recursiveFileLookup", True)
    return reader.text(path).withColumn("_page", F.col("_metadata.file_path"))


def stream_pages(
    spark: SparkSession, path: str, files_per_batch: int = 1000, one_per_file: bool = True
) -> DataFrame:
    """The same pages as a stream over the landing folder."""
    reader = spark.readStream.option("wholetext", one_per_file).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("recursiveFileLookup", True).text(path).withColumn("_page", F.col("_metadata.file_path"))


def explode_pages(pages: DataFrame, resource: Resource, body: str = "value", broken: str = "fail") -> DataFrame:
    """One row per record, its JSON text in ``_raw`` and its place in the page in ``_pos``.

    A page with an empty body, or without the resource's field, has no rows. A body that is no readable envelope
    fails the query; with ``broken="reject"`` it is one row with the body in ``_raw`` and ``_page_broken`` set, which
    ``project_records`` rejects whatever the body looks like.
    """
    if broken not in ("fail", "reject"):
        raise ValueError(f"broken must be fail or reject, not {broken!r}")
    field = resource.page_field
    text = F.trim(F.col(body))
    envelope = F.from_json(
        F.col(body), f"`{field}` array<string>, `_broken` string", {"columnNameOfCorruptRecord": "_broken"}
    )
    parsed = parse_once(pages.withColumn("_body", F.col(body)), envelope, "_envelope")
    unreadable = (text != "") & (F.col("_envelope._broken").isNotNull() | ~text.startswith("{"))
    if broken == "fail":
        page = F.coalesce(F.col("_page"), F.lit("?")) if "_page" in pages.columns else F.lit("?")
        instead = F.raise_error(F.concat(F.lit("page is no readable envelope: "), page)).cast("array<string>")
    else:
        instead = F.array(F.col("_body"))
    records = F.when(unreadable, instead).otherwise(F.col("_envelope")[field])
    rest = [c for c in pages.columns if c != body]
    if broken == "reject":
        parsed, rest = parsed.withColumn("_page_broken", F.coalesce(unreadable, F.lit(False))), [*rest, "_page_broken"]
    return parsed.select(*rest, F.posexplode(records).alias("_pos", "_raw"))


def project_records(
    records: DataFrame, resource: Resource, sync_id: str | None, as_of: Column
) -> DataFrame:
    """Lift key and ``updated_at`` out of ``_raw`` and stamp the row; nothing is dropped.

    ``_reject`` is NULL for good rows and names the reason for the others. All lifted fields come
    from one pass over the text. A row marked ``_page_broken`` is no record: it has neither key nor time.
    """
    names = (*resource.key, "updated_at")
    schema = ", ".join(f"`{n}` string" for n in names) + ", `_broken` string"
    parsed = F.from_json(F.col("_raw"), schema, {"columnNameOfCorruptRecord": "_broken"})
    rest = [c for c in records.columns if c not in ("_raw", "_page_broken")]
    whole = ~F.col("_page_broken") if "_page_broken" in records.columns else F.lit(True)
    lifted = parse_once(records, parsed, "_p").select(
        *rest,
        *(F.when(whole, F.col(f"_p.{k}").try_cast("bigint")).alias(k) for k in resource.key),
        F.when(whole, parse_iso(F.col("_p.updated_at"))).alias("updated_at"),
        "_raw",
        as_of.cast("timestamp").alias("_synced_at"),
        F.lit(sync_id).cast("string").alias("_sync_id"),
        (~whole | F.col("_p._broken").isNotNull()).alias("_bad_json"),
    )
    no_key = F.lit(False)
    for k in resource.key:
        no_key = no_key | F.col(k).isNull()
    reason = F.when(F.col("_raw").isNull() | F.col("_bad_json"), "bad_json").when(no_key, "no_key")
    if resource.updated_at_required:
        reason = reason.when(F.col("updated_at").isNull(), "no_updated_at")
    return lifted.withColumn("_reject", reason).drop("_bad_json")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_reject").isNull()).drop("_reject")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_reject").isNotNull())


def usable_ids(records: DataFrame, id_column: str = "id") -> DataFrame:
    """Ids of a snapshot without NULL and zero."""
    return records.select(id_column).filter(F.col(id_column) != 0)
