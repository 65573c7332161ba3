"""Raw payload text -> typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridspark.functions import instant

_BROKEN = "_broken"


def payload_text() -> Column:
    return F.col("payload").cast("string")


def opened_payloads(bronze: DataFrame, schema: StructType) -> DataFrame:
    """The envelope with its payload opened into the columns of `schema`; blank payloads go.

    Text that is not JSON becomes a row of NULLs and falls out at the key filter. The blank test is on
    the text, so that the payload is parsed once and not again in a filter.
    """
    filled = bronze.where(F.trim(payload_text()) != "")
    envelope = [instant("extracted_at").alias("extracted_at"), F.col("source_url").cast("string").alias("source_url")]
    return filled.select(*envelope, F.from_json(payload_text(), schema).alias("p")).select(
        "extracted_at", "source_url", "p.*"
    )


def judged_payloads(bronze: DataFrame, schema: StructType) -> DataFrame:
    """Every bronze row with its payload opened (`parsed`) and, if no fact can come of it, the `reason`.

    Reasons: `blank`, `no object` (error pages), `malformed` (an object cut off or broken so that it has
    no data), `no zone`, `no data`. Of rows with a reason the text is kept, of others it is NULL. The
    payload is parsed once.
    """
    text = payload_text()
    broken = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    opened = bronze.select(
        instant("extracted_at").alias("extracted_at"), F.col("source_url").cast("string").alias("source_url"), text.alias("payload"),
        F.from_json(text, broken, {"columnNameOfCorruptRecord": _BROKEN}).alias("p"),
    )
    reason = (
        F.when(F.coalesce(F.trim("payload", F.lit(" \t\r\n")), F.lit("")) == "", "blank")
        .when(~F.ltrim("payload", F.lit(" \t\r\n")).startswith("{"), "no object")
        .when(F.col(f"p.{_BROKEN}").isNotNull() & F.col("p.data").isNull(), "malformed")
        .when(F.col("p.zone").isNull(), "no zone")
        .when(F.col("p.data").isNull(), "no data")
    )
    return opened.select(
        "extracted_at", "source_url", F.struct(*[F.col("p").getField(f.name).alias(f.name) for f in schema]).alias("parsed"),
        reason.alias("reason"), F.when(reason.isNotNull(), F.col("payload")).alias("payload"),
    )


def rejected(judged: DataFrame) -> DataFrame:
    """The rows of `judged_payloads` that were not accepted: equal ones once, with their number in
    `copies` and a digest to know them by when they come again."""
    known = ["extracted_at", "source_url", "reason", "payload"]
    rows = judged.where("reason IS NOT NULL").groupBy(*known).agg(F.count("*").alias("copies"))
    digest = F.sha2(F.concat_ws("\n", F.col("extracted_at").cast("string"), *known[1:]), 256)
    return rows.select(digest.alias("digest"), *known, "copies", F.to_date("extracted_at").alias("dt"))


def payload_items(bronze: DataFrame, schema: StructType) -> DataFrame:
    """One row per element of the payload's `data` array, with the element's own fields as columns.

    `inline` opens array and struct in one step; elements that are NULL are taken out before. Only an
    object can have the array, so that other text (error pages) is not given to the parser, where it
    costs an exception per row; the first byte says so of most, without a pass over the text. Rows of
    `judged_payloads` are opened already.
    """
    if "parsed" in bronze.columns:
        return _items(bronze.select("extracted_at", "source_url", "parsed.*"))
    text = payload_text()
    objects = bronze.where(text.startswith("{") | F.ltrim(text, F.lit(" \t\r\n")).startswith("{"))
    return _items(opened_payloads(objects, schema))


def _items(opened: DataFrame) -> DataFrame:
    return opened.select(
        "extracted_at",
        "source_url",
        "zone",
        F.col("temporalGranularity").alias("temporal_granularity"),
        "unit",
        F.inline(F.array_compact("data")),
    )
