"""Demands with special requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmetry.functions.text import json_document, json_field, json_text, number

# Request keys, by how a request is recognised.
AMOUNT_REQUESTS = ("overHeight", "expressDeliveryTat")
TRUE_REQUESTS = (
    "overWeight",
    "openDala",
    "extraRope",
    "extraWidth",
    "extraPerson",
    "helperRequired",
    "dieselVehicle",
    "extraTripalRequired",
)
REQUESTS_SINCE = "2023-10-01"
MANY_ADDRESSES = 2


def special_request_flag(
    demands: DataFrame, addresses: DataFrame, since: str = REQUESTS_SINCE, many: int = MANY_ADDRESSES
) -> DataFrame:
    """``demand_id``, ``express_delivery`` and ``sr_demand`` (1 where any request or extra address is present)."""
    start = F.lit(since).cast("timestamp_ntz")
    many_points = (
        addresses.where((F.col("created") >= start) & F.col("demand_id").isNotNull())
        .groupBy("demand_id")
        .agg(F.count("demand_id").alias("points"))
        .where(F.col("points") > many)
        .select("demand_id", F.lit(True).alias("via_points"))
    )
    fields = ", ".join(f"{key} string" for key in (*AMOUNT_REQUESTS, *TRUE_REQUESTS))
    body_text = json_text(F.col("metadata"), "specialRequestBody")
    requested = demands.where(F.col("created") >= start).select(
        F.col("id").alias("demand_id"), json_document(body_text, fields).alias("body")
    )
    body = F.col("body")
    asked = F.coalesce(F.col("via_points"), F.lit(False))
    for key in AMOUNT_REQUESTS:
        asked = asked | F.coalesce(number(json_field(body, key)) > 0, F.lit(False))
    for key in TRUE_REQUESTS:
        asked = asked | F.coalesce(json_field(body, key) == "true", F.lit(False))
    return requested.join(many_points, "demand_id", "left").select(
        "demand_id",
        number(json_field(body, "expressDeliveryTat")).alias("express_delivery"),
        asked.cast("int").alias("sr_demand"),
    )
