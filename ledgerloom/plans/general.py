"""Queries of the general data-preparation problems: packed fields and mixed date texts."""

from __future__ import annotations

import zoneinfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.packed import explode_packed
from ..operators.timestamps import normalise
from ..sources.tables import table
from .registry import CORE

UUID = r"re:^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"

def candidate_zones(*columns: DataFrame) -> list[str]:
    """Zones a row may be in whose zone is given nowhere: all that the tables name, and UTC; at most as many as the zone database has."""
    named = columns[0]
    for more in columns[1:]:
        named = named.unionByName(more)
    known = [z for z in zoneinfo.available_timezones() if "/" in z]
    return sorted({"UTC", *(r.zone for r in named.where(F.col("zone").isin(known)).distinct().collect())})


@CORE.add("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the packed fields of directions; a direction_id that is delivered twice counts once."""
    directions = table(spark, sf_dir, "directions").select("direction_id", "topic_count", "topic_ids", "topic_names", "original_subtracks")
    catalogues = {"topic": table(spark, sf_dir, "topic").select("label"), "track": table(spark, sf_dir, "track").select("name")}
    fields = {"topic_ids": UUID, "topic_names": "topic", "original_subtracks": "track"}
    return explode_packed(directions.dropDuplicates(["direction_id"]), "direction_id", fields, catalogues, "topic_count")


@CORE.add("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The UTC instant of each publish_date and start_date that denotes an existing date."""
    media = table(spark, sf_dir, "media_site").select("media", F.col("zone").alias("_zone_of"), F.col("date_order").alias("_order_of"))
    results = table(spark, sf_dir, "search_result").select("result_id", "media", "publish_date", "discovered_at").dropDuplicates(["result_id"])
    results = results.join(media, "media", "left")
    plans = table(spark, sf_dir, "research_plan").select("plan_id", "config_version", "start_date", "zone", "date_order", "created_at").dropDuplicates(["plan_id"])
    zones = candidate_zones(media.select(F.col("_zone_of").alias("zone")), plans.select("zone"))
    found = normalise(results, "publish_date", "_zone_of", "_order_of", ["media"], "discovered_at", zones)
    # exploding drops the nulls; a filter would be pushed into the parsing and repeat it
    utc = F.explode(F.filter(F.array("utc_us"), lambda x: x.isNotNull())).alias("utc_us")
    a = found.select(F.lit("search_result").alias("src"), F.col("result_id").cast("string").alias("row_key"), utc)
    planned = normalise(plans, "start_date", "zone", "date_order", ["config_version"], "created_at", zones)
    b = planned.select(F.lit("research_plan").alias("src"), F.col("plan_id").alias("row_key"), utc)
    return a.unionByName(b)
