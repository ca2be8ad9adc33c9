"""Closed cases: filter, area join, derived columns, newest n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselore.functions.text import first_segment, forward_slashes, rest_of_path, text_or_empty

WINDOW_LIMIT = 1000  # above this a rank filter no longer prunes before the shuffle


# Output columns: text is empty where null, numbers and flags must not be null, times may be null.
TEXTS = {"case_id": "sr_number", "product_id": "pes_product_id", "product_name": "product_name", "sr_owner": "sr_owner",
         "sr_status": "sr_status", "service_request_status": "service_request_status", "sr_severity": "sr_severity",
         "sr_max_severity": "sr_max_severity", "internal_title": "internal_title", "ir_status": "ir_status",
         "sap_path": "sap_path", "support_topic_id": "support_topic_id"}
NUMBERS = ["case_idle_days", "communication_idle_days", "collaboration_tasks", "phone_interactions", "email_interactions"]
FLAGS = ["is_s500", "is_transferred"]
TIMES = ["created_ts", "closed_ts", "first_assignment_ts"]


def _required(name: str) -> str:
    return f"coalesce({name}, raise_error('{name} must not be null'))"


def closed_cases(
    fact: DataFrame,
    areas: DataFrame,
    as_of: Column,
    product_id: str | None = None,
    sap_path: str | None = None,
    case_id: str | None = None,
    max_age_days: int | None = None,
) -> DataFrame:
    """Closed cases of all products, or of one; unset parameters add no filter.

    A negative or missing max_age_days switches the age filter off. The area side is joined
    without a hint: adaptive execution broadcasts it when its real size allows.
    """
    fact = fact.filter(F.col("sr_status") == "Closed")
    if case_id:
        fact = fact.filter(F.col("sr_number") == case_id)
    if max_age_days is not None and max_age_days >= 0:
        fact = fact.filter(F.col("sr_age_days") <= max_age_days)
    if product_id is not None:
        areas = areas.filter(F.col("pes_product_id") == product_id)
    if sap_path:
        areas = areas.filter(forward_slashes(F.col("sap_path")) == sap_path.replace("\\", "/"))

    topic = F.col("support_topic_id")
    return fact.join(areas, "sap_key").select(
        *[F.expr(f"coalesce(cast({source} AS string), '') AS {name}") for name, source in TEXTS.items()],
        *[F.expr(f"cast({_required(n)} AS int) AS {n}") for n in NUMBERS],
        *[F.expr(f"{_required(n)} AS {n}") for n in FLAGS],
        *TIMES,
        text_or_empty(first_segment(topic)).alias("support_topic_l2"),
        text_or_empty(rest_of_path(topic)).alias("support_topic_l3"),
        F.datediff(as_of, F.expr(_required("created_ts"))).alias("case_age"),
    )


def newest_per_product(cases: DataFrame, n: int, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """The n newest cases of each product; ties by case id.

    A small n is a rank filter, which Spark applies before the shuffle too. For a large n the
    cases are counted per product and day, and those of the day the limit falls into per second,
    to find the moment of the last case to keep. Only cases of that second are ranked, in salted
    groups first. So no task sorts a whole product.
    """
    if n <= window_limit:
        newest = Window.partitionBy("product_id").orderBy(F.col("created_ts").desc(), F.col("case_id").asc())
        return cases.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")
    early = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    moment = F.coalesce(F.date_trunc("second", "created_ts").cast("timestamp_ntz"), early)
    times = cases.select("product_id", moment.alias("_moment"), F.lit(n).cast("long").alias("_room"))

    def reached(rows: DataFrame, slot: str) -> DataFrame:
        """The slot of each product that holds the last case to keep, and the room left in it."""
        later = (Window.partitionBy("product_id").orderBy(F.col(slot).desc())
                 .rowsBetween(Window.unboundedPreceding, -1))
        return (rows.groupBy("product_id", slot).agg(F.count("*").alias("_count"), F.max("_room").alias("_room"))
                .withColumn("_left", F.col("_room") - F.coalesce(F.sum("_count").over(later), F.lit(0)))
                .filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_count")))
                .select("product_id", slot, F.col("_left").alias("_room")))

    dated = times.withColumn("_day", F.to_date("_moment"))
    in_day = dated.drop("_room").join(reached(dated, "_day"), ["product_id", "_day"])
    edge = reached(in_day, "_moment").select("product_id", F.col("_moment").alias("_edge"), "_room")
    placed = cases.withColumn("_moment", moment).join(edge, "product_id", "left")
    kept = placed.filter(F.col("_edge").isNull() | (F.col("_moment") > F.col("_edge"))).select(*cases.columns)
    tied = placed.filter(F.col("_moment") == F.col("_edge"))
    salt = F.pmod(F.xxhash64("case_id"), F.lit(64))
    for keys in (["product_id", salt], ["product_id"]):
        order = Window.partitionBy(*keys).orderBy(F.col("created_ts").desc(), "case_id")
        tied = tied.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= F.col("_room"))
    return kept.unionByName(tied.select(*cases.columns))


def in_request_order(cases: DataFrame) -> DataFrame:
    """Newest first, as a request returns them; a range sort, not one task."""
    return cases.orderBy(F.col("created_ts").desc(), F.col("case_id").asc())
