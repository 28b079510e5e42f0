"""Success, retry and dead-letter branches of per-message work."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RETRIES = 3  # fixed value


@dataclass(frozen=True)
class Routes:
    success: DataFrame
    retry: DataFrame
    dead: DataFrame


def attempt(messages: DataFrame, process: Callable[[DataFrame], DataFrame], max_retries: int = MAX_RETRIES) -> DataFrame:
    """Messages with ``result``, ``error``, the ``retry_count`` so far and the ``route`` to take.

    ``process`` adds ``result`` and a text column ``error`` that is null on success. It may use
    ``try_*`` functions or a pandas UDF.
    """
    count = F.coalesce(F.try_element_at("attributes", F.lit("retry_count")).try_cast("int"), F.lit(0))
    route = (F.when(F.col("error").isNull(), "success")
             .when(F.col("retry_count") < max_retries, "retry").otherwise("dlq"))
    return process(messages).withColumn("retry_count", count).withColumn("route", route)


def split_routes(attempted: DataFrame, at: Column | None = None) -> Routes:
    """The three branches of ``attempt``; persist its result first if more than one is written."""
    branch = {name: attempted.filter(F.col("route") == name) for name in ("success", "retry", "dlq")}
    return Routes(
        branch["success"].select("message_id", "result"),
        branch["retry"].select(
            "message_id", "data", "error", (F.col("retry_count") + 1).alias("retry_count"),
            (F.current_timestamp() if at is None else at).alias("timestamp")),
        branch["dlq"].select(
            "message_id", "data", "error", "retry_count", F.lit(True).alias("final_failure")))
