"""Product reviews: picking the verified ones and preparing them for loading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.periods import in_zone_to_utc
from shopledger.functions.predicates import require_columns
from shopledger.functions.scalars import (
    blank_to_null,
    classify,
    normalized_status,
    padded_id,
    stable_id,
)
from shopledger.operators.core import metric_rows, small_table


def verified_reviews(reviews: DataFrame) -> DataFrame:
    """Verified reviews rated 4 or 5, one flat row each. ``reviews``: title, feedback."""
    fb = "feedback."
    rating = F.col(fb + "rating").try_cast("int")
    return reviews.filter(
        normalized_status(F.col(fb + "adminStatus")).contains("VERIFIED") & rating.isin(4, 5)
    ).select(
        F.coalesce(F.nullif(F.col(fb + "productName"), F.lit("")), F.col("title")).alias("product"),
        F.col(fb + "sku").alias("sku"),
        F.col(fb + "orderId").alias("order_id"),
        F.col(fb + "title").alias("headline"),
        F.col(fb + "feedBack").alias("comment"),
        F.col(fb + "nameOnAmazon").alias("nickname"),
        F.col(fb + "email").alias("email"),
        F.when(rating == 5, F.lit(10)).otherwise(F.lit(8)).alias("recommendation"),
        rating.alias("overallrating"),
        F.col(fb + "createdAt").alias("date"),
    )


def verified_reviews_summary(reviews: DataFrame) -> DataFrame:
    """Reviews in all and reviews kept, from one pass."""
    rating = F.col("feedback.rating").try_cast("int")
    kept = normalized_status(F.col("feedback.adminStatus")).contains("VERIFIED") & rating.isin(4, 5)
    counts = reviews.agg(F.count(F.lit(1)).alias("all"), F.count_if(kept).alias("kept"))
    return metric_rows(counts, {"reviews": F.col("all"), "verified_reviews": F.col("kept")})


def _whole_number(name: str):
    """Text like "4" or "4.0" as an integer, NULL if it is none."""
    return F.trim(F.col(name).cast("string")).try_cast("double").try_cast("int")


def review_load_set(
    enriched: DataFrame,
    type_rules: Sequence[dict],
    pictures: Mapping[str, str],
    picture_base: str,
    created_by: str,
    default_type: int = 1,
    no_list: str = "a:0:{}",
) -> DataFrame:
    """Rows ready for the review table; unreadable dates and ratings stay NULL (see ``review_load_errors``).

    The id is drawn from the review itself, so a second load repeats it.
    """
    require_columns(enriched, ["sku", "overallrating", "date"], "review_load_set")
    columns = {c: F.col(c) for c in enriched.columns}
    for optional in ("headline", "comment", "nickname", "email", "recommendation", "pros", "cons"):
        if optional not in columns:
            enriched = enriched.withColumn(optional, F.lit(None).cast("string"))
    sku = F.upper(F.trim(F.col("sku").cast("string")))
    dim = small_table(
        enriched.sparkSession,
        {"sku_key": list(pictures), "picture": list(pictures.values())},
        "sku_key string, picture string",
    )
    posted = in_zone_to_utc(F.col("date").cast("string"))
    image = F.when(
        F.col("picture").isNotNull(),
        F.concat(F.lit('{"mainImage": "'), F.lit(picture_base), F.col("picture"), F.lit('"}')),
    )
    nickname = blank_to_null(F.col("nickname"))
    return (
        enriched.withColumn("sku_key", sku)
        .join(dim, "sku_key", "left")
        .select(
            stable_id("REV", 32, sku, F.col("email"), F.col("date"), F.col("headline"), F.col("comment")).alias("id"),
            F.lit(created_by).alias("created_by"),
            padded_id("PRT", classify(F.col("sku"), type_rules, default_type), 32).alias("product_review_type_id"),
            blank_to_null(F.col("headline")).alias("headline"),
            blank_to_null(F.col("comment")).alias("comment"),
            F.substring_index(nickname, " ", 1).alias("nickname"),
            blank_to_null(F.col("email")).alias("email"),
            image.alias("additional_fields"),
            F.coalesce(blank_to_null(F.col("pros")), F.lit(no_list)).alias("pros"),
            F.coalesce(blank_to_null(F.col("cons")), F.lit(no_list)).alias("cons"),
            _whole_number("recommendation").alias("recommendation"),
            F.lit(0).alias("visible"),
            _whole_number("overallrating").alias("overall_rating"),
            posted.alias("review_date"),
            posted.alias("created_at"),
        )
    )


def review_load_errors(load_set: DataFrame) -> DataFrame:
    """Rows that must not be loaded: no readable date or rating."""
    problem = F.when(F.col("review_date").isNull(), F.lit("date")).when(F.col("overall_rating").isNull(), F.lit("overallrating"))
    return load_set.withColumn("problem", problem).filter(F.col("problem").isNotNull()).select("id", "problem")
