"""Files the reports start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.functions.predicates import require_columns
from shopledger.functions.scalars import step_name, step_number
from shopledger.operators.funnel import IGNORED

ATTEMPT_COLUMNS = {
    "Description": "description",
    "Customer Email": "customer_email",
    "Status": "status",
    "Created date (UTC)": "created_utc",
    "Card ID": "card_id",
}
REVIEW_SCHEMA = (
    "itemsList array<struct<title:string,feedback:struct<adminStatus:string,rating:string,productName:string,"
    "sku:string,orderId:string,title:string,feedBack:string,nameOnAmazon:string,email:string,createdAt:string>>>"
)


def normalized_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def _in_file_order(df: DataFrame) -> DataFrame:
    """Adds ``row_no``, which sorts as the file does: by file, split, and row of the split."""
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.withColumn("row_no", place)


def read_csv(spark: SparkSession, path: str, required: list[str] = (), encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header, all columns as text."""
    df = spark.read.csv(path, header=True, encoding=encoding, multiLine=False, escape='"')
    return require_columns(df, list(required), path)


def read_funnel_csv(
    spark: SparkSession, path: str, funnel: str | None = None, preamble: int = 9, day: str = "Day", ignored: tuple[str, ...] = IGNORED
) -> DataFrame:
    """Step rows of daily funnel exports whose header follows ``preamble`` lines.

    Such an export has one line per day, so a file is one short text. Every file of ``path`` has a
    header, and steps, of its own. Without ``funnel`` a file's funnel is its ``funnel=<name>`` folder,
    else its name up to the first dot.
    """
    texts = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    place = F.col("_metadata.file_path")
    folder = F.regexp_extract(place, "/funnel=([^/]*)/[^/]*$", 1)
    name = F.lit(funnel) if funnel else F.when(folder != "", folder).otherwise(F.regexp_extract(place, "([^/.]*)[^/]*$", 1))
    files = texts.select(name.alias("funnel"), place.alias("file"), F.split("value", "\r?\n").alias("lines"))
    files = files.withColumn("header", F.get("lines", F.lit(preamble)))
    # The width bounds the number of cells of a line; one number for all files.
    seen = files.agg(F.max(F.size(F.split("header", ","))).alias("width"), F.count_if(F.col("header").isNull()).alias("bad")).first()
    if seen["bad"] or seen["width"] is None:
        raise ValueError(f"{path}: no header after {preamble} lines")
    cells = [f"c{i}" for i in range(seen["width"])]
    schema = ", ".join(f"{c} string" for c in cells)

    def parsed(line: Column) -> Column:
        row = F.from_csv(line, schema)
        return F.array(*[row[c] for c in cells])

    rows = files.select("funnel", parsed(F.col("header")).alias("names"), F.explode(F.slice("lines", preamble + 2, F.size("lines"))).alias("line"))
    rows = rows.filter(F.trim("line") != "").select("funnel", "names", parsed(F.col("line")).alias("cells"))
    of_day = F.get("cells", (F.array_position("names", day) - 1).cast("int"))
    long = rows.select("funnel", of_day.cast("int").alias("day"), F.inline(F.arrays_zip(F.col("names").alias("column"), F.col("cells").alias("users"))))
    long = long.filter(F.col("column").isNotNull() & ~F.col("column").isin(day, *ignored))
    step = F.col("column")
    return long.select("funnel", "day", step_number(step).alias("step_no"), step_name(step).alias("step"), F.col("users").cast("bigint").alias("users"))


def read_blocked_payments(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, ["customer_id", "payment_intent_id", "description", "amount", "rule_decision_created"])
    return _in_file_order(df).select(
        "customer_id",
        "payment_intent_id",
        "description",
        F.col("amount").try_cast("double").alias("amount"),
        F.col("rule_decision_created").try_cast("timestamp_ntz").alias("rule_decision_created"),
        "row_no",
    )


def read_processor_payments(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, ["Description", "Status", "Amount"])
    return _in_file_order(df).select(
        F.col("Description").alias("description"),
        F.col("Status").alias("status"),
        F.col("Amount").try_cast("double").alias("amount"),
        "row_no",
    )


def read_payment_attempts(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Attempts of a payment export, with fractions of a second where the file has them.

    An unreadable time becomes NULL (see ``require_valid``).
    """
    df = read_csv(spark, path, list(ATTEMPT_COLUMNS), encoding).withColumnsRenamed(ATTEMPT_COLUMNS)
    created = F.try_to_timestamp("created_utc", F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")).cast("timestamp_ntz")
    return df.select(*ATTEMPT_COLUMNS.values()).withColumn("created_utc", created)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review documents (one JSON document per file) as title and feedback rows."""
    docs = spark.read.schema(REVIEW_SCHEMA).json(path, multiLine=True)
    return docs.select(F.explode("itemsList").alias("item")).select("item.*")


def read_enriched_reviews(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return require_columns(normalized_columns(df), ["sku", "overallrating", "date"], path)
