"""Landed responses: one row per answered or failed request, with the JSON body as text.

All responses of one unit of work (a facility, a batch of facilities, a crawl) share a
request_id and succeed or fail together; page numbers them within it, and responses says
how many there should be (NULL: as many as there are).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careledger.operators.merge import keep_last
from careledger.schemas import ENVELOPE, PAYLOADS

_CORRUPT = "_corrupt"


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses as line-delimited JSON, read with a fixed schema."""
    return spark.read.schema(ENVELOPE).json(path)


def stream_landing(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same as a stream. No file is too old to be read: by default the source would drop files
    more than a week older than the newest one."""
    return spark.readStream.schema(ENVELOPE).options(**{"maxFileAge": "365000d", **options}).json(path)


def latest_answers(responses: DataFrame) -> DataFrame:
    """The last answer of each page of a request: a retry takes the place of what failed, and of answers
    of the same time a good one counts. Answers without a page can't be told apart and all count."""
    keys = ["request_id", "page"]
    # Ids are counted first, so that bodies are only moved where something was answered twice.
    if responses.filter("page IS NOT NULL").groupBy(*keys).count().filter("count > 1").isEmpty():
        return responses
    good = responses.withColumn("__good", F.col("status").eqNullSafe("ok"))
    last = keep_last(good.filter("page IS NOT NULL"), keys, ["fetched_at", "__good"])
    return last.unionByName(good.filter("page IS NULL")).drop("__good")


def decode(responses: DataFrame, kind: str, keep_body: bool = False) -> DataFrame:
    """Add payload, the typed body, and failed, TRUE for a response that cannot be used.

    A body that breaks off keeps no partial content: its payload is NULL.
    """
    body = F.from_json(
        "body", f"{PAYLOADS[kind]}, {_CORRUPT} string", {"columnNameOfCorruptRecord": _CORRUPT}
    )
    parsed = responses.withColumn("payload", body)
    broken = F.col("payload").isNull() | F.col(f"payload.{_CORRUPT}").isNotNull()
    failed = ~F.col("status").eqNullSafe("ok") | broken
    decoded = parsed.select(
        *responses.columns, F.when(~failed, F.col("payload")).alias("payload"), failed.alias("failed")
    )
    return decoded if keep_body else decoded.drop("body")


def seq(position: str | None = None) -> F.Column:
    """Arrival order: later responses, then later elements of one response, come last."""
    parts = [F.col("fetched_at"), F.col("request_id"), F.col("page")]
    return F.struct(*parts, F.col(position) if position else F.lit(0).alias("pos"))


def check_pages(decoded: DataFrame, strict: bool = False) -> DataFrame:
    """Per request: pages expected and pages present. With strict, a gap is an error."""
    report = decoded.groupBy("request_id").agg(
        F.coalesce(F.max("payload.pager.pageCount"), F.lit(0)).alias("pages_expected"),
        F.count_distinct(F.when(~F.col("failed"), F.col("page"))).cast("int").alias("pages_found"),
    ).withColumn("complete", F.col("pages_found") >= F.greatest("pages_expected", F.lit(1)))
    if strict:
        gaps = report.filter(~F.col("complete")).limit(5).collect()
        if gaps:
            raise ValueError(f"pages are missing for {[r.request_id for r in gaps]}")
    return report
