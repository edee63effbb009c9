"""Status per request from the destination's landed answers: a stream–stream join.

Requests (the outbox) and responses both arrive as streams.  A request waits for its response until the
timeout has passed in event time; the outer join then gives it up as unanswered.  The state holds the
requests and responses of one timeout only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.activation import MSG_CREATED, MSG_SENT, MSG_UPDATED

# --- fixed values: statuses -----------------------------------------------------
STATUS_OK = 200
STATUS_NO_ANSWER = 400
MSG_REFUSED = "ERROR in uploading audience %s: %s"
MSG_NO_ANSWER = "ERROR in uploading audience %s"
# ---------------------------------------------------------------------------------

RESPONSE_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("code", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("time", T.StringType()),
])


def responses(docs: DataFrame) -> DataFrame:
    """Landed answers (JSON in ``value``) → request_id, code, answer, answered_at; others are left out."""
    d = docs.select(F.from_json("value", RESPONSE_SCHEMA).alias("d")).select("d.*")
    return (d.select("request_id", "code", F.col("message").alias("answer"),
                     F.try_to_timestamp("time").alias("answered_at"))
            .where("request_id is not null and code is not null and answered_at is not null"))


def response_status(requests: DataFrame, answers: DataFrame, timeout: str = "90 minutes",
                    watermark: str = "0 seconds") -> DataFrame:
    """message_id, audience, action, status_code, message of each request.

    ``requests(message_id, audience, action, sent_at)`` and ``answers`` of ``responses``, both streaming
    or both batch.  Code 0 is status 200; another code is the status itself, with the answer's text; a
    request without an answer within ``timeout`` has status 400.  Of several answers to one request in
    the window each makes a row: an answer is expected once.
    """
    sent = requests.select(F.col("message_id").cast("string").alias("message_id"), "audience", "action", "sent_at")
    if requests.isStreaming:
        sent, answers = sent.withWatermark("sent_at", watermark), answers.withWatermark("answered_at", watermark)
    within = (F.col("message_id") == F.col("request_id")) & F.expr(
        f"answered_at >= sent_at AND answered_at <= sent_at + INTERVAL {timeout}")
    code = F.col("code")
    done = (F.when(F.col("action") == "APPEND", F.format_string(MSG_UPDATED, "audience"))
            .when(F.col("action") == "CREATE", F.format_string(MSG_CREATED, "audience"))
            .otherwise(F.format_string(MSG_SENT, "audience")))
    return sent.join(answers, within, "left_outer").select(
        "message_id", "audience", "action",
        F.when(code.isNull(), F.lit(STATUS_NO_ANSWER)).when(code == 0, F.lit(STATUS_OK)).otherwise(code)
        .cast("long").alias("status_code"),
        F.when(code.isNull(), F.format_string(MSG_NO_ANSWER, "audience")).when(code == 0, done)
        .otherwise(F.format_string(MSG_REFUSED, F.col("audience"), F.coalesce("answer", F.lit("")))).alias("message"))
