"""Model stages over recorded replies: the user turns of ``conversations`` are the
requests, the assistant turns after them the replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qbank.operators import infer as INF
from qbank.sources import fixtures as FX
from qbank.sources import tables as TB


def turn_requests(conversations: DataFrame) -> DataFrame:
    """One request per user turn (prompt: its text; system: the conversation's first
    system turn), with ``own_reply``, the assistant turn right after it."""
    system = (conversations.where(F.col("role") == "system").groupBy("conv_id")
              .agg(F.min_by("text", "turn").alias("system_text")))
    own = conversations.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("own_reply"))
    users = (conversations.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("ask"))
             .join(system, "conv_id", "left").join(own, ["conv_id", "turn"], "left")
             .withColumn("seq", FX.pair_key("conv_id", "turn")))
    return INF.build_requests(users, request_id="seq", prompt="ask", task="chat", system=F.col("system_text"),
                              model="recorded", json_mode=False, keep=["conv_id", "turn", "seq", "own_reply"])


def recorded_reply_table(requests: DataFrame) -> DataFrame:
    """The reply table that the recorded turns make: per distinct request the reply of
    its last turn (a map-side partial aggregate, so a hot prompt ships little)."""
    keyed = requests.where(F.col("own_reply").isNotNull()).withColumn("cache_key", INF.cache_key_col())
    return (keyed.groupBy("cache_key").agg(F.max_by("own_reply", "seq").alias("response"))
            .select("cache_key", "response", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error")))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = turn_requests(TB.conversations(spark, sf_dir))
    return INF.replay(req, recorded_reply_table(req))


def recorded_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M0 request table: per user turn how many turns share its request."""
    keyed = turn_requests(TB.conversations(spark, sf_dir)).withColumn("cache_key", INF.cache_key_col())
    same = keyed.groupBy("cache_key").agg(F.count(F.lit(1)).alias("n_same"))
    return keyed.join(same, "cache_key").select("conv_id", "turn", F.md5("prompt").alias("prompt_md5"), "n_same")


def recorded_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M0 de-dup + cache join: every user turn answered from the recorded replies."""
    return _replayed(spark, sf_dir).select("conv_id", "turn", "status", F.md5("response").alias("response_md5"))


def others_replies(requests: DataFrame) -> DataFrame:
    """``requests`` with ``response``, the last reply that another conversation gave to
    the same request. Two rows per request do: the last reply of all, and the last one
    of any other conversation; a turn of the first one's conversation takes the second."""
    keyed = requests.withColumn("cache_key", INF.cache_key_col())
    given = keyed.where(F.col("own_reply").isNotNull())
    of_conv = given.groupBy("cache_key", "conv_id").agg(F.max(F.struct("seq", "own_reply")).alias("r"))
    last = of_conv.groupBy("cache_key").agg(F.max(F.struct("r.seq", "r.own_reply", "conv_id")).alias("a"))
    other = (of_conv.join(last, "cache_key").where(~F.col("conv_id").eqNullSafe(F.col("a.conv_id")))
             .groupBy("cache_key").agg(F.max(F.struct("r.seq", "r.own_reply")).alias("b")))
    table = last.join(other, "cache_key", "left")
    reply = F.when(F.col("conv_id").eqNullSafe(F.col("a.conv_id")), F.col("b.own_reply")).otherwise(F.col("a.own_reply"))
    return keyed.join(table, "cache_key", "left").withColumn("response", reply).drop("a", "b")


def recorded_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5 + A3 over recorded replies of others: how often the last reply that another
    conversation gave to a turn's request is the turn's own. No reply meets itself."""
    r = others_replies(turn_requests(TB.conversations(spark, sf_dir)))
    hit = F.coalesce(F.col("response") == F.col("own_reply"), F.lit(False))
    out = r.agg(F.count(F.lit(1)).alias("n_requests"), F.count("response").alias("n_succeeded"),
                F.coalesce(F.sum(hit.cast("bigint")), F.lit(0)).cast("bigint").alias("n_correct"))
    return out.withColumn("accuracy_pct", F.try_divide(F.col("n_correct").cast("double") * 100.0,
                                                       F.col("n_succeeded").cast("double")))


class NoBackend(INF.Backend):
    """Fails every call: what is answered comes from the cache."""

    def complete(self, batch):
        raise RuntimeError("asked")


def cached_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M0 with a reply cache table: recorded replies are put into it, and a run whose
    backend fails every call is answered from it."""
    req = turn_requests(TB.conversations(spark, sf_dir))
    cache = INF.ReplyTable(spark)
    cache.add(recorded_reply_table(req))
    out = INF.infer(req, NoBackend(), cache=cache.read(), name="cached")
    return out.select("conv_id", "turn", "status", F.md5("response").alias("response_md5"))
