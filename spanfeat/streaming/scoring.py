"""Fill incomplete requests from training averages, then score them.

Every step is stateless and row-wise, so the same functions serve a batch frame and the
batches of a stream; neither adds a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# The fields of a scoring request and their types.
REQUEST_SCHEMA = (
    "DELAYS_SO_FAR double, MINUTES_AFTER_MIDNIGHT_ORIGIN double, "
    "MINUTES_AFTER_MIDNIGHT_DEST double, NETWORK_CONGESTION double, "
    "AVG_VIS_DIS_ORIGIN double, DEST_PR double, ORIGIN_PR double, "
    "AVG_DEW_DEG_ORIGIN double, CRS_ELAPSED_TIME double, "
    "AVG_WND_SPEED_ORIGIN double, AVG_WND_SPEED_DEST double, "
    "QUARTER string, DEP_HOUR_BIN string, ARR_HOUR_BIN string, IS_EARLY_MORNING_FLIGHT string"
)


# Column that says why a request cannot be scored.
PROBLEM = "problem"


def training_defaults(train: DataFrame, num: Sequence[str], cat: Sequence[str]) -> dict[str, object]:
    """Mean of each number and most frequent value of each category, as one row.

    Values are counted by one grouping; of equally frequent ones the smallest is taken.
    """
    row = train.agg(*[F.avg(c).alias(c) for c in num]).first().asDict() if num else {}
    if cat:
        named = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cat])
        counts = train.select(F.explode(named).alias("r")).select("r.*").filter("v IS NOT NULL").groupBy("c", "v").count()
        best = counts.groupBy("c").agg(F.min_by("v", F.struct((-F.col("count")).alias("n"), "v")).alias("v"))
        found = {r["c"]: r["v"] for r in best.collect()}  # one row per category
        row |= {c: found.get(c) for c in cat}
    return {c: row[c] for c in [*num, *cat]}


def parse_requests(lines: DataFrame, value: str, schema: str) -> DataFrame:
    """Request records from JSON text, one row each; a text may hold one record or an array.

    Missing keys give nulls. The column ``problem`` is null for a record that was read; it
    holds the text of a record that was not: no JSON, no record, or a field that its type
    cannot hold.
    Of an array with such a record the whole text is refused, since its records cannot be
    told apart. A null text is "no text", an empty array gives no row.
    """
    text = F.col(value).cast("string")
    fields = StructType.fromDDL(schema).fields
    kind = f"struct<{', '.join(f'`{f.name}`: string' for f in fields)}, _corrupt: string>"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(text, f"array<{kind}>", options)

    def bad(r: Column) -> Column:
        """No record, or a field that cannot be read as its type."""
        wrong = [r[f.name].isNotNull() & r[f.name].try_cast(f.dataType).isNull() for f in fields]
        return reduce(lambda a, b: a | b, wrong, r.isNull() | r["_corrupt"].isNotNull())

    refused = F.coalesce(parsed.isNull() | F.exists(parsed, bad), F.lit(True))
    rest = [c for c in lines.columns if c != value]
    return (
        lines.withColumn("_refused", refused)
        .withColumn("_request", F.explode(F.when(refused, F.array(F.lit(None).cast(kind))).otherwise(parsed)))
        .select(
            *rest,
            *[F.col("_request")[f.name].try_cast(f.dataType).alias(f.name) for f in fields],
            F.when(F.col("_refused"), F.coalesce(text, F.lit("no text"))).alias(PROBLEM),
        )
    )


def fill_requests(requests: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace missing arguments by the training defaults and count them."""
    absent = sum((F.col(c).isNull().cast("int") for c in defaults), F.lit(0))
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if v is not None}
    return requests.withColumn("n_filled", absent).withColumns(filled)


def score_requests(
    requests: DataFrame, defaults: Mapping[str, object], model: Model, keep: Sequence[str] = ()
) -> DataFrame:
    """Status, predicted class and both probabilities for every request.

    A record that was not read (see ``parse_requests``) is answered "Error", with nulls. The
    model is a fitted one of Spark ML or of this library.
    """
    has_problem = PROBLEM in requests.columns
    problem = F.col(PROBLEM) if has_problem else F.lit(None).cast("string")
    scored = model.transform(fill_requests(requests, defaults))
    chances = vector_to_array("probability")
    ok = problem.isNull()
    return scored.select(
        *keep,
        F.when(ok, F.col("n_filled")).alias("n_filled"),
        F.when(ok, "Success").otherwise("Error").alias("status"),
        F.when(ok, F.col("prediction").cast("int")).alias("pred"),
        F.when(ok, F.get(chances, F.lit(0))).alias("probability_0"),
        F.when(ok, F.get(chances, F.lit(1))).alias("probability_1"),
    )


def answers(scored: DataFrame, keep: Sequence[str] = (), out: str = "answer") -> DataFrame:
    """Answers as JSON text: status and data with pred and probabilities; an error has no data."""
    data = F.struct("pred", F.array("probability_0", "probability_1").alias("probabilities"))
    body = F.struct("status", F.when(F.col("status") == "Success", data).alias("data"))
    return scored.select(*keep, F.to_json(body).alias(out))


def score_stream(
    lines: DataFrame,
    value: str,
    schema: str,
    defaults: Mapping[str, object],
    model: Model,
    out_path: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    available_now: bool = True,
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Score a stream of JSON records into parquet, below one folder per batch of the stream.

    A batch that is replayed after a failure overwrites its own folder (``batch_id=<n>``), so
    every record is answered once. With ``dead_letters`` the texts that were not read are
    written there as well, in the same way.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        requests = parse_requests(batch, value, schema)
        scored = score_requests(requests, defaults, model, keep)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        if dead_letters is not None:
            refused = requests.filter(F.col(PROBLEM).isNotNull()).select(*keep, PROBLEM)
            refused.write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
