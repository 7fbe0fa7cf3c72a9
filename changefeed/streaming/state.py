"""What streaming jobs hold, read as tables from their checkpoints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "job STRING, operator BIGINT, operator_name STRING, variable STRING, partitions INT, batch BIGINT, rows BIGINT, watermark TIMESTAMP"


def progress_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch, watermark, done) of every batch that a checkpoint still knows: its watermark, and whether it was finished."""

    def logged(name: str) -> DataFrame:
        lines = spark.read.option("recursiveFileLookup", "true").text(f"{checkpoint}/{name}")
        return lines.select(F.col("_metadata.file_name").try_cast("bigint").alias("batch"), "value").where("batch is not null")

    mark = F.get_json_object("value", "$.batchWatermarkMs").cast("bigint")
    marks = logged("offsets").groupBy("batch").agg(F.max(mark).alias("ms"))
    done = logged("commits").select("batch").distinct().withColumn("done", F.lit(True))
    return marks.join(done, "batch", "left").select(
        "batch", F.timestamp_millis("ms").alias("watermark"), F.coalesce("done", F.lit(False)).alias("done")
    )


def state_operators(spark: SparkSession, checkpoint: str) -> list[tuple[int, str, int, str | None]]:
    """(operator, name, partitions, variable) of the stateful operators of a job and the variables they name; a handful,
    from its metadata. Operators with a single unnamed state have no variable."""
    rows = spark.read.format("state-metadata").load(checkpoint)
    rows = rows.groupBy("operatorId", "operatorName").agg(
        F.max("numPartitions").alias("partitions"), F.max("operatorProperties").alias("properties")
    )
    names = F.from_json(F.get_json_object("properties", "$.stateVariables"), "ARRAY<STRUCT<stateName: STRING>>")["stateName"]
    named = rows.select("operatorId", "operatorName", "partitions", F.explode_outer(names).alias("variable"))
    named = named.where("variable is null or variable not like '$%'").orderBy("operatorId", "variable")  # timers are Spark's own
    return [tuple(row) for row in named.collect()]


def held_rows(
    spark: SparkSession, checkpoint: str, operator: int, variable: str | None = None, batch: int | None = None
) -> DataFrame:
    """The rows that one operator held after a finished batch, by default the last: key, value (a list's elements row
    by row) and partition_id."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    reader = reader if variable is None else reader.option("stateVarName", variable)
    return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def report(spark: SparkSession, checkpoint: str, job: str) -> DataFrame:
    """One row per stateful operator of a job, or per variable that it names: after which batch it holds how many rows, and the watermark they were
    judged by. Rows are counted where the state lies, partition by partition; a job without state gives no row.
    """
    last = progress_of(spark, checkpoint).where("done").agg(
        F.max("batch").alias("batch"), F.max_by("watermark", "batch").alias("watermark")
    )
    rows = [
        held_rows(spark, checkpoint, operator, variable)
        .agg(F.count("*").alias("rows"))
        .select(
            F.lit(job).alias("job"),
            F.lit(operator).cast("bigint").alias("operator"),
            F.lit(name).alias("operator_name"),
            F.lit(variable).cast("string").alias("variable"),
            F.lit(partitions).alias("partitions"),
            "rows",
        )
        for operator, name, partitions, variable in state_operators(spark, checkpoint)
    ]
    if not rows:
        return spark.createDataFrame([], REPORT)
    # both sides are single rows per job
    joined = reduce(DataFrame.unionByName, rows).join(F.broadcast(last.withColumn("job", F.lit(job))), "job")
    return joined.select(*[column.split()[0] for column in REPORT.split(", ")])
