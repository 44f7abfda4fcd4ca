"""The rules of a table, compiled to one projection; refused rows, their reasons and all counts come from the pass that stores the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quotelake.schemas import TableSpec
from quotelake.session import work_folder

REASON = "reason"


def rules(spec: TableSpec) -> dict[str, Column]:
    """What each rule refuses, by reason, in the order they are judged: missing keys and required values, then too long texts."""
    missing = {f"missing: {name}": F.col(name).isNull() for name in dict.fromkeys([*spec.key, *spec.required])}
    long = {f"too long: {name}": F.length(name) > limit for name, limit in spec.lengths.items()}
    return missing | long


def reason_of(spec: TableSpec) -> Column:
    """The first rule that refuses a row; NULL for a row that keeps all."""
    return F.coalesce(*[F.when(refused, F.lit(reason)) for reason, refused in rules(spec).items()])


def split_stored(rows: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Rows that keep the rules, refused rows with their reason, and the number of refused rows by reason.

    The rows are computed once: stored by whether they passed, and counted on the way.
    """
    spark, path, counter = rows.sparkSession, work_folder(rows.sparkSession, spec.name), Observation()
    reasons = list(rules(spec))
    judged = rows.withColumn(REASON, reason_of(spec))
    counts = [F.count_if(F.col(REASON) == reason).alias(str(k)) for k, reason in enumerate(reasons)]
    passed = F.col(REASON).isNull().alias("passed")
    judged.observe(counter, F.count(F.lit(1)).alias("rows"), *counts).select("*", passed).write.partitionBy("passed").parquet(path)
    found = counter.get
    stored = spark.read.schema(judged.select("*", passed).schema).parquet(path)
    refused = {reason: found[str(k)] for k, reason in enumerate(reasons) if found[str(k)]}
    return stored.where("passed").select(*rows.columns), stored.where("not passed").drop("passed"), refused

