import json

from pyspark.sql import functions as F

from newsfold.operators.normalize import normalize_records, split_malformed


def record_rows(spark, values):
    """``arrival_seq, record`` of Python values, in order."""
    rows = [(at, json.dumps(value)) for at, value in enumerate(values)]
    frame = spark.createDataFrame(rows, "arrival_seq bigint, text string")
    return frame.select("arrival_seq", F.try_parse_json("text").alias("record"))


def normalize_values(spark, values):
    objects, _ = split_malformed(record_rows(spark, values))
    return normalize_records(objects)


def normalized_rows(spark, values):
    return [row.asDict() for row in normalize_values(spark, values).orderBy("arrival_seq").collect()]
