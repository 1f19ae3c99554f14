"""Build hit lines and parsed hits from literals."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def line(query, time="2024-01-01T02:57:10+08:00", head="10.0.0.1|_|u1"):
    return f"{head}|_|{time}|_|http://log.example/t.gif?{query}"


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "event_id bigint, line string")


def hits(spark, rows):
    """``(event_id, arrival, date, minute, cuc, rc, un)`` tuples as parsed hits of one site."""
    schema = (
        "event_id bigint, arrival bigint, date string, minute string,"
        " cuc string, rc string, un string"
    )
    return spark.createDataFrame(rows, schema).withColumn("ws", F.lit("10000001"))


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
