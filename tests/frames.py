"""Small hand-made frames for the unit tests."""


def frame(spark, rows, schema="user_id long, item_id long, rating double, ts long"):
    return spark.createDataFrame(rows, schema)
