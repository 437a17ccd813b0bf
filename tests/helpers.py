from pyspark.sql import types as T


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), T.StructType.fromDDL(schema))


def rows(df):
    return [tuple(r) for r in df.collect()]


def bag(df):
    return sorted(rows(df), key=repr)
