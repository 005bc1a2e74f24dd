"""Small helpers shared by the tests."""


def rows(df, *columns):
    """Sorted row tuples."""
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def column(spark, ddl, values, expression):
    """Values of an expression over a one-column table, in input order."""
    data = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, {ddl}")
    return [r[1] for r in df.select("i", expression.alias("out")).orderBy("i").collect()]
