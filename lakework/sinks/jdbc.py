"""Relational tables over JDBC."""


def write_jdbc(df, options, column_types=None, partitions=None, batchsize=10_000, truncate=False):
    """Replace a database table.

    ``partitions`` bounds the number of open connections: rows are shuffled to so many tasks,
    so that whatever computes them still runs at full width. Without it each task of the
    frame opens one. ``column_types`` gives
    database types, e.g. ``"title VARCHAR(200)"``: without them text becomes a CLOB
    in some databases, which cannot be compared. ``truncate`` keeps the table's
    definition and grants.
    """
    if partitions is not None:
        df = df.repartition(partitions)
    writer = (
        df.write.format("jdbc").options(**options)
        .option("batchsize", batchsize)
        .option("truncate", truncate)
    )
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.mode("overwrite").save()
