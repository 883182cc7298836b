"""What several test modules use."""


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan(df, mode="simple"):
    jvm = df.sparkSession._jvm
    kind = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(kind)


def shuffles_held(spark):
    """Shuffles whose files lie on disk."""
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
