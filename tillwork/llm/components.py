"""Connected components of a table of links, by alternating large and small stars.

Each round rewrites the links so that nodes point at ever smaller neighbours, until every
component is a star around its smallest node; the number of rounds grows with the logarithm of a
component's size. Links are cut from their lineage by writing every round to the shared folder.
A node with very many links costs a grouped minimum, which is combined before the shuffle, and a
join: with more than ``MANY`` links the minima are written first, as Spark splits the skewed side of a
join only where no aggregate shares its stage. Each round's tables go when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.session import fresh_dir, remove

MANY = 1_000_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: no lineage, known size."""
    folder = fresh_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _minima(least: DataFrame, folders: list[str], many: bool) -> DataFrame:
    if not many:
        return least
    folders.append(fresh_dir(least.sparkSession, "minima"))
    least.write.parquet(folders[-1])
    return least.sparkSession.read.parquet(folders[-1])


def _large_star(links: DataFrame, folders: list[str], many: bool) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = _minima(least, folders, many)
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame, folders: list[str], many: bool) -> DataFrame:
    """``links`` with u > v: all smaller neighbours of u, and u, point at the smallest."""
    least = _minima(links.groupBy("u").agg(F.min("v").alias("m")), folders, many)
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it can reach; nodes without links are absent.

    ``links`` has two columns of a numeric type; direction, repeats, self links and nulls do not
    matter.
    """
    spark = links.sparkSession
    a, b = links.columns
    folder = fresh_dir(spark, "links")
    links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct().write.parquet(folder)
    links = spark.read.parquet(folder)
    mark = _mark(links)
    while mark[0]:
        done, many = [folder], mark[0] > MANY
        folder = fresh_dir(spark, "links")
        larger = _large_star(links, done, many)
        if many:
            done.append(fresh_dir(spark, "larger"))
            larger.write.parquet(done[-1])
            larger = spark.read.parquet(done[-1])
        _small_star(larger, done, many).write.parquet(folder)
        links = spark.read.parquet(folder)
        before, mark = mark, _mark(links)
        for old in done:
            remove(spark, old)
        if mark == before:
            break
    star = links.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return star.union(star.select(F.col("label").alias("node"), "label").distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.bit_xor(F.xxhash64("v", "u")),
        ).first()
    )
