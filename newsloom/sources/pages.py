"""Tables of already fetched pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import host_of, path_of
from ..operators.skew import small


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """``pages(page_id, url, html)`` from Parquet."""
    return spark.read.parquet(path)


def locate(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path``; a URL that does not parse gets a null host."""
    return pages.withColumn("host", host_of("url")).withColumn("path", path_of("url"))


def pages_of_sites(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """Pages with the ``source`` and ``base_url`` of the site whose host they are on.

    A site list of checked small size is broadcast, so the pages do not move.
    """
    hosts = sites.select(host_of("base_url").alias("host"), "source", "base_url")
    return locate(pages).join(small(hosts), "host")
