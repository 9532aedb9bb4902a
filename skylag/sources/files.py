"""Names of files and removal of folders in whatever store the paths name."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; none if it does not exist."""
    store, place = _at(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with all it holds; False if there is none."""
    store, place = _at(spark, path)
    return bool(store.delete(place, True))
