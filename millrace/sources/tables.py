"""Access to a folder of Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, folder).orders`` reads ``folder/orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str, **options: object) -> DataFrame:
        """The table as a file stream with the schema of its batch form.

        The bracket turns the path into a pattern, which the file source
        accepts for a single file as well as for a folder of files.
        """
        reader = self.spark.readStream.schema(getattr(self, name).schema)
        for key, value in options.items():
            reader = reader.option(key, value)
        return reader.parquet(f"{self.folder}/[{name[0]}]{name[1:]}.parquet")
