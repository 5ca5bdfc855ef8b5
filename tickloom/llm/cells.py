"""Raw files from binary cells, written and read by Spark, so any Hadoop file system serves.

The text writer puts a cell's bytes down unchanged and ends it with the line
separator, here one zero byte. A caller whose format ends with a zero byte drops
that byte from the cell and lets the separator supply it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\0"


def write_cells(df: DataFrame, path: str, *folders: str) -> None:
    """Write the binary column ``value``, a file per cell, below ``folders`` columns' values."""
    raw = df.withColumn("value", F.col("value").cast("string"))
    raw.write.partitionBy(*folders).option("lineSep", END).option("maxRecordsPerFile", 1).text(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """path, content of each file that is not empty; a folder that no task wrote to has none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "path string, content binary")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .where("length > 0")
        .select("path", "content")
    )
