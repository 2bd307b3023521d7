"""Hadoop sequence files of ``(key, json text)``.

Sequence files have no DataFrame reader or writer in Spark, so these two edges go through
the RDD API; rows become pairs and pairs rows in the JVM, no Python worker sees them. They
are there to read and write such files; at scale convert once and stay with Parquet
(``write_documents`` / ``read_documents``), which is columnar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .text import allow_repeated_keys, read_keyed_json


def read_sequence_documents(spark: SparkSession, path: str) -> DataFrame:
    allow_repeated_keys(spark)
    sc = spark.sparkContext
    pairs = sc.sequenceFile(path, "org.apache.hadoop.io.Text", "org.apache.hadoop.io.Text")
    # as createDataFrame does, without its pass over each pair in Python
    rows = sc._jvm.SerDeUtil.toJavaArray(pairs._to_java_object_rdd())
    schema = StructType([StructField("uri", StringType()), StructField("json", StringType())])
    raw = DataFrame(spark._jsparkSession.applySchemaToPythonRDD(rows.rdd(), schema.json()), spark)
    return raw.select("uri", F.parse_json("json").alias("doc"))


def write_sequence_documents(docs: DataFrame, path: str) -> None:
    sc = docs.sparkSession.sparkContext
    jvm = sc._jvm
    text = jvm.org.apache.spark.sql.Encoders.STRING()
    rows = docs.select("uri", F.to_json("doc").alias("json"))._jdf
    pairs = getattr(rows, "as")(jvm.org.apache.spark.sql.Encoders.tuple(text, text))
    rdd = pairs.rdd()
    if rdd.isEmpty():  # there is no pair to tell the types
        text_type, output = "org.apache.hadoop.io.Text", "org.apache.hadoop.mapred.SequenceFileOutputFormat"
        sc.parallelize([], 1).saveAsHadoopFile(path, output, keyClass=text_type, valueClass=text_type)
        return
    # as RDD.saveAsSequenceFile does, from pairs that are in the JVM already
    jvm.PythonRDD.saveAsSequenceFile(jvm.SerDeUtil.pairRDDToPython(rdd, 0).toJavaRDD(), True, path, None)


def text_to_sequence(spark: SparkSession, src: str, dst: str, sep: str = "\t") -> None:
    """Keyed JSON lines → sequence file of ``(key, json)``."""
    write_sequence_documents(read_keyed_json(spark, src, sep), dst)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("uri", "doc")


def write_documents(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    docs.select("uri", "doc").write.mode(mode).parquet(path)
