"""Batch readers. Paths go to Spark's readers only, so any store that Spark can open will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Values up to which a membership scan is a pushed-down IN list; more are joined.
IN_LIST = 100


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """SRC-01: a whole table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys over all cores: a file of narrow rows is one split however many it has, so what is slow a row would be one task's."""
    session = df.sparkSession
    return df.repartition(max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions"))), *keys)


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """SRC-02: a projected scan; only these columns are read."""
    return df.select(*names)


def find_by_field(df: DataFrame, field: str, value) -> DataFrame:
    """SRC-03: at most one row with the value."""
    return df.where(F.col(field) == F.lit(value)).limit(1)


def find_all_by_field(df: DataFrame, field: str, value) -> DataFrame:
    """SRC-04."""
    return df.where(F.col(field) == F.lit(value))


def find_all_in(df: DataFrame, field: str, values: list) -> DataFrame:
    """SRC-05: rows whose value is among `values`."""
    known = list(dict.fromkeys(v for v in values if v is not None))
    if len(known) <= IN_LIST:
        return df.where(F.col(field).isin(known)) if known else df.where(F.lit(False))
    wanted = df.sparkSession.createDataFrame([(v,) for v in known], f"`{field}` {df.schema[field].dataType.simpleString()}")
    return df.join(wanted, field, "left_semi")


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """SRC-06: files that hold a JSON array of documents each. The schema is given: inference would turn maps into structs."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def contents_payload(body: Column, schema: str) -> Column:
    """SRC-07: the document inside a contents-API answer, whose content is base64 with line breaks."""
    answer = F.from_json(body, "content string, sha string")
    text = F.decode(F.unbase64(F.regexp_replace(answer["content"], r"\s", "")), "UTF-8")
    return F.struct(F.from_json(text, schema).alias("data"), answer["sha"].alias("sha"))


def string_list(text: Column) -> Column:
    """SRC-08: the strings of a JSON list, trimmed; other kinds of elements and empty strings are left out."""
    items = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    strings = F.transform(F.filter(items, lambda v: F.schema_of_variant(v) == "STRING"), lambda v: F.trim(v.cast("string")))
    return F.coalesce(F.filter(strings, lambda s: s != ""), F.array().cast("array<string>"))


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09: one row a file: path and text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def mapping_or_empty(text: Column) -> Column:
    """SRC-09: a JSON object as a map of strings; anything else is an empty map."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>"))


def nested_cards(body: Column, field: str, item: str) -> Column:
    """SRC-11: the list under `field` of an API answer."""
    return F.from_json(body, f"struct<{field}: array<struct<{item}>>>")[field]


def lines(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """SRC-12: a row a line, with its place."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """SRC-14: (path, modified, size) of files under a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def newest(files: DataFrame, path: str = "path") -> DataFrame:
    """SRC-15, SRT-07: the file whose name is last in order."""
    return files.agg(F.max_by(F.struct(*files.columns), F.substring_index(path, "/", -1)).alias("f")).where("f is not null").select("f.*")


def first_that_exists(spark: SparkSession, *paths: str) -> str | None:
    """SRC-16: the first path that is there, as for the cleaned output of an earlier run before the original."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(conf).exists(at):
            return path
    return None
