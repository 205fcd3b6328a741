"""Readers of document formats. Each gives typed columns, the file and an ordinal; order is never implied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from .paths import exists

NUMBER = r"(-?[\d.]+)"
#: A positioned run of text: x, y, width, colour, font, size, text. Commands begin with a prefix of letters of the document's own.
SPAN = rf"\\[A-Za-z]*PlacedTextContent\{{{NUMBER}\}}\{{{NUMBER}\}}\{{{NUMBER}\}}\{{([^{{}}]*)\}}\{{([^{{}}]*)\}}\{{{NUMBER}\}}\{{(.*)\}}"
PAGE = r"^\s*%\s*Page\s+(\d+)"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no (from 0), line: whole files split at newlines."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"))


def spans(rows: DataFrame) -> DataFrame:
    """Positioned spans of lines (file, line_no, line), with the page of the last marker before them."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marker = F.when(F.regexp_extract("line", PAGE, 1) != "", F.regexp_extract("line", PAGE, 1).cast("int"))
    rows = rows.withColumn("page", F.coalesce(F.last(marker, ignorenulls=True).over(w), F.lit(1)))
    part = lambda i: F.regexp_extract("line", SPAN, i)
    names = {"x": 1, "y": 2, "w": 3, "size": 6}
    return rows.where(F.col("line").rlike(SPAN)).select("file", "line_no", "page", *[part(i).cast("double").alias(n) for n, i in names.items()], part(4).alias("color"), part(5).alias("font"), part(7).alias("text"))


def visible_text(rows: DataFrame) -> DataFrame:
    """Per file the texts of all its spans in order of line, joined by blanks."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.regexp_extract("line", SPAN, 7).alias("text")))), lambda x: x["text"])
    return rows.where(F.col("line").rlike(SPAN)).groupBy("file").agg(F.array_join(parts, " ").alias("text"))


def before(rows: DataFrame, end: str = r"\end{tikzpicture}") -> DataFrame:
    """Lines of each file before the first that holds end (a first page)."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("_e", F.max(F.contains("line", F.lit(end)).cast("int")).over(w)).where("_e = 0").drop("_e")


def commented_block(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Comment lines after the first start marker, up to an end marker or a line that is no comment."""
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_s", F.max(F.contains("line", F.lit(start)).cast("int")).over(w)).where("_s = 1")
    stop = ~F.contains("line", F.lit(start)) & (F.contains("line", F.lit(end)) | ~F.col("line").rlike(r"^\s*%"))
    rows = rows.withColumn("_e", F.max(stop.cast("int")).over(w)).where((F.col("_e") == 0) & ~F.contains("line", F.lit(start)))
    return rows.select("file", "line_no", F.regexp_replace("line", r"^\s*%\s?", "").alias("text"))


def environments(whole: DataFrame, first: str = "question", second: str = "answer") -> DataFrame:
    """unit, question, answer of paired environments in (file, value)."""
    get = lambda n: F.regexp_extract_all("value", F.lit(rf"(?s)\\begin\{{{n}\}}(.*?)\\end\{{{n}\}}"), F.lit(1))
    z = F.arrays_zip(get(first).alias("a"), get(second).alias("b"))
    return whole.select("file", F.posexplode(z).alias("unit", "z")).where("z.b is not null").select("file", "unit", X.strip(F.col("z.a")).alias(first), X.strip(F.col("z.b")).alias(second))


def quotes(rows: DataFrame) -> DataFrame:
    """Quote slots (x, y, width, quote) with the id of the last comment before them; an id serves one quote."""
    slot = rf"\\[A-Za-z]*MaybeNotableQuoteAt\{{{NUMBER}\}}\{{{NUMBER}\}}\{{{NUMBER}\}}\{{(.*)\}}"
    w = Window.partitionBy("file").orderBy("line_no")
    rows = rows.withColumn("_q", F.col("line").rlike(slot)).withColumn("_id", F.nullif(F.regexp_extract("line", r"^\s*%\s*quote-id:\s*(\S+)", 1), F.lit("")))
    rows = rows.withColumn("_g", F.coalesce(F.sum(F.col("_q").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = Window.partitionBy("file", "_g").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("quote_id", F.last("_id", ignorenulls=True).over(own)).where("_q")
    return rows.select("file", "line_no", *[F.regexp_extract("line", slot, i).cast("double").alias(n) for i, n in ((1, "x"), (2, "y"), (3, "width"))], F.regexp_extract("line", slot, 4).alias("quote"), "quote_id")


def catalog(whole: DataFrame, kind: str, schema: str = "pieces array<struct<piece_type:string,issue:string,slug:string,tex:string,source_pdf:string,doi:string>>") -> DataFrame:
    """The pieces of a kind of catalog documents (value: JSON)."""
    rows = whole.select(F.explode(F.from_json("value", schema)["pieces"]).alias("p")).select("p.*")
    return rows.where(F.col("piece_type") == kind)


def required_field(records: DataFrame, name: str) -> DataFrame:
    """file and value of one field of every record; a record without it is an error."""
    value = F.col("fields")[name]
    return records.select("file", F.when(F.coalesce(value, F.lit("")) == "", F.raise_error(F.concat(F.lit(f"no {name} in "), "file"))).otherwise(value).alias("value"))


def bib(whole: DataFrame) -> DataFrame:
    """key and fields (map; a repeated field keeps its last value) of the record in each (file, value)."""
    pattern = F.lit(r"(?s)(\w+)\s*=\s*\{((?:[^{}]|\{[^{}]*\})*)\}")
    names = F.transform(F.regexp_extract_all("value", pattern, F.lit(1)), F.lower)
    values = F.transform(F.regexp_extract_all("value", pattern, F.lit(2)), X.collapse)
    pairs = F.arrays_zip(names.alias("n"), values.alias("v"))
    last = lambda p: F.filter(p, lambda x, i: ~F.exists(F.slice(p, i + 2, F.size(p)), lambda y: y["n"] == x["n"]))
    last = F.flatten(F.transform(F.array(pairs), last))  # pairs bound once: in a lambda that names a column it would be found anew for each field
    rows = whole.withColumn("key", F.regexp_extract("value", r"@\w+\s*\{\s*([^,\s]+)\s*,", 1)).where("key <> ''")
    return rows.select("file", "key", F.map_from_entries(F.transform(last, lambda x: F.struct(x["n"].alias("key"), x["v"].alias("value")))).alias("fields"))


def captions(rows: DataFrame) -> DataFrame:
    """start (seconds) and word of WebVTT lines: words with times of their own, and those before the first at the
    time of their cue. The same word at the same millisecond counts once."""
    cue = F.nullif(F.regexp_extract("line", r"^((?:\d+:)?\d+:\d+[.,]\d+)\s+-->", 1), F.lit(""))
    w = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_cue", cue).withColumn("_at", F.last("_cue", ignorenulls=True).over(w)).where("_cue is null and _at is not null and trim(line) <> ''")
    parts = F.split("line", r"(?=<(?:\d+:)?\d+:\d+[.,]\d+>)")
    rows = rows.select("file", "_at", F.explode(parts).alias("p"))
    own = F.nullif(F.regexp_extract("p", r"^<((?:\d+:)?\d+:\d+[.,]\d+)>", 1), F.lit(""))
    rows = rows.select("file", F.round(X.seconds(F.coalesce(own, F.col("_at"))), 3).alias("start"), F.explode(F.split(F.trim(F.regexp_replace("p", r"<[^>]*>", " ")), r"\s+")).alias("word"))
    return rows.where("word <> ''").withColumn("_k", F.lower("word")).dropDuplicates(["file", "start", "_k"]).drop("_k")


def csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as strings; a missing or empty value is ""."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', enforceSchema=False)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One document per file, with its file."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("file", F.col("_metadata.file_path"))


def json_lines(rows: DataFrame, column: str, schema: str) -> DataFrame:
    return rows.select(F.from_json(column, schema).alias("j")).select("j.*")


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, length and time of files; contents aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "length", "modificationTime")


def hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file and the upper-case SHA-256 of its content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("file"), F.upper(F.sha2("content", 256)).alias("sha256"))


def or_empty(spark: SparkSession, path: str, read, schema: str, strict: bool = False) -> DataFrame:
    """read() of a table, or an empty one if its path is missing; an error if strict. Other faults are errors."""
    if strict or exists(spark, path):
        return read()
    return spark.createDataFrame([], schema)


def wav_seconds(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """file and seconds of WAV files, from the first bytes of each: the byte rate of the format and the length of the data."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    word = lambda at: F.conv(F.concat(*[F.hex(F.substring("content", at + k, 1)) for k in (3, 2, 1, 0)]), 16, 10).cast("double")
    whole = (F.substring("content", 1, 4) == F.lit(b"RIFF")) & (F.substring("content", 37, 4) == F.lit(b"data"))
    return files.select(F.col("path").alias("file"), F.when(whole, word(41) / word(29)).alias("seconds"))


def svg_paths(spark: SparkSession, path: str) -> DataFrame:
    """id, fill and d of path elements."""
    schema = "_id string, _fill string, _d string"
    return spark.read.format("xml").option("rowTag", "path").schema(schema).load(path).select(F.col("_id").alias("id"), F.col("_fill").alias("fill"), F.col("_d").alias("d"))


def transcript(c: Column) -> tuple[Column, Column]:
    """Question and answer of a transcript with headings."""
    return X.section(c, "QUESTION SPOKEN TEXT:", "ANSWER SPOKEN TEXT:"), X.section(c, "ANSWER SPOKEN TEXT:", "\u0000")


def in_order(paths: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted paths by id, in their order; an error if one is missing."""
    spark = paths.sparkSession
    want = spark.createDataFrame(list(enumerate(wanted)), "ord int, id string")
    rows = want.join(paths, "id", "left")
    return rows.withColumn("d", F.when(F.col("d").isNull(), F.raise_error(F.concat(F.lit("no path "), "id"))).otherwise(F.col("d"))).select("ord", "id", "fill", "d")
