"""Readers and writers for the file formats of the corpus.

Readers keep a stable order (file, position) as columns, since files have none once
they are partitions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMENTARY = "struct<commentator:string,school:string,lang:string,type:string,text:string>"
RECORD = f"id string, source string, tradition string, darshana string, chapter int, section string, verse int, segment_id string, page int, verse_nums array<int>, text string, translator string, school string, theme_tag string, commentaries array<{COMMENTARY}>, comparative_notes array<string>"
TAGGED = "record_id string, source string, relationships array<struct<concept_a:string,concept_b:string,relation:string,school:string,confidence:string,evidence_quote:string>>"
EDGE = "edge_id string, concept_a string, concept_b string, relation string, school string, confidence string, evidence_quote string, source_record_id string, source_text string, tagged_from_file string"


def read_json_arrays(spark: SparkSession, path: str, schema: str = RECORD, skip: tuple[str, ...] = ()) -> DataFrame:
    """Records of files that hold one JSON array each: ``file, pos`` and the schema.

    Files whose root is no array, and broken files, give no row.
    """
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")
    if skip:
        raw = raw.where(~F.col("file").isin(*skip))
    v = F.try_parse_json("value")
    arrays = raw.where(F.schema_of_variant(v).startswith("ARRAY"))
    return arrays.select("file", F.posexplode(F.from_json("value", f"array<struct<{_colons(schema)}>>")).alias("pos", "r")).select("file", "pos", "r.*")


def _colons(schema: str) -> str:
    return ", ".join(":".join(p.strip().split(" ", 1)) for p in _split_top(schema))


def _split_top(schema: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]


def read_tagged_edges(spark: SparkSession, path: str, skip: tuple[str, ...] = ("test_verse.jsonl",)) -> DataFrame:
    """The edge table of tagged JSON lines: one row per relationship, numbered over all
    files in the order file, line, relationship, with the file it came from.

    Blank and malformed lines, lines without relationships and skipped files give no row.  Lines
    keep their place in a file by ``read_lines``; numbers are given by blocks, one count per
    file and line (:func:`numbered_edges`).
    """
    lines = read_lines(spark, path).where(~F.col("file").isin(*skip) & (F.trim("line") != ""))
    parsed = lines.select("file", "line_no", F.from_json("line", TAGGED).alias("t")).where("t.relationships is not null")
    return numbered_edges(parsed.select("file", "line_no", "t.record_id", "t.source", "t.relationships"))


def numbered_edges(tagged: DataFrame) -> DataFrame:
    """``edge_no, edge_id`` and the relationships of ``file, line_no, record_id, source, relationships``.

    The first number of each line comes from a running sum over the lines of its file and over
    the files, so only counts are sorted, never the edges.
    """
    n = tagged.withColumn("n", F.size("relationships").cast("bigint"))
    before = number_before(n, "file", "line_no", "n")
    e = before.select("file", "line_no", "record_id", "source", "first", F.posexplode("relationships").alias("pos", "r"))
    no = F.col("first") + F.col("pos") + 1
    return e.select(no.alias("edge_no"), F.format_string("edge_%06d", no).alias("edge_id"), "r.*", F.col("record_id").alias("source_record_id"), F.col("source").alias("source_text"), F.col("file").alias("tagged_from_file"))


def number_before(rows: DataFrame, file: str, line: str, n: str) -> DataFrame:
    """Add ``first``: the sum of ``n`` in all earlier files and in earlier lines of the file."""
    inside = Window.partitionBy(file, "_b").orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.withColumn("_b", F.floor(F.col(line) / F.lit(20_000)))
    sums = blocks.groupBy(file, "_b").agg(F.sum(n).alias("_n"))
    # one row per block of lines
    earlier = Window.orderBy(file, "_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(file, "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_carry"))
    d = blocks.withColumn("_r", F.coalesce(F.sum(n).over(inside), F.lit(0))).join(carry, [file, "_b"])
    return d.withColumn("first", F.col("_r") + F.col("_carry")).drop("_b", "_r", "_carry")


def write_jsonl(rows: DataFrame, path: str) -> None:
    """JSON lines, null members kept, one file per part."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(rows: DataFrame, path: str, order: str) -> None:
    """One JSON array of all rows in order, a member per line.  ``order`` is unique.

    The rows are sorted by all tasks; only the last step, which streams the lines into the one
    file that an array needs, is a single task.  For large tables take :func:`write_jsonl`.
    """
    ends = rows.agg(F.min(order).alias("a"), F.max(order).alias("b")).first()
    body = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    at = F.col(order)
    line = F.concat(F.when(at == F.lit(ends["a"]), "[").otherwise(" "), body, F.when(at == F.lit(ends["b"]), "]").otherwise(","))
    lines = rows.select(at.alias("_o"), line.alias("value")).sort("_o").coalesce(1).select("value")
    if ends["a"] is None:
        lines = rows.sparkSession.createDataFrame([("[]",)], "value string").coalesce(1)
    lines.write.mode("overwrite").text(path)


def file_status(spark: SparkSession, path: str) -> DataFrame:
    """Per file: does it parse, and is its root an array?"""
    v = F.try_parse_json("value")
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), v.alias("v"))
    return raw.select("file", F.when(F.col("v").isNull(), "broken").when(F.schema_of_variant("v").startswith("ARRAY"), "array").otherwise("other").alias("status"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped and malformed ones dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segment dictionaries ``{key: text}``: ``file, key, pos, text``; the last of repeated
    keys wins, as in JSON."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.from_json("value", "map<string,string>").alias("m"))
    e = raw.select("file", F.posexplode(F.map_entries("m")).alias("pos", "e")).select("file", F.col("e.key").alias("key"), "pos", F.col("e.value").alias("text"))
    return e.groupBy("file", "key").agg(F.max(F.struct("pos", "text")).alias("x")).select("file", "key", "x.pos", "x.text")


def content_segments(segments: DataFrame, least: int = 10) -> DataFrame:
    """Segments of running text: the key's last part doesn't start with ``0.`` and the
    text has at least ``least`` characters."""
    part = F.element_at(F.split("key", ":"), -1)
    return segments.where(~part.startswith("0.") & (F.length(F.trim("text")) >= least))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with their number: ``file, line_no, line``."""
    raw = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")
    return raw.select("file", F.posexplode(F.split("value", "\n", -1)).alias("line_no", "line"))


def read_review(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def write_review(rows: DataFrame, path: str) -> None:
    """A sheet with an empty column ``correct`` to fill in."""
    rows.withColumn("correct", F.lit("")).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def review_precision(sheet: DataFrame) -> DataFrame:
    """Marked rows, right ones and the precision; case and outer spaces don't matter."""
    m = F.upper(F.trim(F.coalesce("correct", F.lit(""))))
    g = sheet.agg(F.count_if(m.isin("Y", "N")).alias("n_marked"), F.count_if(m == "Y").alias("n_right"))
    return g.select("n_marked", "n_right", F.when(F.col("n_marked") > 0, F.col("n_right") / F.col("n_marked")).alias("precision"))


def append_new(rows: DataFrame, path: str, key: str) -> None:
    """Append the rows whose key the table doesn't hold yet; safe to repeat.  Null is a key, too."""
    spark = rows.sparkSession
    fresh = rows.dropDuplicates([key])
    try:
        have = spark.read.parquet(path).select(F.col(key).alias("_held"))
        fresh = fresh.join(have, F.col(key).eqNullSafe(F.col("_held")), "left_anti")
    except Exception as e:  # the first write finds no table
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)


def write_version(rows: DataFrame, base: str) -> str:
    """Write a new version beside the old ones and return its path: a table that is being
    read can't be overwritten."""
    path = f"{base}/version={uuid.uuid4().hex}"
    rows.write.parquet(path)
    return path
