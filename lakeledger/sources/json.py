"""JSON readers.

Files with one JSON value (an object or an array of objects) are read whole:
one file is one task's work and must fit its memory. Spark splits JSON Lines
files like any text, so large inputs should come in that form.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import unnest

# Fixed value: source files of the whole-file readers, in any letter case.
JSON_FILES = "*.[jJ][sS][oO][nN]"


def _read_text(spark: SparkSession, path, lines: bool) -> DataFrame:
    """(file, block, value): text by line, or by file; ``block`` orders the splits of a file."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if lines:
        text = reader.text(path)
    else:
        text = reader.option("pathGlobFilter", JSON_FILES).text(path, wholetext=True)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def count_files(spark: SparkSession, path, lines: bool = False) -> int:
    """Number of files that the readers here would take; none if there is no such path."""
    try:
        # The listing that the reader has made anyway; nothing is read.
        return len(_read_text(spark, path, lines)._jdf.inputFiles())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def _is_array(text: Column) -> Column:
    return text.rlike(r"^\s*\[")


def _object(text: Column) -> Column:
    """The parsed JSON object; null for other or broken JSON."""
    return F.when(text.rlike(r"^\s*\{"), F.try_parse_json(text))


def _elements(text: Column) -> Column:
    """Texts of the records in one JSON text: array elements, or the value itself.

    The outer array is split as text, so only single records, never whole
    files, have to fit a VARIANT value. Null when an array cannot be read.
    """
    return F.when(_is_array(text), F.from_json(text, "array<string>")).otherwise(F.array(text))


def read_json_records(spark: SparkSession, path, lines: bool = False) -> DataFrame:
    """(file, block, position, text, record, is_broken) of every record under ``path``.

    (file, block, position) is the order of the records in the input.
    ``is_broken`` marks what cannot be used: in whole-file mode one row per
    unreadable file (broken JSON, or neither an object nor an array of
    objects), in lines mode one row per line that is no JSON object. Blank
    lines are no records.
    """
    source = _read_text(spark, path, lines)
    if lines:
        text = F.regexp_replace("value", r"^\s+|\s+$", "")
        parsed = source.select(
            "file",
            "block",
            F.monotonically_increasing_id().alias("position"),
            text.alias("text"),
        ).filter("text != ''")
        return parsed.withColumn("record", _object(F.col("text"))).withColumn(
            "is_broken", F.col("record").isNull()
        )
    parsed = source.withColumn("texts", _elements(F.col("value"))).withColumn(
        "records", F.transform("texts", _object)
    )
    bad = F.coalesce(F.exists("records", lambda r: r.isNull()), F.lit(True))
    entry = F.when(
        bad,
        F.array(
            F.struct(
                F.lit(None).cast("string").alias("text"),
                F.try_parse_json(F.lit(None).cast("string")).alias("record"),
            )
        ),
    ).otherwise(F.arrays_zip(F.col("texts").alias("text"), F.col("records").alias("record")))
    # Everything per file is computed below the explode, not once per record,
    # and the mark is read off the exploded row: a filter on it then stays above.
    whole = parsed.select("file", "block", entry.alias("entries"))
    return unnest(whole, "entries", ["file", "block"], "e").select(
        "file",
        "block",
        F.col("pos").cast("bigint").alias("position"),
        "e.text",
        "e.record",
        F.col("e.text").isNull().alias("is_broken"),
    )


def is_object(v: Column) -> Column:
    return F.schema_of_variant(v).startswith("OBJECT")


def read_documents(spark: SparkSession, path, load_ts: Column, lines: bool = False) -> DataFrame:
    """(record_content, load_ts): landing rows, one per record, outer arrays split.

    With ``lines`` every line is one JSON text, which may again be an array.
    Text that is not JSON fails the load.
    """
    source = _read_text(spark, path, lines).filter(F.length(F.trim("value")) > 0)
    unreadable = F.raise_error(F.concat(F.lit("not JSON: "), F.col("file")))
    texts = F.coalesce(_elements(F.col("value")), unreadable.cast("array<string>"))
    records = unnest(source.select(texts.alias("texts")), "texts", [], "text")
    return records.select(F.parse_json("text").alias("record_content"), load_ts.alias("load_ts"))


def read_json_typed(
    spark: SparkSession, path, schema=None, lines: bool = False, glob: str | None = JSON_FILES
) -> DataFrame:
    """Typed reader for objects or arrays of objects; unusable input is left out."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mode", "DROPMALFORMED")
    if not lines:
        reader = reader.option("multiLine", "true")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_control_dates(spark: SparkSession, path) -> DataFrame:
    """(event_date): distinct sorted dates of the first list in a control file.

    The file is one JSON object; only its first key counts, as written.
    """
    lists = F.from_json("value", "map<string,array<string>>")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.get(F.map_values(lists), F.lit(0)).alias("dates"))
        .select(F.explode("dates").alias("event_date"))
        .distinct()
        .orderBy("event_date")
    )
