"""File scans. Every reader takes a schema or text; none infers types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from afterplay.functions.identity import ID_FIELDS, id_text
from afterplay.sources.documents import scan_array_document, scan_json_document, scan_keyed_document  # noqa: F401
from afterplay.sources.schemas import SCORE_CSV
from afterplay.sources.writers import write_counted

CORRUPT = "_corrupt"


def sealed(text: Column, seal: Column) -> Column:
    """The text as the first of two members of an object, the second being ``seal``, a hash of the text.

    Spark's parser stops after the first value it has read, and text can close the object early or
    add members to it. Only a text that is one value leaves exactly two members and ends in its own hash.
    """
    return F.concat(F.lit('{"_line":'), text, F.lit(',"_end":'), seal.cast("string"), F.lit("}"))


def has_sealed_keys(wrapped: Column) -> Column:
    return F.json_object_keys(wrapped) == F.array(F.lit("_line"), F.lit("_end"))


def is_one_value(text: Column) -> Column:
    """Whether all of a text is one JSON value."""
    seal = F.xxhash64(text)
    wrapped = sealed(text, seal)
    ends = F.get_json_object(wrapped, "$._end") == seal.cast("string")
    return F.coalesce(has_sealed_keys(wrapped) & ends, F.lit(False))


# Columns of a feature file that are never numbers.
TEXT_COLUMNS = ("player_id", "op_start", "op_end", "cp_start", "cp_end")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType = SCORE_CSV) -> DataFrame:
    """CSV with a header. A missing path fails when the scan is planned."""
    return spark.read.schema(schema).option("header", True).csv(path)


@dataclass(frozen=True)
class JsonLines:
    """Rows that parsed, and the text of the lines that did not."""

    rows: DataFrame
    malformed: DataFrame

    @classmethod
    def parse(cls, lines: DataFrame, schema: T.StructType) -> JsonLines:
        """Parse column ``value``; other columns of ``lines`` go along with the rows."""
        others = [c for c in lines.columns if c != "value"]
        parsed = _parsed(lines, schema)
        return cls(
            parsed.filter(_good()).select(*others, *_fields(schema)),
            parsed.filter(~_good()).select(*others, F.col("value").alias("line_text")),
        )


def _good() -> Column:
    """Whether all of a line is one value, and parsed."""
    whole = F.col("whole") & F.col(f"r.{CORRUPT}").isNull() & F.col("r._line").isNotNull()
    return F.coalesce(whole & (F.col("r._end") == F.col("seal")), F.lit(False))


def _is_id(field: T.StructField) -> bool:
    return field.name in ID_FIELDS and field.dataType == T.StringType()


def _fields(schema: T.StructType) -> list[Column]:
    """The fields of a parsed line. Ids become text; a zero or false that is no id becomes null."""
    out = []
    for field in schema:
        value = F.col(f"r._line.`{field.name}`")
        if _is_id(field):
            value = id_text(value, field.name)
        out.append(value.alias(field.name))
    return out


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    # as text, the number 0 and the text "0" would be the same
    typed = T.StructType([T.StructField(f.name, T.VariantType()) if _is_id(f) else f for f in schema])
    wide = T.StructType(
        [
            T.StructField("_line", typed),
            T.StructField("_end", T.LongType()),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"}
    seal = F.xxhash64("value")
    wrapped = sealed(F.col("value"), seal)
    return lines.withColumns(
        {"r": F.from_json(wrapped, wide, options), "whole": has_sealed_keys(wrapped), "seal": seal}
    )


def write_json_rows(lines: DataFrame, schema: T.StructType, path: str) -> dict[str, int]:
    """Write the rows that parsed to ``path`` and count ``records`` and ``malformed`` lines in the same pass."""
    others = [c for c in lines.columns if c != "value"]
    parsed = _parsed(lines.filter(F.trim("value") != ""), schema).select(*others, *_fields(schema), _good().alias("_is_good"))
    good = F.col("_is_good")
    return write_counted(parsed, path, {"records": good, "malformed": ~good}, good, drop=("_is_good",))


def scan_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> JsonLines:
    """One object per line. Bad lines are set aside instead of failing; blank lines are ignored."""
    return JsonLines.parse(spark.read.text(path).filter(F.trim("value") != ""), schema)


def scan_json_lines_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The first bad line fails the job."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    failure = F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).cast("boolean")
    return _parsed(lines, schema).filter(F.when(_good(), True).otherwise(failure)).select(*_fields(schema))


def first_json_lines(spark: SparkSession, path: str, schema: T.StructType, n: int = 5) -> DataFrame:
    """The good rows among the first ``n`` lines of a file; bad lines use up the quota.

    ``take`` reads splits in order and stops once it has ``n`` lines, so only these pass
    the driver. A path that does not exist gives no rows.
    """
    try:
        head = [(i, row.value) for i, row in enumerate(spark.read.text(path).take(n))]
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        head = []
    lines = spark.createDataFrame(head, "line bigint, value string")
    return JsonLines.parse(lines, schema).rows.orderBy("line")


def explode_keyed_document(
    documents: DataFrame, value_type: T.DataType, text: str = "document"
) -> DataFrame:
    """``{"1": {...}, "2": {...}}`` to rows ``(key, value)``.

    For documents that are column values. Each is parsed by one task;
    :func:`scan_keyed_document` reads large files by many.
    """
    keyed = F.from_json(F.col(text), T.MapType(T.StringType(), value_type))
    others = [c for c in documents.columns if c != text]
    return documents.select(*others, F.explode(keyed).alias("key", "value"))


def explode_matches(matches: DataFrame) -> DataFrame:
    """One row per team of a match."""
    return matches.select(
        F.col("key").alias("match_id"),
        *[F.col(f"value.{c}") for c in ("server", "official", "date", "duration", "mapId")],
        F.posexplode_outer("value.teams").alias("team", "t"),
    ).select("*", F.col("t.name").alias("team_name"), F.col("t.score").alias("team_score")).drop("t")


def explode_match_players(players: DataFrame) -> DataFrame:
    """One row per player of a match."""
    return players.select(
        F.col("key").alias("match_id"), F.posexplode("value").alias("slot", "p")
    ).select("match_id", "slot", "p.*")


TARGET_COLUMN = "churned"


def scan_features(spark: SparkSession, path: str) -> DataFrame:
    """A feature CSV with numbers where numbers belong; text that is no number gives null.

    A target written as true and false becomes 1 and 0.
    """
    raw = spark.read.option("header", True).csv(path)
    if TARGET_COLUMN in raw.columns:
        said = F.lower(F.trim(TARGET_COLUMN))
        target = F.when(said == "true", "1").when(said == "false", "0").otherwise(F.col(TARGET_COLUMN))
        raw = raw.withColumn(TARGET_COLUMN, target)
    return coerce_numeric(raw)


def coerce_numeric(df: DataFrame, keep: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    """Text columns to double, but for ids and window ends."""
    return df.select(
        *[
            F.col(name).try_cast("double").alias(name) if kind == "string" and name not in keep else F.col(name)
            for name, kind in df.dtypes
        ]
    )
