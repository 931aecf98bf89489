"""Intake of the conversion list: rows that can be read as they are meant, and the others with what is wrong.

The report itself counts an unreadable cell as missing and goes on, as it must agree with the list it is given. Intake is
for whoever delivers the list: nothing is dropped without a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import to_code
from ..operators.conversion import CODE_COLUMNS
from .conversion_list import LIST_COLUMNS

#: The column in which Spark's CSV reader keeps a line with too few or too many cells.
CORRUPT = "_corrupt_record"
NUMBER = r"^[+-]?[0-9]+([.][0-9]*)?$"

MALFORMED = "the line has not one cell per column"
NO_NUMBER = "no number"
NOT_WHOLE = "not a whole number"
TOO_LARGE = "does not fit"
NO_DATE = "no date"


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """The list's CSV as text, line by line; lines of another shape are kept whole in ``_corrupt_record``."""
    columns = spark.read.option("header", True).csv(path).columns
    missing = [c for c in LIST_COLUMNS if c not in columns]
    if missing:
        raise ValueError(f"the list lacks the columns {', '.join(missing)}")
    schema = ", ".join(f"`{c}` string" for c in (*columns, CORRUPT))
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    reader = reader.option("columnPruning", False)  # else lines are only cut as far as columns are read
    return reader.schema(schema).csv(path).select(*LIST_COLUMNS, CORRUPT)


def _problem(name: str, reason: Column) -> Column:
    """The cell and what is wrong with it, or NULL."""
    value = F.col(name).cast("string").alias("value")
    return F.when(reason.isNotNull(), F.struct(F.lit(name).alias("column_name"), value, reason.alias("reason")))


def _code_reason(name: str, kind: str) -> Column:
    text = F.col(name).cast("string")
    whole = F.regexp_extract(text, r"[.]([0-9]*)$", 1).rlike("^0*$")
    wrong = F.when(~text.rlike(NUMBER), NO_NUMBER).when(~whole, NOT_WHOLE).otherwise(TOO_LARGE)
    return F.when(text.isNotNull() & to_code(text, kind).isNull(), wrong)


def problems(raw: DataFrame) -> Column:
    """All that is wrong with a delivered row, as an array of ``(column_name, value, reason)``."""
    cells = [_problem(name, _code_reason(name, kind)) for name, kind in CODE_COLUMNS.items()]
    if raw.schema["Date"].dataType.typeName() == "string":
        unread = F.col("Date").isNotNull() & F.col("Date").try_cast("date").isNull()
        cells.append(_problem("Date", F.when(unread, F.lit(NO_DATE))))
    if CORRUPT in raw.columns:
        whole = _problem(CORRUPT, F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)))
        return F.when(F.col(CORRUPT).isNotNull(), F.array(whole)).otherwise(F.array_compact(F.array(*cells)))
    return F.array_compact(F.array(*cells))


@dataclass(frozen=True)
class Intake:
    """``typed``: the good rows, with numbers and dates. ``rejected``: the others, as delivered, with their problems."""

    typed: DataFrame
    rejected: DataFrame

    def report(self) -> DataFrame:
        """One row per bad cell and delivered line: ``(line, column_name, value, reason, n_rows)``."""
        cells = self.rejected.select("line", F.inline("problems"))
        return cells.groupBy("line", "column_name", "value", "reason").agg(F.count(F.lit(1)).alias("n_rows"))

    def counts(self) -> DataFrame:
        """One row: how many rows were good and how many were not; together as many as were delivered."""
        parts = [df.select(F.lit(flag).alias("is_good")) for df, flag in ((self.typed, True), (self.rejected, False))]
        rows = parts[0].union(parts[1])
        good = F.count_if("is_good").alias("typed_rows")
        return rows.agg(F.count(F.lit(1)).alias("delivered_rows"), good, F.count_if(~F.col("is_good")).alias("rejected_rows"))


def take_in(raw: DataFrame, path: str) -> Intake:
    """Split delivered rows in one pass: they are written once, below ``path``, each kind in its folder."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in LIST_COLUMNS]
    line = F.concat_ws(",", *cells)
    if CORRUPT in raw.columns:
        line = F.coalesce(CORRUPT, line)
    marked = raw.withColumn("problems", problems(raw)).select(*LIST_COLUMNS, "problems", line.alias("line"))
    stored = marked.withColumn("is_good", F.size("problems") == 0)
    stored.write.mode("overwrite").partitionBy("is_good").parquet(path)
    written = raw.sparkSession.read.schema(stored.schema).parquet(path)
    codes = {name: to_code(F.col(name).cast("string"), kind) for name, kind in CODE_COLUMNS.items()}
    typed = written.filter("is_good").select(*LIST_COLUMNS)
    typed = typed.withColumns({**codes, "Date": F.col("Date").cast("date")})
    return Intake(typed, written.filter("not is_good").drop("is_good"))
