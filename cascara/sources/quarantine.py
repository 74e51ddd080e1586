"""Landing files split by a verdict in one pass: rows that pass, and apart from them every malformed line and every row a
rule rejects, with the name of the rule and the file it came from.

One scan parses the lines, one column holds the verdict (``ok``, ``malformed`` or the first rule that rejects the row), and
one write deals the rows into a folder per verdict. Nothing is lost: the rows of all folders together are the lines that
landed. Rules look at one row; what needs several rows (duplicates) belongs to the cleaning chain.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascara.functions.columns import is_true, quoted
from cascara.operators.clean import Rule, rename_columns
from cascara.sources.files import read_csv

OK, MALFORMED = "ok", "malformed"
_LINE = "__line"


def split_landing(spark: SparkSession, path: str, schema: T.StructType, rules: Sequence[Rule], target: str,
                  renames: dict[str, str] | None = None, header: bool = True) -> str:
    """Write the lines below ``path`` to ``target``, one folder per verdict. A row that several rules reject is charged to the
    first; ``renames`` come before the rules, as in the cleaning chain."""
    rows = rename_columns(read_csv(spark, path, schema, header=header, corrupt_column=_LINE), renames or {})
    fields = [quoted(c) for c in rows.columns if c != _LINE]
    verdict = reduce(lambda rest, r: F.when(is_true(r.column()), r.name).otherwise(rest), reversed(list(rules)), F.lit(OK))
    verdict = F.when(F.col(_LINE).isNotNull(), MALFORMED).otherwise(verdict)
    # the line as it was, where it could not be parsed; else the row's values
    line = F.when(verdict != OK, F.coalesce(F.col(_LINE), F.to_json(F.struct(*fields))))
    tagged = rows.select(*fields, line.alias("line"), F.input_file_name().alias("source"), verdict.alias("verdict"))
    tagged.write.partitionBy("verdict").parquet(target)
    return target


def accepted(spark: SparkSession, target: str) -> DataFrame:
    """The rows that passed."""
    rows = spark.read.parquet(target)
    return rows.where(F.col("verdict") == OK).drop("verdict", "line", "source")


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """``(rule, source, line)`` of every line that did not."""
    rows = spark.read.parquet(target)
    return rows.where(F.col("verdict") != OK).select(F.col("verdict").alias("rule"), "source", "line")
