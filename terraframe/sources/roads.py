"""Road segments from headerless CSV text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G

# Positions of x1, y1, x2, y2 in a line of the road format, a fixed value.
COORDINATES = (2, 3, 5, 6)


# A field, quoted or not, up to the next comma or the end of the line.
FIELD = r'("[^"]*(?:""[^"]*)*"|[^,]*)(?:,|$)'


def _split(lines: DataFrame, line: str) -> DataFrame:
    """Fields ``f`` of CSV lines without an empty last one; quoted commas do not separate."""
    text, quoted = F.col(line), F.col(line).contains('"')
    # For quoted lines the pattern finds one more, empty, field at the end.
    found = F.when(quoted, F.regexp_extract_all(text, F.lit(FIELD), F.lit(1))).otherwise(F.split(text, ","))
    fields = lines.select(found.alias("f"), quoted.alias("q"))
    last_empty = F.col("q") | (F.element_at("f", -1) == "")
    kept = F.when(last_empty, F.slice("f", 1, F.size("f") - 1)).otherwise(F.col("f"))
    bare = F.transform(
        kept,
        lambda field: F.when(
            field.startswith('"'), F.replace(F.substring(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        ).otherwise(field),
    )
    return fields.select(F.when(F.col("q"), bare).otherwise(kept).alias("f"))


def parse_roads(lines: DataFrame, line: str = "value") -> DataFrame:
    """Segments ``(x1, y1, x2, y2, path, attrs)`` from a column of CSV lines.

    Other fields stay strings in ``attrs``, in their order, however many a line has;
    an empty last one is dropped. A bad or missing coordinate fails the job.
    """
    split = _split(lines, line)
    ends = [F.col("f")[at].cast("double").alias(name) for at, name in zip(COORDINATES, ("x1", "y1", "x2", "y2"))]
    attrs = F.filter("f", lambda _, at: ~at.isin(*COORDINATES)).alias("attrs")
    segments = split.select(*ends, attrs)
    return segments.withColumn("path", G.line(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))


def load_roads(spark: SparkSession, path: str) -> DataFrame:
    return parse_roads(spark.read.text(path))
