"""CSV export of a table, written by the executors (no driver round trip).

Text comes back as it went out: blanks at either end stay, line breaks,
carriage returns and zero bytes are written as backslash escapes (so a
record is one line and files stay splittable), a backslash is doubled,
and NULL is ``\\N``, which no escaped text can equal.  Timestamps keep
microseconds.  Every task writes its own part files.

As text a table takes several times its disk, most of it repeated; with
``compression="gzip"`` part files are compressed (Silver: a seventh of the
text).  One task reads such a file whole, so it ends after
``COMPRESSED_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
NULL_TOKEN = "\\N"
ESCAPES = {"\n": "\\n", "\r": "\\r", "\0": "\\0"}
COMPRESSED_ROWS = 1_000_000  # of a compressed part file, which cannot be split for reading

_OPTIONS = {
    "header": "true",
    "timestampFormat": TIMESTAMP_FORMAT,
    "timestampNTZFormat": TIMESTAMP_FORMAT,
    "nullValue": NULL_TOKEN,
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, written in ESCAPES.items():
        out = F.replace(out, F.lit(raw), F.lit(written))
    return out


def _restored(text: Column) -> Column:
    """Undo ``_escaped``: between doubled backslashes, an escape is what it says."""
    def part(p: Column) -> Column:
        for raw, written in ESCAPES.items():
            p = F.replace(p, F.lit(written), F.lit(raw))
        return p

    whole = F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)  # most texts have no escape


def _texts(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write with a header; the empty string is written quoted, NULL as the null token."""
    packed = {"compression": compression, "maxRecordsPerFile": COMPRESSED_ROWS} if compression else {}
    _texts(df, _escaped).write.mode(mode).options(**_OPTIONS, **packed).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _texts(spark.read.schema(schema).options(**_OPTIONS).option("emptyValue", "").option("mode", "FAILFAST").csv(path), _restored)
