"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

DataFrame operations only.

1. Words are runs of letters and digits in lower case.  A template's
   shingles are its runs of five words; a template of fewer words is one
   shingle of its own length.
2. A template's shingles are cut into blocks of at most ``MAX_BLOCK``.
   A block's class is the smallest power of two that holds it.  For every
   class the text has windows of twice the class, moving by the class, so
   a whole occurrence of a block always lies in one window.
3. Only shingles that occur in some template can add to a containment, so
   a join with the templates' shingles leaves the hits of each document,
   and a window is the set of its hits.  Windows without any vanish;
   almost all text does.
4. Both sides are MinHashed, one value to a band.  A block met with
   ``threshold`` containment has a Jaccard of at least ``least_jaccard``
   with its window; ``bands_for`` gives the bands that leave a chance of
   1e-6 to miss it.
5. Retrieved pairs of a document and a template are verified, and no
   others: the share of the template's distinct shingles that the document
   holds, in integers.

Null and empty texts match nothing; rows of one id are one document, and so
are the rows without an id, which keep their matches under a null id; a template met several times in a document is one row, from the
first to the last word of its shingles; empty tables (documents or
templates) give an empty result; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import saved, text_of
from tillscope.llm.license_texts import LICENSES

SHINGLE = 5
MAX_BLOCK = 64
THRESHOLD = 75  # per cent


def least_jaccard(threshold: int = THRESHOLD) -> float:
    """A block fills more than half its class, its window holds two classes: the block's share in the worst window."""
    return threshold / 100 * 0.5 / 2


def bands_for(jaccard: float, miss: float = 1e-6) -> int:
    """Bands of one value that leave at most the chance ``miss`` to overlook sets of that Jaccard."""
    return math.ceil(math.log(miss) / math.log(1 - jaccard))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, in order."""
    n = F.size(words) - (width - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, width)))) \
        .otherwise(F.array().cast("array<long>"))


def template_shingles(spark, templates: dict[str, str]) -> DataFrame:
    """license, width, at, h, n_shingles, block, size: a row for each distinct shingle of each template."""
    rows = spark.createDataFrame(list(templates.items()), "license string, text string").select("license", _words(F.col("text")).alias("w"))
    rows = rows.where(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
    hashes = F.coalesce(*[F.when(F.col("width") == k, _shingles(F.col("w"), k)) for k in range(1, SHINGLE + 1)])
    one = rows.select("license", "width", F.array_distinct(hashes).alias("hs")).select(
        "license", "width", F.size("hs").cast("long").alias("n_shingles"), F.posexplode("hs").alias("at", "h"))
    block = F.floor(F.col("at") / MAX_BLOCK).cast("int")
    fill = F.least(F.col("n_shingles") - block * MAX_BLOCK, F.lit(MAX_BLOCK))
    return one.withColumn("block", block).withColumn("size", F.pow(F.lit(2.0), F.ceil(F.log2(fill.cast("double")))).cast("int"))


def _minima(bands: int) -> list[Column]:
    return [F.min(F.xxhash64(F.lit(k), "h")).alias(f"m{k}") for k in range(bands)]


def _bands(bands: int) -> Column:
    return F.explode(F.array(*[F.xxhash64(F.lit(k), "size", f"m{k}") for k in range(bands)])).alias("band")


def _hits(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, width, at, h: the places where a document holds a shingle of some template."""
    def placed(width: int) -> Column:
        return F.transform(_shingles(F.col("w"), width), lambda h, i: F.struct(F.lit(width).alias("width"), i.alias("at"), h.alias("h")))

    words = docs.select("doc_id", _words(F.col("text")).alias("w"))
    return words.select("doc_id", F.explode(F.concat(*map(placed, _widths(known)))).alias("x")).select("doc_id", "x.*").join(
        known.select("width", "h").distinct(), ["width", "h"]).select("doc_id", "width", "at", "h").distinct()


def _widths(known: DataFrame) -> list[int]:
    """Widths of the templates' shingles, five at most; without templates one that meets nothing."""
    return sorted(r["width"] for r in known.select("width").distinct().collect()) or [SHINGLE]


def _same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"])


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, threshold: int = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, n_shared, n_shingles, containment, first_word, last_word (from 0) of every verified match."""
    known = saved(template_shingles(docs.sparkSession, LICENSES if templates is None else templates), "templates")
    bands = bands_for(least_jaccard(threshold))
    hits = saved(_hits(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), known), "license-hits")

    # retrieval: windows of every class that the shingle belongs to, met with the templates' blocks by bands
    classes = known.select("width", "h", "size").distinct()
    window = F.floor(F.col("at") / F.col("size"))
    windows = hits.join(classes, ["width", "h"]).select("doc_id", "h", "size", F.explode(F.array(window - 1, window)).alias("window")).groupBy(
        "doc_id", "size", "window").agg(*_minima(bands)).select("doc_id", "size", _bands(bands)).select("doc_id", "band").distinct()
    blocks = known.groupBy("license", "block", "size").agg(*_minima(bands)).select("license", _bands(bands)).distinct()
    retrieved = saved(windows.join(blocks, "band").select("doc_id", "license").distinct(), "license-candidates")

    # verification of the retrieved pairs; a document's hits are first reduced to one row a shingle
    places = hits.groupBy("doc_id", "width", "h").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    held = retrieved.join(places, _same_document(retrieved, places)).select(retrieved["doc_id"], "license", "width", "h", "first", "last").join(
        known.select("license", "n_shingles", "width", "h"), ["license", "width", "h"]).groupBy("doc_id", "license", "n_shingles").agg(
        F.count("*").alias("n_shared"), F.min("first").alias("first_word"), (F.max("last") + F.max("width") - 1).alias("last_word"))
    return held.where(F.col("n_shared") * 100 >= F.col("n_shingles") * threshold).select(
        "doc_id", "license", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
        F.col("first_word").cast("int").alias("first_word"), F.col("last_word").cast("int").alias("last_word"))


def oracle_sql() -> str:
    """The same matches by exact containment, for DuckDB."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in LICENSES.items())
    split = r"[x FOR x IN regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+') IF x <> '']"
    return f"""
WITH t AS (SELECT license, {split.format("text")} AS w FROM (VALUES {values}) v(license, text)),
ts AS (SELECT license, least(len(w), 5) AS width, w FROM t WHERE len(w) > 0),
known AS (SELECT DISTINCT license, width, array_to_string(w[i:i + width - 1], ' ') AS s
          FROM (SELECT license, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM ts)),
sizes AS (SELECT license, count(*) AS n_shingles FROM known GROUP BY license),
d AS (SELECT doc_id, {split.format("coalesce(text, '')")} AS w FROM documents),
hits AS (SELECT DISTINCT doc_id, width, i - 1 AS place, array_to_string(w[i:i + width - 1], ' ') AS s
         FROM (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
               FROM d, (SELECT DISTINCT width FROM known)) x)
SELECT doc_id, license, count(DISTINCT s) AS n_shared, n_shingles, count(DISTINCT s) / n_shingles AS containment,
       CAST(min(place) AS INTEGER) AS first_word, CAST(max(place) + max(width) - 1 AS INTEGER) AS last_word
FROM hits JOIN known USING (width, s) JOIN sizes USING (license)
GROUP BY doc_id, license, n_shingles
HAVING count(DISTINCT s) * 100 >= n_shingles * {THRESHOLD}"""
