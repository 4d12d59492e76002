"""Document fingerprints by SpotSigs, in DataFrame operations only.

A signature starts at a common word (an anchor) and chains the next
``CHAIN`` content words, leaving out common words between them.  The start
of a text counts as an anchor too.  Where a stretch without listed anchors
goes on for more than ``LONELY`` content words (other languages, code,
tables), the content words from there to the next anchor chain by
themselves, one in ``EVERY``, chosen by a hash; the chosen word belongs to
the signature.  This is decided from place to place, so a changed word
changes the signatures around it and no others.  A document's fingerprint
is the set of its signature hashes (64 bits), written as sorted
hexadecimal; a text with no chain but that of its start also has its own
hash as a signature, without any chain it has that one alone; the empty
text has none.

Sets are compared by Jaccard.  Two sets can only reach a likeness t if the
smaller is at least t times the larger, so ``near_pairs`` deals sets out by
length and holds a set against its own and the next length partition only,
through signatures of its rare prefix; ``likeness`` prunes by length too.

Null texts count as empty; two empty sets are alike (1), an empty and
another are not (0).  Rows are ordered by descending id, then text, null
ids last; a single document follows itself; rows that repeat an id follow
one another in the order of their texts; an empty table gives an empty
result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import saved, text_of

CHAIN = 2
#: content words behind an anchor beyond which words chain by themselves, and one in how many of them
LONELY, EVERY = 10, 4

# fixed values: frequent function words of English, German, French and Spanish; the first of each language are anchors
ANCHORS = (
    "a an the is was are be to of and "
    "der die das ein eine ist und zu von den "
    "le la les un une est et de des pour "
    "el los las en y que con por para del"
).split()
COMMON = ANCHORS + (
    "in that this it for with by from as on or at he she they not have has had were "
    "im mit dem des sich auf nicht auch für als "
    "du par sur qui dans pas plus au ce "
    "se su al lo como es no una"
).split()

_SEP = r"[^\p{L}\p{N}]+"
_WORD = r"[\p{L}\p{N}]+"
_START = "\x02"  # stands for the start of a text
_SKIP = rf"(?:{_SEP}(?:(?:{'|'.join(COMMON)}){_SEP})*+)"
_ANCHOR = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(ANCHORS)})(?![\p{{L}}\p{{N}}])"
_CHAINS = rf"(?<![\p{{L}}\p{{N}}])(?=((?:{_START}|{'|'.join(ANCHORS)})(?:{_SKIP}{_WORD}){{{CHAIN}}}))"

#: documents in one ordered bucket, and splits on each of two levels
PER_BUCKET, MAX_SPLITS = 500, 256


def _own_chains(text: Column) -> Column:
    """Signature hashes of the chains that stretches without listed anchors give by themselves."""
    long_enough = lambda s: F.char_length(s) > 2 * (LONELY + CHAIN)  # noqa: E731 a word and its separator have two characters at least
    stretches = F.filter(F.split(text, _ANCHOR), long_enough)
    content = F.transform(stretches, lambda s: F.filter(F.split(s, _SEP), lambda w: (w != "") & ~w.isin(COMMON)))

    def chains(words: Column) -> Column:
        runs = F.transform(F.slice(words, LONELY + 1, F.greatest(F.size(words) - (LONELY + CHAIN), F.lit(0))),
                           lambda w, i: F.struct(w.alias("w"), F.slice(words, i + (LONELY + 1), CHAIN + 1).alias("run")))
        return F.transform(F.filter(runs, lambda r: F.pmod(F.xxhash64(r["w"]), F.lit(EVERY)) == 0), lambda r: F.xxhash64(F.lit("own"), r["run"]))

    return F.flatten(F.transform(content, chains))


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted distinct signature hashes of the column ``text`` as ``out``."""
    none = F.array().cast("array<bigint>")
    chains = F.regexp_extract_all(F.concat(F.lit(f"{_START} "), F.lower(text)), F.lit(_CHAINS), F.lit(1))
    chained = df.withColumn(out, chains).withColumn("_own", _own_chains(F.lower(text)))
    listed = F.exists(out, lambda s: ~s.startswith(_START))
    whole = F.when(listed | (F.size("_own") > 0), none).otherwise(F.array(F.xxhash64(text)))
    hashed = F.transform(out, lambda s: F.xxhash64(F.regexp_replace(s, _SKIP, " ")))
    return chained.withColumn(out, F.when(F.col(text) == "", none).otherwise(
        F.sort_array(F.array_distinct(F.concat(hashed, "_own", whole))))).drop("_own")


def fingerprint(signatures: Column | str) -> Column:
    """The set as text: sixteen hexadecimal digits for each signature, in the order of the signed numbers."""
    return F.array_join(F.transform(signatures, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def likeness(a: str, b: str, floor: float = 0.0) -> Column:
    """Jaccard of two signature sets; 0 for sets whose lengths alone keep it below ``floor``."""
    na, nb = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    return F.when((na == 0) & (nb == 0), 1.0).when(F.least(na, nb) < F.greatest(na, nb) * floor, 0.0).otherwise(
        common / (na + nb - common))


def near_pairs(sets: DataFrame, threshold: float = 0.75, id_col: str = "doc_id", set_col: str = "signatures") -> tuple[DataFrame, DataFrame]:
    """(members, pairs): every id with the smallest id of its equal sets (class), and the pairs (a, b, near) of classes
    whose sets reach the threshold.  Empty sets pair with nothing."""
    named = sets.select(F.col(id_col).alias("id"), F.col(set_col).alias("s")).where(F.size("s") > 0).withColumn(
        "h", F.xxhash64("s", F.size("s")))
    classes = saved(named.groupBy("h", "s").agg(F.min("id").alias("class")), "spot-classes")
    members = named.join(classes, ["h", "s"]).select("id", "class")
    freq = classes.select(F.explode("s").alias("sig")).groupBy("sig").agg(F.count("*").alias("freq"))
    n = F.size("s")
    # a pair at the threshold shares a signature among each one's rarest n - ceil(t * n) + 1
    ranked = classes.select("class", n.alias("n"), F.explode("s").alias("sig")).join(freq, "sig").withColumn(
        "k", F.row_number().over(Window.partitionBy("class").orderBy("freq", "sig")))
    prefix = ranked.where(F.col("k") <= F.col("n") - F.ceil(F.col("n") * threshold) + 1).withColumn(
        "part", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / threshold))))
    prefix = saved(prefix.select("class", "n", "sig", "part"), "spot-prefixes")
    x = prefix.select(F.col("class").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    y = prefix.select(F.col("class").alias("b"), F.col("n").alias("nb"), "sig", "part")
    pairs = x.join(y, ["sig", "part"]).where((F.col("na") <= F.col("nb")) & (F.col("a") != F.col("b")) & (
        F.col("na") >= F.col("nb") * threshold)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = classes.select("class", "s")
    both = pairs.join(sides.select(F.col("class").alias("a"), F.col("s").alias("sa")), "a").join(
        sides.select(F.col("class").alias("b"), F.col("s").alias("sb")), "b")
    return members, both.withColumn("near", likeness("sa", "sb", threshold)).where(F.col("near") >= threshold).select("a", "b", "near")


def _buckets(ids: DataFrame) -> tuple[Column, Column, Column]:
    """Of a column ``ord``: its bucket (ranges of ids, ascending), its bucket's largest id, the next bucket up that holds rows.

    The bounds come from quantiles over all ids; at most ``MAX_SPLITS``
    squared numbers reach the driver, however many documents.
    """
    n = ids.count()
    per_level = max(1, min(MAX_SPLITS, round((n / PER_BUCKET) ** 0.5)))
    total = per_level * per_level
    probs = [i / total for i in range(1, total)]
    splits = list(ids.agg(F.percentile_approx("ord", probs, 10_000).alias("q")).first()["q"] or []) if probs else []
    literal = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    below = lambda s: F.size(F.filter(s, lambda x: x <= F.col("ord")))
    coarse = below(literal(splits[per_level - 1::per_level], "array<bigint>"))
    fine = literal([splits[i:i + per_level - 1] for i in range(0, total, per_level)], "array<array<bigint>>")
    bucket = coarse * per_level + below(F.element_at(fine, coarse + 1))
    largest = {r["b"]: r["m"] for r in ids.groupBy(bucket.alias("b")).agg(F.max("ord").alias("m")).collect()}
    held = sorted(largest)
    up = dict(zip(held, held[1:] + held[:1]))  # the highest goes around to the lowest
    by = lambda d, kind: F.element_at(literal([d.get(b) for b in range(total)], kind), F.col("bucket") + 1)
    return bucket, by(largest, "array<bigint>"), by(up, "array<int>")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", floor: float = 0.0) -> DataFrame:
    """Every document's fingerprint beside that of its edited text: the last third replaced by the start of the next
    document (descending ids, around the end).

    Texts move once: rows are dealt out by ranges of ids, and the largest of
    each range is also dealt to the range above it, whose last document it
    follows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn(
        "ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63).cast("long")))
    bucket, largest, up = _buckets(rows.select("ord"))
    signed = with_signatures(rows.withColumn("bucket", bucket), "text", "signatures")
    copies = F.when(F.col("ord") == largest, F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ghost")),
                                                     F.struct(up.alias("b"), F.lit(1).alias("ghost")))) \
        .otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("ghost"))))
    dealt = signed.withColumn("_at", F.explode(copies)).select("doc_id", "text", "ord", "signatures", "_at.b", "_at.ghost")
    order = Window.partitionBy("b").orderBy("ghost", F.desc("ord"), "text")
    paired = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("signatures").over(order).alias("next_signatures")).where("ghost = 0")
    n = F.char_length("text")
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = paired.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int")),
                           F.substring(F.col("next_text"), F.lit(1), third)))
    return with_signatures(edited, "edited", "edited_signatures").select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"), fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures", floor).alias("near_edited"),
        likeness("signatures", "next_signatures", floor).alias("near_next"),
        F.size("signatures").alias("n_signatures"))
