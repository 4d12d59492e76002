"""Near-duplicate documents by min-max hashing.

1. Shingles.  A text becomes the set of 64-bit hashes of its distinct
   five-word shingles.  Documents with equal sets form a class and are
   represented by the row with the smallest id (a partial aggregate: a
   class of any size crosses the shuffle as a few rows).  Classes are
   numbered; links and components are between these numbers, so rows that
   repeat an id with other text are in classes of their own.
2. Signatures.  Under each of ``PERMUTATIONS`` permutations both the
   smallest and the largest value are kept, so half the hash evaluations
   of plain MinHash give the same number of values.  Bands of two
   permutations (four values) meet with probability s**4; with 40 bands a
   link at s = 0.75 is missed with probability (1 - 0.75**4)**40 < 1e-6.
   This holds for large sets; on small ones a permutation's minimum and
   maximum depend on each other: sets of 3 and 4 shingles at 0.75 agree in
   both with 0.5, in a band with 0.25, and are missed with 0.75**40 = 1e-5.
3. Stars.  In every band bucket the representatives are held against one
   hub of the bucket.  Pairs that look alike at all join into clusters;
   each member's nearest hubs are confirmed and join it into components.
4. Clusters.  Where a cluster holds several components, all pairs between
   them are compared inside tasks: members are dealt out in blocks, and
   every two blocks that can hold such a pair meet.  A task gives back one
   link for each two components it joins, so a large family of texts just
   under the threshold costs comparisons but no rows.
   Rest.  Pairs of one bucket in different clusters are held against the
   signatures within the join, and those that look alike are confirmed.
   So no link between different components is lost, and no group of near
   copies is expanded into all its pairs.
5. Confirmation.  A link counts if its two texts, whole, meet the
   threshold in exact integer arithmetic on their shingle sets.  A text is
   cut into its set once, whatever the number of its pairs, and the sets of
   a pair meet in one row of a join, never in a batch of many.

Null and empty texts and texts without words have no shingles and link
with nothing; a text of one to four words is one shingle; every row is a
document of its own, also where it repeats an id, with or without its
text; ids are integers; ties go to the smallest id, null ids last; an
empty table gives an empty result; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import map_arrow, map_texts, saved, steps, text_of
from tillscope.llm.components import components

SHINGLE = 5
BANDS, PER_BAND = 40, 2
PERMUTATIONS = BANDS * PER_BAND
#: signatures agree in 160 values; a link at 0.75 falls under this share with probability < 1e-6
LOOKS_NEAR = 0.57
#: pairs of a star that agree in this share belong to one cluster
LOOKS_ALIKE = 0.45
#: of one bit of every signature value at most so many differ in a link (expected 20, deviation 4.2; six deviations)
MAX_BITS = 46
TRY_HUBS = 2
#: members of a cluster that a block holds
BLOCK = 256
#: the hub of a bucket is its smallest id after an exclusive or with this, so that it is not always the same end of the ids
HUB_ORDER = 0x5A5A5A5A5A5A5A5
#: word hashes remembered by a worker
MAX_WORDS = 100_000
#: ids may be broadcast up to this many (8 bytes each); beyond, they are joined by a shuffle
BROADCAST_IDS = 2_000_000

_random = np.random.default_rng(20_260_101)
_FACTORS = _random.integers(1, 2**63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, PERMUTATIONS, np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier that chains word hashes


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _WordHashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z only, and \x20 \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > MAX_WORDS:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, len(h) if len(h) < SHINGLE else 0, np.uint64)
    for k in range(n):
        out = (out ^ h[k:k + len(out)]) * _STEP
        out ^= out >> np.uint64(29)
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """The smallest values, then the largest, one of each per permutation."""
    lo = np.full(PERMUTATIONS, 2**64 - 1, np.uint64)
    hi = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(s), 4096):
        v = s[at:at + 4096, None] * _FACTORS + _SHIFTS
        v ^= v >> np.uint64(32)
        v *= _STEP
        np.minimum(lo, v.min(0), out=lo)
        np.maximum(hi, v.max(0), out=hi)
    return np.r_[lo, hi]


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, from both values of its permutations."""
    lo, hi = sig[:PERMUTATIONS].reshape(BANDS, PER_BAND), sig[PERMUTATIONS:].reshape(BANDS, PER_BAND)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP
    for k in range(PER_BAND):
        for v in (lo[:, k], hi[:, k]):
            key = (key ^ v) * _STEP
            key ^= key >> np.uint64(31)
    return key.view(np.int64)


def bits(sig: np.ndarray) -> np.ndarray:
    """One bit of every signature value, packed into 64-bit numbers."""
    return np.packbits((sig >> np.uint64(50) & np.uint64(1)).astype(np.uint8).reshape(-1, 32), axis=1, bitorder="little").view("<u4").ravel().astype(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit name of the set), bands, sketch (a byte of every signature value), bits (a bit of each)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            sets = [shingles(t) for t in texts]
            sigs = [signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([None if g is None else band_keys(g) for g in sigs], pa.list_(pa.int64())),
                 pa.array([None if g is None else (g >> np.uint64(40)).astype(np.uint8).tobytes() for g in sigs], pa.binary()),
                 pa.array([None if g is None else bits(g) for g in sigs], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_id", "bands", "sketch", "bits"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, task, f"doc_id {id_type}, n_shingles long, set_id binary, bands array<long>, sketch binary, bits array<long>", id_col, text_col)


def looks_near(pairs: DataFrame, reps: DataFrame, least: float = LOOKS_NEAR) -> DataFrame:
    """``pairs`` (a, b) whose signatures agree in enough values, with their share as ``near``."""
    side = reps.select("rep", "n_shingles", "sketch")
    both = pairs.join(side.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("ka")), "a") \
        .join(side.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("kb")), "b") \
        .where((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 75))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("ka", "kb"))
            near = (x == y).mean(1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near)], ["a", "b", "near"]).filter(
                pa.array(near >= least))

    kind = pairs.schema["a"].dataType.simpleString()
    return map_arrow(both.select("a", "b", "ka", "kb"), task, f"a {kind}, b {kind}, near double")


class Texts(NamedTuple):
    """The texts of numbered classes: ``docs`` (row, text) and ``classes`` (rep, row)."""

    docs: DataFrame
    classes: DataFrame

    def of(self, reps: DataFrame) -> DataFrame:
        """(rep, text) of ``reps`` (rep); their rows are broadcast if their counted number allows it, else shuffled."""
        rows = saved(reps.join(self.classes, "rep").select("rep", "row"), "wanted-rows")
        return self.docs.join(F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows, "row").select("rep", "text").dropDuplicates(["rep"])


def shingle_sets(texts: DataFrame) -> DataFrame:
    """rep, hashes (the whole set of a text)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, some in steps(batches):
            for i, text in enumerate(some):  # a set is several times its text: one at a time
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([shingles(text).view(np.int64)], pa.list_(pa.int64()))], ["doc_id", "hashes"])

    return map_texts(texts, task, f"doc_id {dict(texts.dtypes)['rep']}, hashes array<bigint>", "rep", "text").withColumnRenamed("doc_id", "rep")


def confirmed(pairs: DataFrame, texts: Texts) -> DataFrame:
    """``pairs`` (a, b) whose whole texts meet the threshold: 100 * common >= 75 * union."""
    pairs = saved(pairs.select("a", "b"), "pairs")
    sets = saved(shingle_sets(texts.of(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct())), "sets")
    both = pairs.join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y")), "b").join(
        sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x")), "a")
    common = both.select("a", "b", (F.size("x") + F.size("y")).cast("long").alias("all"), F.size(F.array_intersect("x", "y")).cast("long").alias("c"))
    return common.where(100 * F.col("c") >= 75 * (F.col("all") - F.col("c"))).select("a", "b")


def linked_in_clusters(members: DataFrame, texts: Texts) -> DataFrame:
    """Links (a, b) that join the components of each cluster; ``members``: rep, cluster, component, n_shingles, sketch."""
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("all"), F.count("*").alias("parts")).where(
        "parts > 1").select("cluster", F.col("m.component").alias("main"), F.ceil(F.col("m.n") / BLOCK).cast("int").alias("closed"),
                            F.ceil((F.col("all") - F.col("m.n")) / BLOCK).cast("int").alias("open"))
    # blocks 0 .. open - 1 hold what is not in the largest component, the others hold that; those need no comparison among themselves
    block = F.when(F.col("component") == F.col("main"), F.col("open") + F.pmod(F.xxhash64("rep"), F.col("closed"))).otherwise(
        F.pmod(F.xxhash64("rep"), F.col("open"))).cast("int")
    placed = members.join(saved(main, "open-clusters"), "cluster").withColumn("block", block)
    others = F.when(F.col("block") < F.col("open"), F.sequence(F.lit(0), F.col("open") + F.col("closed") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("open") - 1))
    dealt = saved(placed.select("rep", "cluster", "component", "n_shingles", "sketch", "block", F.explode(others).alias("other")).select(
        "rep", "cluster", "component", "n_shingles", "sketch", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")), "blocks")
    wanted = texts.of(dealt.select("rep").distinct())
    kind = dict(members.dtypes)["rep"]

    def task(group: pd.DataFrame) -> pd.DataFrame:
        ids, n = group["rep"].to_numpy(), group["n_shingles"].to_numpy()
        root = np.unique(group["component"].to_numpy(), return_inverse=True)[1]
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(len(ids), -1)
        sets = [shingles(t) for t in group["text"]]
        every, ends = np.concatenate(sets), np.cumsum([len(x) for x in sets])
        starts, out = ends - n, []
        for i in range(len(ids)):
            later = np.arange(i + 1, len(ids))
            later = later[(root[later] != root[i]) & (np.minimum(n[later], n[i]) * 100 >= np.maximum(n[later], n[i]) * 75)]
            later = later[(sketch[later] == sketch[i]).mean(1) >= LOOKS_NEAR]
            if not len(later):
                continue
            flat = np.concatenate([every[starts[j]:ends[j]] for j in later])
            at = np.minimum(np.searchsorted(sets[i], flat), n[i] - 1)
            common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.cumsum(n[later]) - n[later])
            for j in later[100 * common >= 75 * (n[i] + n[later] - common)]:
                if root[j] != root[i]:
                    out.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    rows = dealt.join(wanted, "rep")
    return rows.groupBy("cluster", "lo", "hi").applyInPandas(task, f"a {kind}, b {kind}")


def near_links(reps: DataFrame, texts: Texts) -> DataFrame:
    """(rep, component) of every representative that links with another; steps 3 and 4."""
    rows = reps.select("rep", F.explode("bands").alias("bucket"))
    flip = F.lit(HUB_ORDER).cast("long")
    hubs = saved(rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.col("rep").bitwiseXOR(flip)).alias("h")).where("n > 1").select(
        "bucket", F.col("h").bitwiseXOR(flip).alias("hub")), "hubs")
    met = saved(rows.join(hubs, "bucket"), "met")
    stars = met.where("hub != rep").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    alike = saved(looks_near(stars, reps, LOOKS_ALIKE), "stars")
    best = Window.partitionBy("b").orderBy(F.desc("near"), "a")
    first = saved(confirmed(alike.where(F.col("near") >= LOOKS_NEAR).withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= TRY_HUBS), texts), "links")
    label = lambda links, name: components(links).select(F.col("id").alias("rep"), F.col("component").alias(name))
    clusters = saved(label(alike, "cluster"), "clusters")
    members = clusters.join(label(first, "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    inside = saved(linked_in_clusters(saved(members.join(reps.select("rep", "n_shingles", "sketch"), "rep"), "members"), texts), "links")
    # what a bucket still holds apart
    labelled = met.select("bucket", "rep").join(clusters, "rep", "left").withColumn("cluster", F.coalesce("cluster", "rep"))
    apart = saved(labelled.groupBy("bucket").agg(F.min("cluster").alias("_lo"), F.max("cluster").alias("_hi")).where("_lo < _hi").select("bucket"), "apart")
    open_rows = saved(labelled.join(apart, "bucket").join(reps.select("rep", "n_shingles", "bits"), "rep"), "open")
    x, y = (open_rows.select("bucket", F.col("rep").alias(r), F.col("cluster").alias(f"c{r}"), F.col("n_shingles").alias(f"n{r}"), F.col("bits").alias(f"k{r}")) for r in "ab")
    differ = sum((F.bit_count(F.element_at("ka", k + 1).bitwiseXOR(F.element_at("kb", k + 1))) for k in range(2 * PERMUTATIONS // 32)), F.lit(0))
    cross = x.join(y, "bucket").where((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 75) & (differ <= MAX_BITS)).select("a", "b").distinct()
    rest = saved(confirmed(looks_near(cross, reps), texts), "links")
    return components(first.unionByName(inside).unionByName(rest)).select(F.col("id").alias("rep"), "component")


def near_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (no_id, doc_id, text_hash), n_shingles, component_id, first: one row per row of ``docs``; ``first`` is the row that stands for its component.

    Equal rows have equal ``row``, so all of them are ``first`` or none.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    docs = named.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("text_hash")).alias("row"), "text")
    sigs = saved(signatures(docs, "row", "text").withColumnRenamed("doc_id", "row"), "signatures")
    found = saved(sigs.where("set_id is not null").groupBy("set_id").agg(F.min("row").alias("row")), "sets-by-name")
    classes = saved(found.withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = saved(sigs.join(classes, ["row", "set_id"]).dropDuplicates(["rep"]).select("rep", "n_shingles", "bands", "sketch", "bits"), "reps")
    joined = near_links(reps, Texts(docs, classes.select("rep", "row")))
    labelled = classes.join(joined, "rep", "left").select("set_id", "row", F.coalesce("component", "rep").alias("component"))
    smallest = saved(labelled.groupBy("component").agg(F.min("row").alias("smallest")), "smallest")
    groups = saved(labelled.join(smallest, "component").select("set_id", "smallest"), "groups")
    return sigs.select("row", "n_shingles", "set_id").join(groups, "set_id", "left").select(
        "row", "n_shingles", F.coalesce("smallest.doc_id", "row.doc_id").alias("component_id"),
        (F.col("smallest").isNull() | (F.col("smallest") == F.col("row"))).alias("first"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable over links), kept (is that id)."""
    return near_rows(docs, id_col, text_col).select(
        F.col("row.doc_id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("row.doc_id"), F.lit(True)).alias("kept"))
