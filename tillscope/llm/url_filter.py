"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Rules are (verdict, host, path): a rule fits its host and all subdomains
where the URL's path starts with the rule's path; the longest fitting rule
decides (ties: the first in alphabetical order).  URLs that no rule fits
are judged by boosted trees (``pyspark.ml``) on lexical features: lengths,
depth, digit ratio, entropy, parameter and label counts, hyphens, how often
the URL's host suffix is labelled as blocked, and the same rates of the
character runs (``GRAMS``) that the words of its host consist of.

Labels.  ``label_by_words`` labels a URL by the whole words of its host.
Labelled hosts of one crawl are few, and their form (a hyphen, say) may go
with the label by chance.  So ``with_composed`` adds labelled URLs: a URL of
the sample again, with the name in its host replaced by two words of the
fixed lists, joined by a hyphen, a dot or nothing, whatever the label.

The trees and the rates of character runs are fitted on at most
``max_train`` labelled URLs (the smallest by a hash) and their
``variants`` composed ones; suffix statistics cover all labelled URLs.  A
training URL's rates come from the half of the hosts that its own host is
not in, so the trees see them as they are on unknown hosts.

A null URL, or one without ``://``, has an empty host and path and no
rule; it is judged like any other.  Without labelled URLs every URL without
a rule is allowed.  Repeated rows get equal verdicts; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import map_arrow, saved, steps

Rule = tuple[str, str, str]

MAX_TRAIN, VARIANTS = 8_000, 4
TREES, DEPTH = 20, 4
#: weight of the overall rate in a suffix's rate of blocked URLs, and in a run's rate of blocked hosts
PRIOR, RUN_PRIOR = 20.0, 1.0
#: lengths of character runs (a word's ends count as characters), buckets of their hashes
GRAMS, BUCKETS = (3, 4, 5, 6), 1 << 16

# fixed values: host words that label a URL as blocked (the usual groups of public block lists: adult, gambling, pharmacy, advertising, fraud)
BLOCKED_WORDS = (
    "adult adults porn porno sex sexy xxx nude nudes escort escorts cams hentai fetish "
    "casino casinos poker bet bets betting slots lottery jackpot roulette gambling bingo blackjack "
    "pills viagra cialis pharmacy steroids xanax tramadol "
    "ad ads advert adserver adtrack tracker banner popup popups clickbait "
    "spam phish phishing malware warez keygen torrent scam"
).split()

# fixed values: words that leave a host's label as it is; some hold blocked words
OTHER_WORDS = (
    "my the best top free cheap win track farm x online daily world city home "
    "bakery news garden school river music travel books museum sports weather recipes kitchen bike health science history "
    "road roads loads downloads alphabets essex sussex bettina spamalot cocktail adventure shadow banners slotted "
    "green north mountain family art photo film coffee market village church football library hotel car house"
).split()

LEXICAL = ["length", "host_length", "path_length", "labels", "hyphens", "depth", "digits", "entropy", "host_entropy", "parameters",
           "longest_segment", "fragment", "secure"]
RUNS = ["run_highest", "run_second", "run_third", "run_mean", "run_seen"]
FEATURES = [*LEXICAL, *RUNS, "suffix_rate", "suffix_count"]


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(rules: list[Rule], host: str, path: str) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]), reverse=True):
        fits = ((F.col(host) == rule_host) | F.col(host).endswith("." + rule_host)) & F.col(path).startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: str) -> float:
    if not text:
        return 0.0
    p = np.unique(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), return_counts=True)[1] / len(text.encode("utf-8", "surrogatepass"))
    return float(-(p * np.log2(p)).sum())


def _lexical(url: str) -> list[float]:
    scheme, found, rest = url.partition("://")
    if not found:
        rest = ""
    before = rest.partition("#")[0]
    place, _, query = before.partition("?")
    host, _, path = place.partition("/")
    segments = [s for s in path.split("/") if s]
    return [len(url), len(host), len(path), host.count(".") + 1 if host else 0, host.count("-"), len(segments),
            sum(c.isdigit() for c in url) / max(1, len(url)), _entropy(url), _entropy(host), query.count("=") + query.count("&"),
            max(map(len, segments), default=0), float("#" in rest), float(scheme.lower() == "https")]


def _runs(host: str) -> np.ndarray:
    """Buckets of the distinct character runs of a host's words, without its last label."""
    words = re.findall(r"[^\W\d_]+", host.rpartition(".")[0] or host)
    return np.array(sorted({zlib.crc32(w[i:i + n].encode("utf-8", "surrogatepass")) % BUCKETS
                            for w in (f"^{w}$" for w in words) for n in GRAMS for i in range(len(w) - n + 1)}), np.int64)


def _half(host: str) -> int:
    return zlib.crc32(host.encode("utf-8", "surrogatepass")) >> 16 & 1


def _rates(host: str, counts: np.ndarray, rate: float) -> list[float]:
    """The three highest rates of blocked hosts among the host's runs, their mean, and the share of runs seen before."""
    at = _runs(host)
    if not len(at):
        return [rate, rate, rate, rate, 0.0]
    hosts, blocked = counts[0, at], counts[1, at]
    rates = np.sort((blocked + RUN_PRIOR * rate) / (hosts + RUN_PRIOR))[::-1]
    first = [*rates[:3], *[rate] * 3][:3]
    return [*map(float, first), float(rates.mean()), float((hosts > 0).mean())]


def run_counts(hosts: DataFrame) -> np.ndarray:
    """[half, (hosts, blocked hosts), bucket] over distinct (host, label) rows: added up by bucket, 2 * BUCKETS rows at most."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2, BUCKETS))
        for batch in batches:
            for host, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[_half(host), :, _runs(host)] += (1.0, label)
        half, at = np.nonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(half, pa.int32()), pa.array(at, pa.int32()), *map(pa.array, total[half, :, at].T)],
                                         ["half", "at", "hosts", "blocked"])

    rows = map_arrow(hosts.select("host", "label"), task, "half int, at int, hosts double, blocked double").groupBy("half", "at").agg(
        F.sum("hosts").alias("hosts"), F.sum("blocked").alias("blocked")).toArrow()
    counts = np.zeros((2, 2, BUCKETS))
    counts[rows["half"].to_numpy(), :, rows["at"].to_numpy()] = np.stack([rows["hosts"].to_numpy(), rows["blocked"].to_numpy()], 1)
    return counts


def lexical(urls: DataFrame, columns: list[str], counts: np.ndarray, rate: float, unknown: bool = False, url_col: str = "url") -> DataFrame:
    """``columns`` (they hold ``host``), the lexical features of every URL and the rates of its host's runs; ``unknown``:
    by the half of the hosts that its own is not in."""
    schema = ", ".join(f"{c} {urls.schema[c].dataType.simpleString()}" for c in columns)
    held = urls.sparkSession.sparkContext.broadcast(np.stack([counts[1], counts[0], counts.sum(0)]) if unknown else counts.sum(0)[None])  # 16 or 48 bytes a bucket
    features = [*LEXICAL, *RUNS]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch, texts in steps(batches):
            hosts = batch.column(columns.index("host")).to_pylist()
            x = np.array([_lexical(t) + _rates(h, known[_half(h) if unknown else 0], rate) for t, h in zip(texts, hosts)], np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, x.reshape(len(texts), len(features)).T)], [*columns, *features])

    return map_arrow(urls.select(*columns, F.col(url_col).alias("_url")), task, schema + "".join(f", {c} double" for c in features))


@dataclass
class UrlModel:
    """Fitted trees (None: allow) and the statistics they were fitted with."""

    trees: Model | None
    suffixes: DataFrame | None
    rate: float
    counts: np.ndarray | None = None
    host_rate: float = 0.0

    def judge(self, urls: DataFrame, columns: list[str], url_col: str = "url") -> DataFrame:
        """``columns``, which hold ``host``, and ``blocked`` (0 or 1)."""
        if self.trees is None:
            return urls.select(*columns, F.lit(0.0).alias("blocked"))
        x = _with_suffix(lexical(urls, columns, self.counts, self.host_rate, url_col=url_col), self.suffixes, self.rate)
        return self.trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(x)).select(
            *columns, F.col("prediction").alias("blocked"))


def _suffix(host: str) -> Column:
    return F.substring_index(host, ".", -1)


def _with_suffix(x: DataFrame, suffixes: DataFrame, rate: float) -> DataFrame:
    return x.withColumn("suffix", _suffix("host")).join(suffixes, "suffix", "left").withColumn(
        "suffix_rate", F.coalesce("suffix_rate", F.lit(rate))).withColumn("suffix_count", F.coalesce("suffix_count", F.lit(0.0)))


def with_composed(sample: DataFrame, variants: int = VARIANTS) -> DataFrame:
    """(url, label, host) rows and, for each, ``variants`` more: scheme, last two labels of the host, path and parameters as they
    are, the name before them made of two words, half of them blocked ones."""
    def pick(words: list[str], k: int) -> Column:
        return F.element_at(F.lit(words), (F.pmod(F.xxhash64("url", "variant", F.lit(k)), F.lit(len(words))) + 1).cast("int"))

    def one_of(n: int, k: int) -> Column:
        return F.pmod(F.xxhash64("url", "variant", F.lit(k)), F.lit(n))

    joiner = F.element_at(F.array(F.lit("-"), F.lit(""), F.lit(".")), (one_of(3, 1) + 1).cast("int"))
    blocked = one_of(2, 2) == 0
    first, second = F.when(blocked, pick(BLOCKED_WORDS, 3)).otherwise(pick(OTHER_WORDS, 4)), pick(OTHER_WORDS, 5)
    alone = one_of(6, 6) == 0  # one word in six stands alone
    name = F.when(alone, first).when(one_of(2, 7) == 0, F.concat(first, joiner, second)).otherwise(F.concat(second, joiner, first))
    made = sample.where("host <> ''").select("url", F.explode(F.sequence(F.lit(1), F.lit(variants))).alias("variant"), F.col("host").alias("was")).withColumn(
        "host", F.concat(name, F.lit("."), F.substring_index("was", ".", -2)))
    at = F.instr(F.col("url"), "://") + 3
    made = made.select(F.concat(F.substring(F.col("url"), F.lit(1), at - 1), "host", F.substring(F.col("url"), at + F.length("was"), F.length("url"))).alias("url"),
                       blocked.cast("double").alias("label"), "host")
    return sample.select("url", "label", "host").unionByName(made)


def train(labelled: DataFrame, max_train: int = MAX_TRAIN, variants: int = VARIANTS) -> UrlModel:
    """Fit on (url, label) rows, 1: blocked."""
    host, _ = host_and_path("url")
    rows = labelled.where("url is not null and label is not null").groupBy("url").agg(F.max("label").cast("double").alias("label")).withColumn("host", host)
    rows = saved(rows, "labelled-urls")
    sample = saved(with_composed(rows.orderBy(F.xxhash64("url"), "url").limit(max_train), variants) if variants else
                   rows.orderBy(F.xxhash64("url"), "url").limit(max_train), "url-sample")
    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("s")).first()
    if not 0 < total["s"] < total["n"]:
        return UrlModel(None, None, 0.0)
    rate = rows.agg(F.avg("label")).first()[0]
    suffixes = saved(rows.groupBy(_suffix("host").alias("suffix")).agg(
        ((F.sum("label") + PRIOR * rate) / (F.count("*") + PRIOR)).alias("suffix_rate"), F.log1p(F.count("*")).alias("suffix_count")), "suffixes")
    hosts = saved(sample.groupBy("host").agg(F.max("label").alias("label")), "sample-hosts")
    counts, host_rate = run_counts(hosts), hosts.agg(F.avg("label")).first()[0]
    x = saved(_with_suffix(lexical(sample, ["host", "label"], counts, host_rate, unknown=True), suffixes, rate).select("label", *FEATURES), "url-features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=5)
    return UrlModel(trees.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(x)), suffixes, rate, counts, host_rate)


def label_by_words(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, label): 1 where a word of the host, between other characters than letters, is one of ``BLOCKED_WORDS``."""
    host, _ = host_and_path(url_col)
    words = F.split(host, r"[^\p{L}]+")
    return urls.select(F.col(url_col).alias("url"), F.arrays_overlap(words, F.lit(list(BLOCKED_WORDS))).cast("int").alias("label"))


def filter_urls(pages: DataFrame, rules: list[Rule], labelled: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every URL."""
    host, path = host_and_path("url")
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumn("host", host).withColumn("path", path)
    urls = urls.withColumn("m", matched_rule(rules, "host", "path")).select("*", "m.rule", F.col("m.verdict").alias("said"))
    judged = train(labelled).judge(urls, ["page_id", "host", "path", "rule", "said"])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("blocked") == 1, "block").otherwise("allow")).alias("verdict"))
