"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), the
pairs in time linear in the features: half of (sum v_i x_i)**2 minus
sum (v_i x_i)**2, by factor.

A text's features are its distinct words, hashed, with weights of unit
length together, and one bin for each statistic of its structure (shares
of upper case, digits, symbols, repeated words, repeated lines, ...) and
of its length.  Labels, language, source and id are never inputs.

The machine is fitted on at most ``max_train`` labelled rows (the smallest
by a hash of the id, so every run and every table order fits the same
rows); every document is scored, whole.

Null texts count as empty and get a score like any other; without labels
every score is 0.5; labels that are null are left out, and a document
with several labels has the smallest; repeated rows get equal scores; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import map_arrow, map_texts, steps

WORD_BITS = 14
FACTORS = 8
MAX_TRAIN = 4000
BINS = 16
MAX_WORDS = 100_000  # word buckets remembered by a worker

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _SYMBOL, _HIGH = range(8)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[ord("a"):ord("z") + 1] = _LOWER
_CLASS[ord("A"):ord("Z") + 1] = _UPPER
_CLASS[ord("0"):ord("9") + 1] = _DIGIT
_CLASS[[9, 11, 12, 13, 32]] = _SPACE
_CLASS[10] = _LINE
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = _STOP
_CLASS[128:] = _HIGH

#: statistics of a text, each cut into ``BINS`` bins
STATISTICS = ("upper", "digit", "stop", "symbol", "high", "line", "words", "chars", "word_length", "distinct_words",
              "commonest_word", "distinct_lines", "shouted_words", "marked_words", "line_length")
N_WORDS = 1 << WORD_BITS
N_FEATURES = N_WORDS + len(STATISTICS) * BINS


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        b = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) & (N_WORDS - 1)
        return b


_buckets = _Buckets()


def _share_bin(share: float) -> int:
    """Shares are told apart finely near 0: bins by powers of two from 1/2**14 up."""
    return 0 if share <= 0 else max(1, min(BINS - 1, BINS - 1 + int(np.floor(np.log2(share)))))


def _size_bin(size: float) -> int:
    return min(BINS - 1, int(np.log2(size + 1)))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, values) of a whole text."""
    if len(_buckets) > MAX_WORDS:
        _buckets.clear()
    raw = text.split()
    counts = Counter(raw)
    words = np.unique(np.fromiter(map(_buckets.__getitem__, {w.lower() for w in counts}), np.int64))
    by_class = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)], minlength=8)
    n_bytes, n_words = max(1, int(by_class.sum())), max(1, len(raw))
    lines = [x for x in text.split("\n") if x]
    letters = max(1, int(by_class[_LOWER] + by_class[_UPPER]))
    shouted = sum(n for w, n in counts.items() if len(w) > 1 and w.isupper())
    marked = sum(n for w, n in counts.items() if not w[-1].isalnum() and not w[-1] in ".,;:?!)'\"")
    bins = [
        _share_bin(by_class[_UPPER] / letters), _share_bin(by_class[_DIGIT] / n_bytes), _share_bin(by_class[_STOP] / n_bytes),
        _share_bin(by_class[_SYMBOL] / n_bytes), _share_bin(by_class[_HIGH] / n_bytes), _share_bin(by_class[_LINE] / n_bytes),
        _size_bin(len(raw)), _size_bin(len(text)), min(BINS - 1, int(n_bytes / n_words)),
        int((BINS - 1) * len(counts) / n_words), _share_bin(max(counts.values(), default=0) / n_words),
        int((BINS - 1) * len(set(lines)) / max(1, len(lines))), int((BINS - 1) * shouted / n_words),
        int((BINS - 1) * marked / n_words), _size_bin(len(text) / max(1, len(lines)))]
    at = np.r_[words, N_WORDS + np.arange(len(bins)) * BINS + bins]
    return at, np.r_[np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.ones(len(bins))].astype(np.float64)


class Machine:
    """w0, w, v of a factorisation machine."""

    def __init__(self, seed: int = 7) -> None:
        self.w0, self.w = 0.0, np.zeros(N_FEATURES)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (N_FEATURES, FACTORS))

    def raw(self, at: np.ndarray, x: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid of ``n`` rows (features grouped by row), and sum_i v_i x_i of each row."""
        vx = self.v[at] * x[:, None]
        starts = np.searchsorted(row, np.arange(n))
        s = np.add.reduceat(vx, starts, axis=0)
        q = np.add.reduceat(vx * vx, starts, axis=0)
        return self.w0 + np.add.reduceat(self.w[at] * x, starts) + 0.5 * (s * s - q).sum(1), s

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64,
            rate: float = 0.08, decay: float = 1e-5) -> Machine:
        """AdaGrad on the logistic loss, in batches in a fixed random order."""
        gw0, gw, gv = 1e-8, np.full(N_FEATURES, 1e-8), np.full((N_FEATURES, FACTORS), 1e-8)
        if not rows:
            self.v[:] = 0  # nothing is known: every score is 0.5
        order = np.random.default_rng(11)
        for _ in range(epochs if rows else 0):
            for part in np.array_split(order.permutation(len(rows)), max(1, len(rows) // batch)):
                at = np.concatenate([rows[i][0] for i in part])
                x = np.concatenate([rows[i][1] for i in part])
                row = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
                raw, s = self.raw(at, x, row, len(part))
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[part]) / len(part)
                used, slot = np.unique(at, return_inverse=True)
                dw = np.bincount(slot, err[row] * x, len(used)) + decay * self.w[used]
                dv = np.zeros((len(used), FACTORS))
                np.add.at(dv, slot, (err[row] * x)[:, None] * (s[row] - self.v[at] * x[:, None]))
                dv += decay * self.v[used]
                gw0 += err.sum() ** 2
                gw[used] += dw * dw
                gv[used] += dv * dv
                self.w0 -= rate * err.sum() / np.sqrt(gw0)
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * dv / np.sqrt(gv[used])
        return self

    def score(self, texts: list[str]) -> np.ndarray:
        rows = [features(t) for t in texts]
        row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
        raw, _ = self.raw(np.concatenate([a for a, _ in rows]), np.concatenate([x for _, x in rows]), row, len(rows))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out of training."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Machine:
    """Fit on the labelled documents outside the held-out fold, ``max_train`` of them at most."""
    known = labels.where((fold(id_col) != 1) & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(
        F.min(label_col).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            rows = [features(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a for a, _ in rows], pa.list_(pa.int64())),
                 pa.array([x for _, x in rows], pa.list_(pa.float64()))], ["doc_id", "label", "at", "x"])

    kinds = dict(sample.dtypes)
    got = map_arrow(sample, task, f"doc_id {kinds['doc_id']}, label {kinds['label']}, at array<long>, x array<double>").toArrow()
    rows = sorted(zip(got["doc_id"].to_pylist(), got["label"].to_pylist(), got["at"].to_pylist(), got["x"].to_pylist()), key=lambda r: (r[0], len(r[2])))
    return Machine().fit([(np.array(a), np.array(x)) for _, _, a, x in rows], np.array([float(y) for _, y, _, _ in rows]))


def score_documents(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.value.score(texts))], ["doc_id", "score"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, task, f"doc_id {id_type}, score double", id_col, text_col).select(
        "doc_id", (fold("doc_id") == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, machine: Machine, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``least``."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    names = docs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches):
            keep = batch.filter(pa.array(model.value.score(texts) >= least))
            yield pa.RecordBatch.from_arrays(keep.columns[:-1], names)

    return map_arrow(docs.select(*names, F.col(text_col).alias("_scored")), task, docs.schema)
