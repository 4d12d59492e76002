"""Token counts by rank-synchronous array merging.

All new pre-tokens of a step stand in one flat array of symbols with an
array of sequence numbers (a ragged batch).  In every round each sequence
finds the lowest merge rank among its neighbouring pairs, and all
sequences apply their own lowest-rank pair at the same time, left to
right where occurrences overlap.  Sequences without a mergeable pair
leave the arrays; what survives is the token count.

Null texts count as empty (0 bytes, 0 tokens); special strings inside a
text are one token each, as the library does by default; repeated rows
give repeated rows; an empty table gives an empty result; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillscope.llm import pretokens as P
from tillscope.llm.common import map_texts, steps

NO_RANK = np.int32(2**31 - 1)


class PairTable:
    """Merge ranks and merged ids by (left id, right id), sorted for vectorised lookup."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)  # by rank
        alphabet = P.byte_alphabet()
        self.of_byte = np.array([vocab[alphabet[b]] for b in range(256)], np.int32)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)


def merged_counts(words: list[bytes], pairs: PairTable) -> np.ndarray:
    """Tokens of each pre-token after all merges."""
    out = np.zeros(len(words), np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    sym = pairs.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    seq = np.repeat(np.arange(len(words)), sizes)
    if not len(sym):
        return out
    rank = np.full(len(sym), NO_RANK, np.int32)  # of the pair that starts here
    same = np.flatnonzero(seq[1:] == seq[:-1])
    rank[same] = pairs.rank(sym[same], sym[same + 1])
    while len(sym):
        starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        lens = np.diff(np.r_[starts, len(sym)])
        low = np.minimum.reduceat(rank, starts)
        done = low == NO_RANK
        out[seq[starts[done]]] = lens[done]
        live = np.repeat(~done, lens)
        sym, seq, rank, low = sym[live], seq[live], rank[live], np.repeat(low, lens)[live]
        if not len(sym):
            break
        hit = np.flatnonzero(rank == low)
        # occurrences that overlap (a a a): take every other one of a run, from the left
        first = np.r_[True, (np.diff(hit) != 1) | (seq[hit[1:]] != seq[hit[:-1]])]
        run = np.flatnonzero(first)
        within = np.arange(len(hit)) - np.repeat(run, np.diff(np.r_[run, len(hit)]))
        hit = hit[within % 2 == 0]
        sym[hit] = pairs.merged[rank[hit]]
        keep = np.ones(len(sym), bool)
        keep[hit + 1] = False
        at = (np.cumsum(keep) - 1)[hit]
        sym, seq, rank = sym[keep], seq[keep], rank[keep]
        touched = np.unique(np.r_[at, at[at > 0] - 1])
        rank[touched] = NO_RANK
        pair = touched[touched + 1 < len(sym)]
        pair = pair[seq[pair] == seq[pair + 1]]
        rank[pair] = pairs.rank(sym[pair], sym[pair + 1])
    return out


class TokenCounter:
    """Counts whole texts; each distinct piece is merged once per worker."""

    def __init__(self, path: str) -> None:
        self.pairs = PairTable(path)
        self.special = P.special_pattern(self.pairs.specials)
        self.known: dict[str, int] = {}  # tokens of a piece with a space in front

    def _learn(self, new: list[str]) -> None:
        numbers: dict[bytes, int] = {}
        pre, owner = [], []
        for i, piece in enumerate(new):
            for word in P.BYTE_PATTERN.findall(" " + piece):
                pre.append(numbers.setdefault(word.encode("utf-8"), len(numbers)))
                owner.append(i)
        tokens = merged_counts(list(numbers), self.pairs)
        self.known.update(zip(new, np.bincount(owner, tokens[pre], len(new)).astype(int).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > P.MAX_PIECES:
            self.known = {}
        heads, rests, extra = [], [], []
        for text in texts:
            parts = P.around_specials(text, self.special)
            pieces = [P.space_pieces(part) for part, _ in parts]
            heads.append([p[0] for p in pieces])
            rests.append(pieces[0][1:] if len(pieces) == 1 else [x for p in pieces for x in p[1:]])
            extra.append(sum(s is not None for _, s in parts))
        if new := list(set().union(*rests) - self.known.keys()):
            self._learn(new)
        first = [[w.encode("utf-8") for h in head for w in P.BYTE_PATTERN.findall(h)] for head in heads]
        tokens = merged_counts([w for ws in first for w in ws], self.pairs)
        ends = np.cumsum([len(ws) for ws in first])
        total = np.r_[0, np.cumsum(tokens)][np.r_[0, ends]]
        get = self.known.__getitem__
        return [sum(map(get, rest)) + int(h) + e for rest, h, e in zip(rests, np.diff(total), extra)]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(tokenizer)
        for batch, texts in steps(batches):
            n = of.count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_texts(docs, task, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean", id_col, text_col)
