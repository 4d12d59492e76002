"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

Encoding.  An Aho-Corasick automaton over all tokens gives the longest
token that starts at each position of a word.  The encoder takes the
longest match, checks it against its left neighbour in a
pair-compatibility table, falls back to the next shorter match where the
pair is not one that the merges would leave side by side, and steps back
when none is left.  Positions that cannot lead to the end are marked, so
each is left at most once and the work is linear in the word.

Compatibility of a pair.  While merges run, the right edge of the left
token grows through its right-hand parts and the left edge of the right
token through its left-hand parts, each part living from the rank that
forms it to the rank that absorbs it.  The pair survives unless two parts
that live at the same time have a merge that comes before either is
absorbed.

Decoding.  All token strings lie in one byte array with an offset table;
the bytes of a list of ids are gathered at once.

Null texts count as empty (no ids, empty decoded text); special strings
inside a text are one id each; an empty table gives an empty result;
repeated rows give repeated rows; columns other than the id and the text
are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillscope.llm import pretokens as P
from tillscope.llm.common import map_texts, steps

FINAL = 256  # a word's last byte b is the symbol chr(FINAL + b)
NEVER = 1 << 30
MAX_PIECES = 400_000  # and its pieces and words beyond this many
MAX_PAIRS = 500_000  # a worker forgets its pair table beyond this many


class Offsets:
    """Byte strings by id in one array; ``gather`` joins those of many ids."""

    def __init__(self, strings: list[bytes]) -> None:
        self.at = np.r_[0, np.cumsum([len(s) for s in strings])].astype(np.int64)
        self.blob = np.frombuffer(b"".join(strings), np.uint8)

    def gather(self, ids: np.ndarray) -> bytes:
        starts, lens = self.at[ids], self.at[ids + 1] - self.at[ids]
        ends = np.cumsum(lens)
        return self.blob[np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ids) else 0)].tobytes()


class WordBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = P.special_pattern(self.specials)
        names = {i: s for s, i in (vocab | self.specials).items()}
        self.size = max(names) + 1
        self.names = [names.get(i, "") for i in range(self.size)]
        # without a decoder in its file the library joins token strings with one space
        self.strings = Offsets([(s + " ").encode("utf-8") for s in self.names])
        self.decimals = Offsets([b"%d " % i for i in range(self.size)])
        of_char = {c: b for b, c in P.byte_alphabet().items()}

        def symbols(token: str) -> str:
            last = bool(end) and token.endswith(end) and len(token) > len(end)
            body = [of_char[c] for c in (token[:-len(end)] if last else token)]
            return "".join(map(chr, body[:-1])) + chr(body[-1] + FINAL * last)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merge = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> left, right, rank
        self.edges: dict[tuple[int, bool], list[tuple[int, int, int]]] = {}
        self.compatible: dict[int, bool] = {}
        text = {i: symbols(s) for s, i in vocab.items()}
        self.automaton = ahocorasick.Automaton()
        usable = {i for i, s in text.items() if len(s) == 1}
        for rank, (a, b) in enumerate(pairs):
            left, right, whole = vocab[a], vocab[b], vocab[a + (b if not b == end else end)]
            # a token that the merges themselves would never make is not a match
            if left in usable and right in usable and whole not in self.parts and self.fits(left, right, rank):
                self.parts[whole] = (left, right, rank)
                usable.add(whole)
        by_text = {text[i]: i for i in usable}
        self.length = {i: len(text[i]) for i in usable}
        for s, i in by_text.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.shorter = {}
        for s, i in by_text.items():
            self.shorter[i] = next((by_text[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in by_text), -1)
        self.compatible.clear()
        self.known: dict[str, bytes] = {}  # ids of pieces between white space
        self.words: dict[str, bytes] = {}  # and of the words that they hold

    def edge(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(part, rank that forms it, rank that absorbs it) along a token's right or left edge."""
        key = (token, right)
        if key not in self.edges:
            out, at, absorbed = [], token, NEVER
            while at in self.parts:
                rank = self.parts[at][2]
                out.append((at, rank, absorbed))
                at, absorbed = self.parts[at][1 if right else 0], rank
            out.append((at, -1, absorbed))
            self.edges[key] = out
        return self.edges[key]

    def fits(self, left: int, right: int, below: int = NEVER) -> bool:
        """Merges with a rank under ``below`` leave the two tokens side by side."""
        for a, a_formed, a_absorbed in self.edge(left, True):
            for b, b_formed, b_absorbed in self.edge(right, False):
                rank = self.merge.get((a, b), NEVER)
                # at equal ranks the merge further left goes first
                if rank < below and rank < a_absorbed and rank <= b_absorbed and a_formed < b_absorbed and b_formed < a_absorbed:
                    return False
        return True

    def pair(self, left: int, right: int) -> bool:
        key = left << 20 | right
        if key not in self.compatible:
            if len(self.compatible) > MAX_PAIRS:
                self.compatible.clear()
            self.compatible[key] = self.fits(left, right)
        return self.compatible[key]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8").decode("latin-1")
        s = raw[:-1] + chr(ord(raw[-1]) + FINAL)
        longest, length = [-1] * len(s), self.length
        for last, token in self.automaton.iter(s):
            start = last + 1 - length[token]
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        out: list[int] = []
        dead = bytearray(len(s) + 1)
        at, token = 0, longest[0]
        while at < len(s):
            while token >= 0 and (dead[at + length[token]] or out and not self.pair(out[-1], token)):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < len(s) else -1
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = self.shorter[token]
        return out

    def word_ids(self, word: str) -> bytes:
        found = self.encode_word(word)
        ids = self.words[word] = struct.pack(f"<{len(found)}i", *found)
        return ids

    def encode(self, text: str) -> np.ndarray:
        out = []
        for part, special in P.around_specials(text, self.special):
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()  # letter by letter: no final sigma
            pieces = [p for p in P.WORD_BREAK.split(part) if p] if _CONTROL.search(part) else part.split()
            get = self.known.get
            ids = list(map(get, pieces))
            if None in ids:
                for p in pieces:
                    if p not in self.known:
                        self.known[p] = b"".join([self.words.get(w) or self.word_ids(w) for w in P.WORD_PATTERN.findall(p)])
                ids = list(map(get, pieces))
            out += ids
            if special is not None:
                out.append(np.array([self.specials[special]], "<i4").tobytes())
        if len(self.known) > MAX_PIECES:
            self.known, self.words = {}, {}
        return np.frombuffer(b"".join(out), "<i4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.strings.gather(ids)[:-1]


# separators that str.split() takes for white space and the tokenizer does not
_CONTROL = P.regex.compile(r"[\x1c-\x1f]")


@functools.lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; with ``keep_ids`` also ids and decoded."""
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * keep_ids

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(tokenizer)
        for batch, texts in steps(batches):
            ids = [bpe.encode(t) for t in texts]
            decoded = [bpe.decode(x) for x in ids]
            cols = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(bpe.decimals.gather(x)[:-1]).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())]
            if keep_ids:
                cols += [pa.array([x.tolist() for x in ids], pa.list_(pa.int32())), pa.array([d.decode("utf-8") for d in decoded], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names)

    more = ", ids array<int>, decoded string" * keep_ids
    return map_texts(docs, task, f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}", id_col, text_col)
