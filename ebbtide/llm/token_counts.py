"""Token counts by rank-synchronous merging of ragged symbol arrays.

The distinct pre-tokens of a slice of texts lie end to end in one flat numpy array of symbol
ids. Each step finds the lowest-ranked pair of every sequence and merges all its occurrences,
in all sequences at once; what is left of a sequence when no pair has a rank is its count.
"""

import json
import unicodedata
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import mapped

# Fixed values of the vocabulary's format: its split pattern, and the byte alphabet's printable ranges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
PRINTABLE = [(0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)]

NO_RANK = np.int32(2**31 - 1)
# Counts kept for pre-tokens of up to so many characters, and how many before the cache starts anew.
CACHED_LENGTH, CACHE_SIZE = 64, 200_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    own = {b for lo, hi in PRINTABLE for b in range(lo, hi + 1)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """Symbols and ranked pairs of a BPE file with word ends."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + end] for c in letters], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        if len(set(self.made.tolist())) != len(pairs):
            raise ValueError("two merges make one symbol: ranks are no order to merge in")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each non-empty byte string ends as."""
        sizes = np.array([len(w) for w in words])
        result = sizes.copy()
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[flat[ends]]
        seq = np.repeat(np.arange(len(words)), sizes)
        ranks = np.full(len(sym), NO_RANK)
        inside = np.flatnonzero(seq[:-1] == seq[1:])
        ranks[inside] = self.rank(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            length = np.diff(np.r_[starts, len(sym)])
            done = lowest == NO_RANK
            if done.any():
                result[seq[starts[done]]] = length[done]
                stay = np.repeat(~done, length)
                sym, seq, ranks = sym[stay], seq[stay], ranks[stay]
                lowest, length = lowest[~done], length[~done]
                if not len(sym):
                    break
            hit = np.flatnonzero(ranks == np.repeat(lowest, length))
            # Of overlapping occurrences, which only a doubled symbol has, every other one counts.
            first = np.r_[True, (np.diff(hit) > 1) | (ranks[hit[1:]] != ranks[hit[:-1]])]
            run = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            sym[hit] = self.made[ranks[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = hit - np.arange(len(hit))
            sym, seq, ranks = sym[keep], seq[keep], ranks[keep]
            touched = np.unique(np.r_[at, at[at > 0] - 1])
            ranks[touched] = NO_RANK
            touched = touched[touched < len(sym) - 1]
            touched = touched[seq[touched] == seq[touched + 1]]
            ranks[touched] = self.rank(sym[touched], sym[touched + 1])
        return result


class Counter:
    """Token counts of texts, with the counts of short pre-tokens kept between slices."""

    def __init__(self, spec: dict):
        self.merges = Merges(spec)
        self.split = regex.compile(SPLIT)
        special = [regex.escape(t) for t in sorted(self.merges.special, key=len, reverse=True)]
        self.special = regex.compile("|".join(special)) if special else None
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[int, list[str]]:
        """Special strings in the text, and its pre-tokens."""
        special = 0
        if self.special is not None and "<|" in text:
            parts = self.special.split(text)
            special = len(parts) - 1
        else:
            parts = [text]
        words: list[str] = []
        for part in parts:
            words += self.split.findall(normal(part))
        return special, words

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.known) > CACHE_SIZE:
            self.known = {}
        found = [self.pieces(t) if t else (0, []) for t in texts]
        new = list({w for _, words in found for w in words}.difference(self.known))
        extra: dict[str, int] = {}
        if new:
            for w, n in zip(new, self.merges.counts([w.encode() for w in new]).tolist()):
                (self.known if len(w) <= CACHED_LENGTH else extra)[w] = n
        table = {**self.known, **extra} if extra else self.known
        return [special + sum(map(table.__getitem__, words)) for special, words in found]


def normal(text: str) -> str:
    """The vocabulary's normal form; white space is dropped by the split."""
    if text.isascii():
        return text.lower()
    # One letter at a time: str.lower() alone would write a sigma at a word's end differently.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, `n_bytes`, `n_tokens`, and `over_limit` (more than `limit` tokens).

    `vocabulary` is the path of a tokenizers file: BPE over bytes with word ends, lower case.
    It is read on the driver; its tables, whose size is the file's, go with the tasks.
    Null and empty texts have no bytes and no tokens. Rows are neither joined nor shuffled, so
    repeated rows, null ids and further columns change nothing; an empty table gives an empty one.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    shared = docs.sparkSession.sparkContext.broadcast({k: spec[k] for k in ("model", "added_tokens")})
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = mapped(rows, "doc_id long, n_bytes long, n_tokens long", "text", partial(_count, shared))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _count(shared, part: pa.RecordBatch) -> dict:
    texts = part.column(1)
    return {
        "doc_id": part.column(0),
        "n_bytes": pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()),
        "n_tokens": _counter(shared)(texts.to_pylist()),
    }


_COUNTERS: dict[int, Counter] = {}


def _counter(shared) -> Counter:
    """One counter for each worker process and vocabulary."""
    spec = shared.value
    if id(spec) not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[id(spec)] = Counter(spec)
    return _COUNTERS[id(spec)]
