"""Exact dedup of repeated word passages by compaction of a de Bruijn graph of token k-mers.

The edges of the graph are the k-mers (windows of `width` words), its nodes their overlaps.
Consecutive edges of a text that share the place of their minimizer, the m-mer with the lowest
hash, form one path, so a path is one row where its edges would be many; equal edges have equal
minimizers and meet in one bucket. Joins by bucket then tell:
  * a bucket with one path only: nothing in it repeats;
  * every occurrence of the bucket has the same words: the path does not branch, and it is
    repeated as a whole;
  * the bucket holds several different paths, the graph branches there. Paths that occur twice
    are repeated as a whole; of each different path one occurrence is opened into its edges,
    which are counted, so that the others learn where they part.
Occurrences keep their source coordinates. Hashes of 128 bits stand for the words, halves that
are made independently; the words are cut again at the coordinates when spans are taken out.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import mapped, row_key, written
from ebbtide.llm.cuckoo import mix

# Odd bases of the two running sums, and words of an m-mer as a share of the window.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MMER_SHARE = 3
# Windows of one text that are looked at together, and word hashes kept between slices.
SEGMENT, CACHE_SIZE = 1 << 17, 200_000
PATHS = "_id long, _row long, start int, n int, bucket long, path long"


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_SIZE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Sums:
    """Hashes of any run of words from one running sum: a polynomial over the words' hashes."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, hashes: np.ndarray, half: int):
        n = len(hashes)
        up, self.down = self.powers(half, n + 1)
        own = mix(hashes) if half else hashes
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(own * up[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, half: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if half not in cls._powers or len(cls._powers[half][0]) < n:
            size, base = max(n, 1 << 16), BASES[half]
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                both.append(np.cumprod(steps))
            cls._powers[half] = tuple(both)
        return cls._powers[half]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length)


def paths(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, number of windows, bucket and words' hash of each path in one text's word hashes."""
    n = len(hashes) - width + 1
    if n < 1:
        return (np.zeros(0, np.int64),) * 4
    m = max(1, width // MMER_SHARE)
    first, second = Sums(hashes, 0), Sums(hashes, 1)
    at = np.arange(len(hashes) - m + 1)
    value, place = first(at, at + m), at
    # The lowest of the width - m + 1 m-mers of each window, by doubling; the leftmost of equals.
    reach, need = 1, width - m + 1
    while reach < need:
        step = min(reach, need - reach)
        take = value[step:] < value[:-step]
        place = np.where(take, place[step:], place[:-step])
        value = np.where(take, value[step:], value[:-step])
        reach += step
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[start, n])
    return start, count, value[start], second(start, start + count + width - 1)


def text_paths(docs: DataFrame, width: int) -> DataFrame:
    cache = WordHashes()

    def each(part: pa.RecordBatch) -> dict:
        owner, found = [], []
        for i, text in enumerate(part.column(2).to_pylist()):
            hashes = cache.of((text or b"").split())
            for at in range(0, max(0, len(hashes) - width + 1), SEGMENT):
                start, *rest = paths(hashes[at : at + SEGMENT + width - 1], width)
                owner.append(np.full(len(start), i))
                found.append((start + at, *rest))
        if not found:
            return dict.fromkeys(["_id", "_row", "start", "n", "bucket", "path"], [])
        rows = pa.array(np.concatenate(owner))
        start, n, bucket, path = (np.concatenate(c) for c in zip(*found))
        return {
            "_id": part.column(0).take(rows), "_row": part.column(1).take(rows), "start": start.astype(np.int32),
            "n": n.astype(np.int32), "bucket": bucket.view(np.int64), "path": path.view(np.int64),
        }

    return mapped(docs.select("_id", "_row", F.col("text").cast("binary").alias("text")), PATHS, "text", each)


def packed(docs: DataFrame) -> DataFrame:
    """Row key and compressed text: what the joins with coordinates move."""

    def each(part: pa.RecordBatch) -> dict:
        small = zstandard.ZstdCompressor(level=3)
        texts = part.column(3).to_pylist()
        return {c: part.column(i) for i, c in enumerate(["_id", "_row", "doc_id"])} | {"blob": [small.compress(t or b"") for t in texts]}

    rows = docs.select("_id", "_row", "doc_id", F.col("text").cast("binary").alias("text"))
    return mapped(rows, "_id long, _row long, doc_id long, blob binary", "text", each)


def words_of(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split()


def edges(texts: DataFrame, opened: DataFrame, width: int) -> DataFrame:
    """The windows of the opened paths: two hash halves and the source coordinate of each."""
    cache = WordHashes()
    runs = opened.groupBy("_id", "_row").agg(F.collect_set(F.struct("start", "n")).alias("runs"))

    def each(part: pa.RecordBatch) -> dict | None:
        owner, at, halves = [], [], []
        for i, (blob, own) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
            hashes = cache.of(words_of(blob))
            start = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in own])
            owner.append(np.full(len(start), i))
            at.append(start)
            halves.append([Sums(hashes, half)(start, start + width) for half in (0, 1)])
        if not owner:
            return None
        rows = pa.array(np.concatenate(owner))
        columns = {"_id": part.column(0).take(rows), "_row": part.column(1).take(rows), "start": np.concatenate(at).astype(np.int32)}
        return columns | {f"w{k}": np.concatenate([h[k] for h in halves]).view(np.int64) for k in (0, 1)}

    rows = texts.join(runs, ["_id", "_row"]).select("_id", "_row", "blob", "runs")
    return mapped(rows, "_id long, _row long, start int, w0 long, w1 long", "blob", each)


def repeated_spans(docs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Row key, first word and number of words of spans that repeated windows cover."""
    all_paths = written(text_paths(docs, width))
    buckets = all_paths.groupBy("bucket").agg(F.count("*").alias("c"), F.min("path").alias("lo"), F.max("path").alias("hi"))
    # Written, as is `shared` below: Spark splits a hot key of a join only if both sides are dealt for it.
    seen = written(buckets.where("c > 1").select("bucket", (F.col("lo") != F.col("hi")).alias("branches")))
    met = written(all_paths.join(seen, "bucket"))
    covered = F.col("n") + F.lit(width - 1)
    whole = met.where("not branches").select("_id", "_row", "start", covered.alias("words"))
    branching = met.where("branches")
    first = F.min(F.struct("_id", "_row", "start", "n")).alias("first")
    distinct = written(branching.groupBy("bucket", "path").agg(F.count("*").alias("c"), first))
    twice = distinct.where("c > 1").select("bucket", "path")
    also = branching.join(twice, ["bucket", "path"]).select("_id", "_row", "start", covered.alias("words"))
    windows = written(edges(texts, distinct.select("first.*"), width))
    shared = written(windows.groupBy("w0", "w1").agg(F.count("*").alias("c")).where("c > 1").select("w0", "w1"))
    parts = windows.join(shared, ["w0", "w1"]).select("_id", "_row", "start", F.lit(width).alias("words"))
    return whole.unionByName(also).unionByName(parts)


def without_repeats(docs: DataFrame, width: int = 35, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `doc_id`, `n_words`, `n_removed`, `kept` (the words that stay, joined by a space), `kept_sha256`.

    Words are what ASCII white space separates, unchanged. A word goes if a window of `width`
    words that covers it also starts anywhere else, in the same text too; windows are judged on
    the input. Null, empty and shorter texts have no window and lose nothing. Repeated rows are
    two texts that repeat each other. Ids may be null or repeated. Further columns are left out;
    an empty table gives an empty one. A text is split in memory by the task that has it.
    """
    rows = docs.select(*row_key(id_col, text), F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = packed(rows)
    spans = repeated_spans(rows, texts, width)
    # Copies of a row have one key and the same spans; as a set they do not grow with the copies.
    per_row = spans.groupBy("_id", "_row").agg(F.collect_set(F.struct("start", "words")).alias("spans"))
    joined = texts.join(per_row, ["_id", "_row"], "left").select("doc_id", "blob", "spans")

    def each(part: pa.RecordBatch) -> dict:
        sizes, removed, kept = [], [], []
        for blob, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            words = words_of(blob)
            sizes.append(len(words))
            if own:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, [s["start"] for s in own], 1)
                np.add.at(depth, [s["start"] + s["words"] for s in own], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
            removed.append(sizes[-1] - len(words))
            kept.append(b" ".join(words))
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        return {"doc_id": part.column(0), "n_words": sizes, "n_removed": removed, "kept": [k.decode() for k in kept], "kept_sha256": digests}

    return mapped(joined, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string", "blob", each)
