"""Two tokenizers' tokens aligned on bytes, and how many documents link a pair of ids.

Texts are cut into units that neither tokenizer's tokens cross; a unit is encoded and aligned
once, however often it comes. Pair-document records are counted outside of memory: each segment
of documents sorts its records side-major (by the first id, then the second), partitions them by
radix of the first id, and writes one zstd run for each part. A k-way heap merge over the runs
of a part counts its pairs; as all pairs of a first id follow one another, its highest count is
known as soon as they have passed. Counts go back, run by run, to the segments that asked.

A run holds each pair of its segment once, with the number of its documents, so that a pair of
all documents sends one record per segment; which documents they are stays with the segment.
"""

import hashlib
import heapq
import io
import os
import re
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import importable, pa_schema, slices, written
from ebbtide.llm.token_counts import byte_letters

# A segment holds about so many bytes of text, and one document at least.
SEGMENT_BYTES = 8 << 20
# Units kept between segments, before the cache starts anew.
CACHE_SIZE = 300_000
# Parts of the runs for each shuffle partition, and bytes read from a run at once.
PARTS_PER_PARTITION, READ_BYTES = 4, 1 << 16
# Sentencepiece's letter for a space, and the white space that may begin a unit.
SPACE, BREAKS = "▁", " \t\n\r\v\f"
# A unit of one blank or line end and these characters (ASCII, letters of Latin-1), and the pieces
# that A's split, a fixed value of its format, cuts it into.
PLAIN = re.compile(r"[ \n][!-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \nA-Za-zÀ-ÖØ-öø-ÿ0-9]+|\n")
# Part of the row that holds a segment's documents.
BODY = -1
RUN = np.dtype([("pair", "<i8"), ("n", "<i8")])
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class Pair:
    """Two tokenizers: A byte-level with a leading space given, B by pieces, which adds the space."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        self.model, letters = self.a.model, byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x100)}
        self.pieces: dict[str, list[int]] = {}
        letter = {c: b for b, c in enumerate(letters)}
        size = max(self.a.get_vocab().values()) + 1
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(letter[c] for c in e) if all(c in letter for c in e) else e.encode() for e in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.unit = re.compile(unit_pattern([p for i, p in enumerate(pieces) if not self.b.is_byte(i)]))

    def encode(self, units: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Each unit with its ids; a line end in front keeps B from adding a space, and is taken off."""
        if len(self.pieces) > CACHE_SIZE:
            self.pieces = {}
        b = self.b.encode(["\n" + u for u in units], num_threads=1)
        for unit, right in zip(units, b, strict=True):
            yield unit, self.a_ids(unit), right[2:]

    def a_ids(self, unit: str) -> list[int]:
        """A plain unit is cut here, and its pieces go to the library's model; any other goes through all of the library."""
        if not PLAIN.fullmatch(unit):
            return self.a.encode(unit, add_special_tokens=False).ids
        found = []
        for piece in PIECE.findall(unit):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.pieces[piece] = [t.id for t in self.model.tokenize(piece.translate(self.letters))]
            found += ids
        return found


def unit_pattern(pieces: Iterable[str]) -> str:
    """A unit begins at white space after something else, if no piece of B goes on from there.

    A's pre-tokens never do. What no piece has inside, no merge can cross.
    """
    inner = {c for p in pieces for c in p.lstrip(SPACE)[1:]} | {p[1] for p in pieces if len(p) > 1 and p[0] == SPACE != p[1]}
    breaks = "".join(c for c in BREAKS if (SPACE if c == " " else c) not in inner)
    if " " not in breaks or "\n" not in breaks:
        raise ValueError("pieces cross words or lines: texts cannot be encoded in units")
    other = f"[^\\S{re.escape(breaks)}]"
    return rf"\s*\S+(?:{other}\s*\S*)*|\s+"


def aligned(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> tuple[list[tuple[int, int]], list[str]]:
    """Links and groups of two token rows over the same bytes.

    >>> aligned([1, 2], [2, 1], [7, 8], [1, 2])
    ([(1, 7), (1, 8), (2, 8)], ['1,2|7,8'])
    """
    links, groups = [], []
    i = j = first_a = first_b = 0
    left, right = a_sizes[0], b_sizes[0]
    while True:
        links.append((a[i], b[j]))
        if left == right:
            i, j = i + 1, j + 1
            groups.append(",".join(map(str, a[first_a:i])) + "|" + ",".join(map(str, b[first_b:j])))
            first_a, first_b = i, j
            if i == len(a):
                return links, groups
            left, right = left + a_sizes[i], right + b_sizes[j]
        elif left < right:
            i += 1
            left += a_sizes[i]
        else:
            j += 1
            right += b_sizes[j]


class Units:
    """What is known of each distinct unit: counts, group text, and its links as numbers of pairs."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.a_sizes, self.b_sizes = [len(x) for x in pair.a_bytes], [len(x) for x in pair.b_bytes]
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.shown: list[str] = []
        self.pairs: dict[tuple[int, int], int] = {}
        self.numbers = np.zeros((0, len(NUMBERS) + 1), np.int64)
        self.links = np.zeros(0, np.int64)

    def learn(self, units: set[str]) -> None:
        """Encode and align units that are not known; a unit whose bytes change is marked as lost."""
        new = [u for u in units if u not in self.at]
        numbers, links = [], []
        for unit, a, b in self.pair.encode(new):
            raw = unit.encode()
            whole = raw == b"".join([self.pair.a_bytes[i] for i in a]) == b"".join([self.pair.b_bytes[i] for i in b])
            found, groups = aligned(a, [self.a_sizes[i] for i in a], b, [self.b_sizes[i] for i in b]) if whole else ([], [])
            self.at[unit] = len(self.shown)
            self.shown.append(";".join(groups))
            numbers.append((len(a), len(b), len(groups), len(found), not whole))
            links += [self.pairs.setdefault(p, len(self.pairs)) for p in found]
        if new:
            self.numbers = np.r_[self.numbers, np.array(numbers, np.int64)]
            self.links = np.r_[self.links, np.array(links, np.int64)]

    def keys(self) -> np.ndarray:
        """Pairs by number, as one integer each that sorts side-major."""
        both = np.array(list(self.pairs), np.int64).reshape(-1, 2)
        return both[:, 0] << 32 | both[:, 1]


def segment_rows(texts: list[str | None], units: Units, parts: int) -> tuple[dict[str, np.ndarray], dict[int, np.ndarray]]:
    """A segment's body, and its runs by part."""
    cut = [units.pair.unit.findall(" " + t) if t else [] for t in texts]
    if len(units.at) > CACHE_SIZE:
        units.clear()
    units.learn(set().union(*cut))
    found = [np.fromiter(map(units.at.__getitem__, u), np.int64, len(u)) for u in cut]
    doc = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    flat = np.concatenate([*found, np.zeros(0, np.int64)])
    sums = np.zeros((len(texts), len(NUMBERS) + 1), np.int64)
    for n, f in enumerate(found):
        sums[n] = units.numbers[f].sum(axis=0)
    lost = sums[:, -1] > 0
    sums[lost] = 0
    shown = units.shown
    digests = [
        hashlib.sha256(";".join([shown[i] for i in f.tolist()]).encode()).digest() if len(f) and not gone else bytes(32)
        for f, gone in zip(found, lost, strict=True)
    ]
    doc, flat = doc[~lost[doc]], flat[~lost[doc]]

    # The links of all units in their places: the units' own links, one range after another.
    sizes = units.numbers[:, 3]
    first = np.cumsum(sizes) - sizes
    reps = sizes[flat]
    at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps - first[flat], reps)
    rank, keys = side_major(units, parts)
    records, times = np.unique(rank[units.links[at]] * len(texts) + np.repeat(doc, reps), return_counts=True)
    own, held_by = np.divmod(records, max(1, len(texts)))
    pairs, documents = np.unique(own, return_counts=True)
    run = np.zeros(len(pairs), RUN)
    run["pair"], run["n"] = keys[pairs], documents
    part = part_of(run["pair"], parts)
    ends = np.flatnonzero(np.r_[part[1:] != part[:-1], len(part) > 0]) + 1
    runs = {int(part[e - 1]): run[s:e] for s, e in zip(np.r_[0, ends[:-1]], ends)}
    body = {"sums": sums[:, :-1], "digest": np.frombuffer(b"".join(digests), np.uint8), "documents": documents}
    return body | {"held_by": held_by.astype(np.int32), "times": times.astype(np.int32)}, runs


def side_major(units: Units, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The place of each pair's number in the order of part, first id, second id; and the keys in that order."""
    keys = units.keys()
    order = np.lexsort((keys, part_of(keys, parts)))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, keys[order]


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of a pair: the high digits of its first id's hash, so an id's pairs are together."""
    mixed = (keys >> 32).astype(np.uint64) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
    return (mixed * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.compress(out.getvalue())


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(zstandard.decompress(blob))))


def run_blob(run: np.ndarray) -> bytes:
    """Differences of neighbouring pairs, which compress well, with the pairs' documents."""
    stepped = run.copy()
    stepped["pair"] = np.diff(run["pair"], prepend=0)
    return zstandard.compress(stepped.tobytes())


def run_blocks(blob: bytes) -> Iterator[np.ndarray]:
    """The records of a run, READ_BYTES of them at a time."""
    last = 0
    with zstandard.ZstdDecompressor().stream_reader(blob) as reader:
        while block := reader.read(READ_BYTES):
            run = np.frombuffer(block, RUN).copy()
            run["pair"] = np.cumsum(run["pair"]) + last
            last = run["pair"][-1]
            yield run


def run_records(blob: bytes) -> Iterator[tuple[int, int]]:
    for run in run_blocks(blob):
        yield from zip(run["pair"].tolist(), run["n"].tolist())


def merged(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs of a part in side-major order, their documents, and whether no pair of the id has more."""
    stream = groupby(heapq.merge(*map(run_records, blobs)), key=itemgetter(0))
    counted = np.fromiter(((pair, sum(n for _, n in same)) for pair, same in stream), RUN)
    first = counted["pair"] >> 32
    starts = np.flatnonzero(np.r_[len(first) > 0, first[1:] != first[:-1]])
    highest = np.maximum.reduceat(counted["n"], starts) if len(starts) else counted["n"]
    best = counted["n"] == np.repeat(highest, np.diff(np.r_[starts, len(first)]))
    return counted["pair"], counted["n"], best


def count_part(table: pa.Table) -> pa.Table:
    """The runs of one part, each answered with its pairs' counts over all runs."""
    blobs = table.column("blob").to_pylist()
    pairs, counts, best = merged(blobs)
    answers = []
    for blob in blobs:
        at = np.searchsorted(pairs, np.concatenate([b["pair"] for b in run_blocks(blob)]))
        answers.append(packed({"n": counts[at], "best": best[at]}))
    return table.set_column(table.schema.get_field_index("blob"), "blob", pa.array(answers, pa.binary()))


def finish(table: pa.Table) -> pa.Table:
    """The documents of one segment, from its body and the answers to its runs."""
    rows = sorted(table.select(["part", "blob"]).to_pylist(), key=lambda r: r["part"])
    body, answers = unpacked(rows[0]["blob"]), [unpacked(r["blob"]) for r in rows[1:]]
    n = np.concatenate([*[a["n"] for a in answers], np.zeros(0, np.int64)])
    best = np.concatenate([*[a["best"] for a in answers], np.zeros(0, bool)])
    pair = np.repeat(np.arange(len(n)), body["documents"])
    held_by, times = body["held_by"], body["times"].astype(np.int64)
    size = len(body["sums"])
    n_best, count_sum = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(n_best, held_by, times * best[pair])
    np.add.at(count_sum, held_by, times * n[pair])
    digests = body["digest"].tobytes()
    shown = [digests[32 * i : 32 * i + 32].hex() if body["sums"][i, 0] else "" for i in range(size)]
    ids = pa.array(body["doc_id"], mask=body["no_id"])
    columns = [ids, *[pa.array(c) for c in body["sums"].T], pa.array(n_best), pa.array(count_sum), pa.array(shown, pa.string())]
    return pa.table(columns, names=["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"])


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices gathered to about SEGMENT_BYTES of text."""
    held, size = [], 0
    for part in slices(batches, "text"):
        held.append(part)
        size += part.column(1).nbytes
        if size >= SEGMENT_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


_UNITS: dict[tuple, Units] = {}


def _units(files: tuple[str, str]) -> Units:
    """One cache for each worker process and pair of files."""
    if files not in _UNITS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _UNITS.clear()
        _UNITS[files] = Units(Pair(*files))
    return _UNITS[files]


def _encoded(files: tuple[str, str], parts: int, target: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    for n, held in enumerate(segments(batches)):
        rows = pa.Table.from_batches(held)
        body, runs = segment_rows(rows.column("text").to_pylist(), _units(files), parts)
        ids = rows.column("doc_id").combine_chunks()
        body["doc_id"] = ids.fill_null(0).to_numpy()
        body["no_id"] = ids.is_null().to_numpy(zero_copy_only=False)
        blobs = {BODY: packed(body)} | {part: run_blob(run) for part, run in runs.items()}
        segment = [task << 32 | n] * len(blobs)
        yield pa.RecordBatch.from_arrays([pa.array(segment), pa.array(list(blobs), pa.int32()), pa.array(list(blobs.values()))], schema=target)


def alignment(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, `n_a`, `n_b` tokens, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    Null and empty texts, and those whose tokens of either side spell something else, have no
    tokens: zeros and an empty digest. Every row is a document of its own, repeated rows too;
    ties for the highest count all count. Further columns are not read; an empty table gives an
    empty one. Files are read where the work is done, so every worker needs them at their paths.

    Runs and bodies are written once, in the shared folder. A part is merged in one task: its
    size is that of its runs, which hold a pair once a segment; parts grow in number with
    spark.sql.shuffle.partitions.
    """
    spark = docs.sparkSession
    importable(spark)
    schema = "segment long, part int, blob binary"
    parts = PARTS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    encoded = written(rows.mapInArrow(partial(_encoded, (byte_file, piece_file), parts, pa_schema(spark, schema)), schema))
    answers = encoded.where(F.col("part") != BODY).groupBy("part").applyInArrow(count_part, schema)
    whole = encoded.where(F.col("part") == BODY).unionByName(answers)
    columns = ["doc_id", *NUMBERS, "n_best", "count_sum"]
    return whole.groupBy("segment").applyInArrow(finish, ", ".join(f"{c} long" for c in columns) + ", groups_sha256 string")
