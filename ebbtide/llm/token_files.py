"""Token ids of a corpus in shards, each a wavelet matrix in one compressed file.

Texts are encoded where they lie; ids, not texts, are dealt into ranges of document ids, and
every task writes its range as shards of bounded size. The files are in the folder that all
executors share; Spark's own table of shards names those of finished attempts, so files that a
lost executor left behind are never read.
"""

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ebbtide.llm.batches import importable, mapped, pa_schema, written
from ebbtide.llm.token_counts import byte_letters
from ebbtide.llm.vocabulary import Known, split
from ebbtide.llm.wavelet import WaveletMatrix, planes_of
from ebbtide.llm.wavelet import packed as packed_matrix
from ebbtide.operators.lineage import checkpoint_dir

# Ids of one shard, unless its last document has more.
SHARD_IDS = 1 << 22
# Words kept between slices, before the cache starts anew.
WORDS_KEPT = 1_000_000
# Text of these characters alone (ASCII, letters of Latin-1, general punctuation) is in its normal
# form once it is in lower case, and PART cuts it as the vocabulary's split does.
PLAIN_LETTERS = r" \t\n\r!-~À-ÖØ-öø-ÿ\u2010-\u2027\u2030-\u205e"
PLAIN = re.compile(f"[{PLAIN_LETTERS}]*")
NOT_PLAIN = re.sub(r"\\u(\w{4})", r"\\x{\1}", f"[^{PLAIN_LETTERS}]|<\\|")
PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\ra-zß-öø-ÿ0-9]+")
SHARDS = "part int, shard int, path string, local_start long, n_ids long, n_docs long"


def words(texts: pa.Array) -> pa.Array:
    """What ASCII white space separates, by text: the split drops white space, and no token or special
    string has any. Plain text is put in lower case, as the vocabulary does."""
    texts = pc.fill_null(texts, "")
    plain = pc.invert(pc.match_substring_regex(texts, NOT_PLAIN))
    return split(pc.if_else(plain, pc.utf8_lower(texts), texts))


class Encoder:
    """Ids by the tokenizers library, which sees each distinct word of the texts once."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.model = self.library.model
        self.kind = id_kind(self.library.get_vocab_size())
        self.words = Known(self.kind)
        # The byte alphabet's letters for what is not ASCII in plain words.
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x2060) if PLAIN.fullmatch(chr(c))}

    def ids_of(self, word: str) -> list[int]:
        """A plain word is cut here, and its parts go to the library's model; any other goes through all of the library."""
        if not PLAIN.fullmatch(word) or "<|" in word:
            return self.library.encode(word, add_special_tokens=False).ids
        tokenize, letters = self.model.tokenize, self.letters
        return [t.id for part in PART.findall(word.lower()) for t in tokenize(part if part.isascii() else part.translate(letters))]

    def __call__(self, texts: pa.Array, end: int) -> list[bytes]:
        """Each text's ids and `end`, as little-endian integers of the vocabulary's width."""
        if len(self.words) > WORDS_KEPT:
            self.words = Known(self.kind)
        cut = words(texts)
        numbers = self.words.numbers(cut)
        self.words.learn([self.ids_of(w) for w in self.words.new])
        ids = self.words.of(numbers).tobytes()
        ends = (self.words.ends(cut, numbers) * self.kind.itemsize).tolist()
        last = np.array([end], self.kind).tobytes()
        return [ids[s:e] + last for s, e in zip([0, *ends[:-1]], ends)]


def id_kind(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


_ENCODERS: dict[str, Encoder] = {}


def _encode(vocabulary: str, end: int, part: pa.RecordBatch) -> dict:
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return {"doc_id": part.column(0), "ids": _ENCODERS[vocabulary](part.column(1), end)}


def shared_file(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a Hadoop path, and the path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def save(path: str, data: bytes) -> None:
    """The file appears whole: it is written under another name first."""
    system, place = shared_file(path)
    with system.open_output_stream(f"{place}.part") as out:
        out.write(data)
    system.move(f"{place}.part", place)


def load(path: str) -> WaveletMatrix:
    system, place = shared_file(path)
    with system.open_input_stream(place) as file:
        return WaveletMatrix(file.read())


def shard_file(ids: list[bytes], doc_ids: list[int | None], kind: np.dtype, planes: int) -> bytes:
    """One shard: the ids of all its documents, with each one's id and length in the side table."""
    lengths = np.array([len(i) for i in ids], np.int64) // kind.itemsize
    side = pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_ids": pa.array(lengths)})
    return packed_matrix(np.frombuffer(b"".join(ids), kind), planes, side)


def _write(folder: str, kind: np.dtype, planes: int, size: int, target: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    ids, doc_ids, held, shard, start = [], [], 0, 0, 0

    def full() -> pa.RecordBatch:
        path = f"{folder}/{part:06d}-{shard:06d}-{attempt}.wm"
        save(path, shard_file(ids, doc_ids, kind, planes))
        return pa.RecordBatch.from_pylist(
            [{"part": part, "shard": shard, "path": path, "local_start": start, "n_ids": held, "n_docs": len(ids)}], schema=target
        )

    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids.append(raw)
            doc_ids.append(doc_id)
            held += len(raw) // kind.itemsize
            if held >= size:
                yield full()
                ids, doc_ids, held, shard, start = [], [], 0, shard + 1, start + held
    if ids:
        yield full()


def write_shards(docs: DataFrame, vocabulary: str, end: int, id_col: str = "doc_id", text: str = "text", size: int = SHARD_IDS) -> DataFrame:
    """The corpus as shard files in ascending order of document ids; returns the table of shards.

    Per shard: `part` and `shard` (their order is that of the ids), `path`, `start` (ids of all
    shards before it), `n_ids`, `n_docs`. Every document ends with `end`, which null and empty
    texts alone have. Null ids come first; rows of one id are next to one another, each a
    document of its own, and may be dealt into different shards, so no id is too frequent for a
    task. An empty table gives no shard. Further columns are not read. Every worker needs the
    vocabulary's file at its path.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    importable(spark)
    vocab = Tokenizer.from_file(vocabulary).get_vocab_size()
    folder = f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    system, place = shared_file(folder)
    system.create_dir(place)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    encoded = written(mapped(rows, "doc_id long, ids binary", "text", partial(_encode, vocabulary, end)))
    order = [F.asc_nulls_first("doc_id"), F.asc("_at")]
    dealt = encoded.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    write = partial(_write, folder, id_kind(vocab), planes_of(max(vocab - 1, end)), size, pa_schema(spark, SHARDS))
    shards = written(dealt.select("doc_id", "ids").mapInArrow(write, SHARDS))
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select("part", before.alias("_before"))
    return shards.join(starts, "part").select("part", "shard", "path", (F.col("_before") + F.col("local_start")).alias("start"), "n_ids", "n_docs")


def _read(target: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            matrix = load(row["path"])
            values = matrix.values().astype("<u4")
            ends = np.cumsum(matrix.side.column("n_ids").to_numpy())
            starts = np.r_[0, ends[:-1]]
            crcs = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(starts.tolist(), ends.tolist())]
            columns = [matrix.side.column("doc_id").combine_chunks(), pa.array(row["start"] + starts), pa.array(ends - starts), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=target)


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, read back from the files: `doc_id`, `start` (ids of all documents before it),
    `n_tokens`, and `ids_crc32` of its ids as little-endian 32-bit integers."""
    spark = shards.sparkSession
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("path", "start").repartition(tasks).mapInArrow(partial(_read, pa_schema(spark, schema)), schema)


def token_files(docs: DataFrame, vocabulary: str, end: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents encoded, written as shards, and read back: see `write_shards` and `read_documents`."""
    return read_documents(write_shards(docs, vocabulary, end, id_col, text))
