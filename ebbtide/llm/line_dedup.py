"""Incremental, reversible line dedup: sharded cuckoo filters before exact reference counts.

The state holds, for every line key, one reference for each document that has it (exact), the
counts of these, and a cuckoo filter of the keys for each shard of the key space. A batch of
documents is probed against the filters first: only keys that the filter may hold are looked up
in the counts, all others are new for certain. Taking documents out lowers the counts and
deletes the keys that nobody holds any more from the filters, after which the state is as if
those documents had never been there.
"""

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.binding import let
from ebbtide.llm.batches import importable, keyed, mapped, row_key, written
from ebbtide.llm.cuckoo import Cuckoo

SPACE = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
KEY = ["h1", "h2"]
# Batches that a corpus is inserted in.
BATCHES = 3
LINES = "_id long, _row long, doc_id long, line int, h1 long, h2 long"


@dataclass
class State:
    """What is known of the documents so far; every frame is written in the shared folder."""

    refs: DataFrame  # h1, h2, doc_id: distinct
    counts: DataFrame  # h1, h2, documents, holder (smallest doc_id)
    filters: DataFrame  # shard, filter
    shards: int
    shard_keys: int  # what a shard's filter is made for


def line_key(line: bytes, least: int) -> bytes | None:
    key = line.strip(SPACE).translate(LOWER)
    if len(key) >= 4 * least or len(key) >= least and len(key.decode()) >= least:
        return key
    return None


def line_keys(docs: DataFrame, least: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line whose key has `least` code points or more: row key, doc_id, line number, 128-bit key hash."""
    rows = docs.select(*row_key(id_col, text), F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    digest = xxhash.xxh3_128_digest

    def each(part: pa.RecordBatch) -> dict:
        owner, number, found = [], [], []
        for i, t in enumerate(part.column(3).to_pylist()):
            for n, line in enumerate((t or b"").split(b"\n")):
                key = line_key(line, least)
                if key is not None:
                    owner.append(i)
                    number.append(n)
                    found.append(digest(key))
        halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        columns = {c: part.column(k).take(pa.array(owner, pa.int32())) for k, c in enumerate(["_id", "_row", "doc_id"])}
        return columns | {"line": number, "h1": halves[:, 0], "h2": halves[:, 1]}

    return mapped(rows, LINES, "text", each)


def empty(spark: SparkSession, shard_keys: int = 1 << 13) -> State:
    """A state without documents."""
    return State(
        spark.createDataFrame([], "h1 long, h2 long, doc_id long"),
        spark.createDataFrame([], "h1 long, h2 long, documents long, holder long"),
        spark.createDataFrame([], "shard int, filter binary"),
        1,
        shard_keys,
    )


def _counted(refs: DataFrame) -> DataFrame:
    return refs.groupBy(*KEY).agg(F.count("*").alias("documents"), F.min("doc_id").alias("holder"))


def _by_shard(state: State, keys: DataFrame, filters: DataFrame, action: str) -> DataFrame:
    """Probes, or changes, the filter of each shard with the shard's keys.

    Rows: the key and whether the filter may hold it, and the shard's filter afterwards in a
    row without a key. A key is one row here however many documents hold it, and a shard has a
    bounded number of keys.
    """
    shard = F.pmod("h1", F.lit(state.shards)).cast("int").alias("shard")
    capacity = state.shard_keys

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        number = (left if left.num_rows else right).column("shard")[0].as_py()
        keys = left.column("h2").to_numpy()
        cuckoo = Cuckoo.from_bytes(right.column("filter")[0].as_py()) if right.num_rows else Cuckoo(capacity)
        known = cuckoo.contains(keys)
        if action == "insert":
            cuckoo.insert(keys)
        elif action == "delete":
            cuckoo.delete(keys)
        n, h1, h2 = len(keys), left.column("h1").to_pylist(), keys.tolist()
        columns = [[number] * n + [number], [*h1, None], [*h2, None], [*known.tolist(), None], [None] * n + [cuckoo.to_bytes()]]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    names = ["shard", *KEY, "known", "filter"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    schema = "shard int, h1 long, h2 long, known boolean, filter binary"
    importable(keys.sparkSession)
    return keys.select(shard, *KEY).groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, schema)


def _filters(state: State, keys: DataFrame, action: str) -> DataFrame:
    changed = _by_shard(state, keys, state.filters, action)
    return written(changed.where("filter is not null").select("shard", "filter"))


def _resharded(state: State, more: int) -> State:
    """With filters that have room for `more` keys: more shards, filled again from the exact counts."""
    total = state.counts.count() + more
    if total <= state.shards * state.shard_keys:
        return state
    wider = replace(state, shards=-(-2 * total // state.shard_keys), filters=state.filters.limit(0))
    return replace(wider, filters=_filters(wider, state.counts.select(*KEY), "insert"))


def insert(state: State, lines: DataFrame) -> State:
    """The state with the documents of `lines` (see `line_keys`) added.

    A document that is there already adds what is new in it; a null doc_id holds nothing.
    """
    refs = written(lines.where("doc_id is not null").select(*KEY, "doc_id").distinct())
    batch = written(_counted(refs))
    state = _resharded(state, batch.count())
    probed = written(_by_shard(state, batch, state.filters, "probe").where("h1 is not null").select(*KEY, "known"))
    # Exact look-up for the keys that the filters may hold, and for no other.
    old = state.counts.join(probed.where("known").select(*KEY), KEY, "left_semi")
    before = state.refs.join(old.select(*KEY), KEY, "left_semi")
    fresh = refs.join(before, [*KEY, "doc_id"], "left_anti")
    added = probed.select(*KEY).join(old.select(*KEY), KEY, "left_anti")
    updated = old.unionByName(_counted(fresh)).groupBy(*KEY).agg(F.sum("documents").alias("documents"), F.min("holder").alias("holder"))
    untouched = state.counts.join(updated.select(*KEY), KEY, "left_anti")
    return replace(
        state,
        # What is there stays where it is; only what is new is written.
        refs=state.refs.unionByName(written(fresh)),
        counts=written(untouched.unionByName(updated)),
        filters=_filters(state, added, "insert"),
    )


def delete(state: State, ids: DataFrame) -> State:
    """The state without the documents in `ids` (one column, doc_id)."""
    gone = written(state.refs.join(ids.toDF("doc_id").distinct(), "doc_id", "left_semi").select(*KEY, "doc_id"))
    refs = written(state.refs.join(gone, [*KEY, "doc_id"], "left_anti"))
    touched = gone.select(*KEY).distinct()
    left = written(_counted(refs.join(touched, KEY, "left_semi")))
    dead = touched.join(left, KEY, "left_anti")
    counts = state.counts.join(touched, KEY, "left_anti").unionByName(left)
    return replace(state, refs=refs, counts=written(counts), filters=_filters(state, dead, "delete"))


def dropped_lines(state: State, lines: DataFrame) -> DataFrame:
    """Line numbers to drop by row: keys that two documents or more hold, outside their holder."""
    shared = state.counts.where("documents > 1").select(*KEY, "holder")
    other = lines.join(shared, KEY).where("doc_id is null or doc_id <> holder")
    return other.groupBy("_id", "_row").agg(F.collect_set("line").alias("_drop"))


def deduplicated(docs: DataFrame, state: State, lines: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the dropped lines taken out of `text`, and `_n_lines` (before) and `_n_dropped`.

    Lines are what \\n separates; a null or empty text is one empty line, and comes out empty.
    """
    rows = keyed(docs, id_col, text).join(dropped_lines(state, lines), ["_id", "_row"], "left")
    whole = F.coalesce(F.col(f"_all.`{text}`"), F.lit(""))
    parts = F.split(whole, "\n")

    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
        return F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")

    # Bound, so that a text is split once and not for each of its lines.
    cut = F.when(F.col("_drop").isNull(), whole).otherwise(let(parts, kept))
    return rows.select(
        *[cut.alias(c) if c == text else F.col(f"_all.`{c}`").alias(c) for c in docs.columns],
        F.size(parts).cast("long").alias("_n_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("_n_dropped"),
    )


def inserted(lines: DataFrame, batches: int = BATCHES) -> State:
    """The state of all documents of `lines`, inserted in batches by a hash of their ids.

    From the second batch on, the filters tell which keys are new for certain; only the others are
    looked up in the counts.
    """
    state = empty(lines.sparkSession)
    for n in range(batches):
        state = insert(state, lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == n))
    return state


def dedup_corpus(docs: DataFrame, least: int = 10, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """All `docs` inserted into an empty state and freed of repeated lines: see `inserted`, `deduplicated`.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased.
    Keys of `least` code points or more that two documents hold lose all lines except in the
    document with the smallest id; a document may keep several of its own. Ties cannot occur:
    rows with one id are one document. A row without an id holds no key and loses each line
    that some other documents share. Further columns stay; an empty table gives an empty one.
    """
    lines = written(line_keys(docs, least, id_col, text))
    return deduplicated(docs, inserted(lines), lines, id_col, text)


def digests(rows: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    return rows.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col(text), 256).alias("kept_sha256"),
    )
