"""Lines against plain counting, and a state that goes back where it came from."""

import random
import re
import time

import numpy as np
import pytest
from cases import table
from pyspark.sql import functions as F

from ebbtide.llm import line_dedup
from ebbtide.llm.batches import written
from ebbtide.llm.cuckoo import Cuckoo


def key(line):
    bare = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)


def plain(rows):
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10 and i is not None:
                holders.setdefault(key(line), set()).add(i)
    result = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        result.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return result


def corpus(seed, n=80):
    draw = random.Random(seed)
    pool = ["A shared line of text", "a SHARED line of text ", "\tÄÖÜ äöüäöü", "ÄÖÜ äöüÄöü", "short", "", "äöüäöüäöü", "äöüäöüäöüä", *[f"another line {i}" for i in range(30)]]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(0, 8))), "en", "s") for i in range(n)]
    return [*rows, (500, None, "en", "s"), (501, "A shared line of text\nA shared line of text", "en", "s"), (7, "Another Line 3\nmore of seven", "en", "s")]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_counting(spark, seed):
    rows = corpus(seed)
    found = line_dedup.dedup_corpus(table(spark, rows)).select("doc_id", "_n_lines", "_n_dropped", "text").collect()
    assert sorted(map(tuple, found)) == sorted(plain(rows))


def contents(state):
    filters = {r["shard"]: Cuckoo.from_bytes(r["filter"]) for r in state.filters.collect()}
    keys = [(r["h1"], r["h2"], r["documents"], r["holder"]) for r in state.counts.collect()]
    prints = sum(int(np.count_nonzero(f.table)) + len(f.stash) for f in filters.values())
    assert prints == len(keys)
    for h1, h2, _, _ in keys:
        assert filters[h1 % state.shards].contains(np.array([h2]))[0]
    return sorted(keys), sorted(map(tuple, state.refs.collect()))


@pytest.mark.parametrize("shard_keys", [8, 1 << 16])
def test_insertions_and_deletions_are_reversible(spark, shard_keys):
    rows = corpus(3, 50)
    lines = lambda part: line_dedup.line_keys(table(spark, part), 10)
    half = line_dedup.insert(line_dedup.empty(spark, shard_keys), lines(rows[:25]))
    both = line_dedup.insert(half, lines(rows[25:]))
    once = line_dedup.insert(line_dedup.empty(spark, shard_keys), lines(rows))
    assert contents(both) == contents(once)
    assert contents(line_dedup.insert(both, lines(rows[:5]))) == contents(both)
    first = {r[0] for r in rows[:25]}
    second = [(r[0],) for r in rows[25:] if r[0] not in first]
    gone = line_dedup.delete(both, spark.createDataFrame(second, "doc_id long"))
    rest = [r for r in rows if r[0] in first]
    assert contents(gone) == contents(line_dedup.insert(line_dedup.empty(spark, shard_keys), lines(rest)))
    found = line_dedup.deduplicated(table(spark, rest), gone, lines(rest)).select("doc_id", "_n_lines", "_n_dropped", "text").collect()
    assert sorted(map(tuple, found)) == sorted(plain(rest))
    nobody = line_dedup.delete(gone, table(spark, rest).select("doc_id"))
    assert contents(nobody) == ([], [])


def test_text_keeps_other_columns(spark):
    docs = table(spark, corpus(4, 10)).withColumn("_id", F.lit(1)).withColumn("h1", F.lit("x"))
    found = line_dedup.dedup_corpus(docs)
    assert found.columns == [*docs.columns, "_n_lines", "_n_dropped"] and found.count() == docs.count()


@pytest.mark.parametrize("room", [1, 1000, 4000])
def test_cuckoo_filter(room):
    draw = np.random.default_rng(room)
    hashes = np.unique(draw.integers(-(2**63), 2**63 - 1, 3000))
    own = Cuckoo(room)
    for part in np.array_split(hashes, 5):
        own.insert(part)
    own = Cuckoo.from_bytes(own.to_bytes())
    assert own.contains(hashes).all()
    assert own.contains(draw.integers(-(2**63), 2**63 - 1, 5000)).mean() < (0.01 if room >= 1000 else 0.5)
    own.delete(hashes[::2])
    assert own.contains(hashes[1::2]).all()
    own.delete(hashes[1::2])
    assert not own.table.any() and not len(own.stash)


def test_batches_leave_the_state_of_one(spark):
    lines = written(line_dedup.line_keys(table(spark, corpus(5)), 10))
    one, many = (line_dedup.inserted(lines, n) for n in (1, 4))
    assert contents(one) == contents(many)


def test_filters_spare_new_keys_the_exact_look_up(spark):
    """Of a second batch, the keys that no document holds yet are told by the filters alone."""
    old = [(i, "\n".join(f"an old line of text {j}" for j in range(i, i + 40)), "en", "s") for i in range(20)]
    new = [(100 + i, "\n".join([f"an old line of text {i}", *[f"a new line of text {j}" for j in range(i, i + 300)]]), "en", "s") for i in range(5)]
    state = line_dedup.inserted(written(line_dedup.line_keys(table(spark, old), 10)), 1)
    batch = line_dedup.line_keys(table(spark, new), 10).select("h1", "h2").distinct()
    probed = line_dedup._by_shard(state, batch, state.filters, "probe").where("h1 is not null")
    known, spared = probed.where("known").count(), probed.where("not known").count()
    assert known + spared == 5 + 304 and 5 <= known <= 8


def test_many_lines_in_one_text(spark):
    shared = [f"a shared line with number {i}" for i in range(0, 50_000, 100)]
    text = "\n".join(f"a shared line with number {i}" for i in range(50_000))
    rows = [(1, "\n".join(shared), "en", "s"), (2, text, "en", "s")]
    started = time.monotonic()
    found = {r["doc_id"]: r for r in line_dedup.dedup_corpus(table(spark, rows)).collect()}
    assert (found[2]["_n_lines"], found[2]["_n_dropped"], found[1]["_n_dropped"]) == (50_000, 500, 0)
    assert found[2]["text"] == "\n".join(line for line in text.split("\n") if line not in set(shared))
    assert time.monotonic() - started < 60
