"""Repeated passages against plain counting of windows."""

import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from cases import table

from ebbtide.llm import substring_dedup


def plain(texts, width):
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in texts]
    count = Counter(tuple(ws[i : i + width]) for ws in words for i in range(len(ws) - width + 1))
    result = []
    for ws in words:
        gone = {p for i in range(len(ws) - width + 1) if count[tuple(ws[i : i + width])] > 1 for p in range(i, i + width)}
        kept = " ".join(w for p, w in enumerate(ws) if p not in gone)
        result.append((len(ws), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()))
    return result


def corpus(seed, n=90):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(draw.choice([3, 400]))]
    fresh = lambda k: [draw.choice(words) for _ in range(k)]
    passages = [fresh(draw.randint(5, 60)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [draw.choice(passages) if draw.random() < 0.4 else fresh(draw.randint(0, 40)) for _ in range(draw.randint(0, 6))]
        own = [w for p in parts for w in p]
        if own and draw.random() < 0.3:
            own[draw.randrange(len(own))] = "edited"
        texts.append(draw.choice([" ", "\n", "\t "]).join(own))
    return texts + ["a " * 50, "a b " * 30, "x y z " * 9 + "end", texts[0], None, "", "one"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [35, 7])
def test_against_counting(spark, seed, width):
    texts = corpus(seed)
    found = {r["doc_id"]: r for r in substring_dedup.without_repeats(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), width).collect()}
    wanted = plain(texts, width)
    assert any(w[1] for w in wanted)
    for i, w in enumerate(wanted):
        r = found[i]
        assert (r["n_words"], r["n_removed"], r["kept"], r["kept_sha256"]) == w, i


def test_paths_cover_every_window_once():
    hashes = substring_dedup.WordHashes().of([f"w{i % 90}".encode() for i in range(500)])
    start, n, bucket, _ = substring_dedup.paths(hashes, 35)
    assert np.array_equal(np.concatenate([np.arange(s, s + k) for s, k in zip(start, n)]), np.arange(500 - 34))
    assert n.max() <= 35 - 11 + 1 and len(bucket) == len(start)


def test_segments_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SEGMENT", 16)
    texts = corpus(7, 30)
    found = substring_dedup.without_repeats(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), 20).collect()
    assert {r["doc_id"]: r["kept"] for r in found} == {i: w[2] for i, w in enumerate(plain(texts, 20))}


def test_many_copies_of_one_row(spark):
    """Copies share a row key: the spans found for one must not come once for each copy."""
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(None, text, "en", "s")] * 2000 + [(1, "another text " + " ".join(f"w{i}" for i in range(50, 100)), "en", "s")]
    started = time.monotonic()
    found = substring_dedup.without_repeats(table(spark, rows).repartition(4)).select("doc_id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 400, 400)] * 2000 + [(1, 52, 50)], key=str)
    assert time.monotonic() - started < 60
