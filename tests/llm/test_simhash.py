"""Fingerprints, links and components against plain loops."""

import random
import re

import numpy as np
import pytest
import xxhash
from cases import by_id, table

from ebbtide.llm import simhash
from ebbtide.llm.components import components


def plain_fingerprint(text, width=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, edges):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def corpus(draw, n=140):
    """Texts, their near copies by a changed word, and chains of those."""
    texts = []
    while len(texts) < n:
        words = [draw.choice("one two three four Five SIX seven eight nine ten äh öl".split()) + str(draw.randint(0, 30)) for _ in range(draw.randint(0, 260))]
        texts.append(" ".join(words))
        for _ in range(draw.choice([0, 0, 1, 3])):
            if words:
                words = list(words)
                words[draw.randrange(len(words))] = "changed"
                texts.append(draw.choice([" ", "\n"]).join(words))
    return texts


@pytest.mark.parametrize("tile", [4, 1024])
def test_near_duplicates(spark, tile):
    texts = [*corpus(random.Random(tile)), None, "", "a", "A"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    found = by_id(simhash.near_duplicates(table(spark, rows), tile=tile))
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    edges = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 4]
    assert any(len({prints[i], prints[j]}) == 2 for i, j in edges)
    assert {i: r["component_id"] for i, r in found.items()} == plain_components(prints, edges)
    kept = {r["doc_id"] for r in simhash.one_of_each(table(spark, rows), tile=tile).collect()}
    assert kept == {r["component_id"] for r in found.values()}


def test_large_blocks_lose_no_link(spark):
    draw = np.random.default_rng(5)
    centre = draw.integers(-(2**63), 2**63 - 1, 6)
    fps = {int(c) for c in centre}
    for c in centre.tolist():
        for _ in range(60):
            flips = sum(1 << int(b) for b in draw.choice(64, draw.integers(1, 7), replace=False))
            x = (c ^ flips) & (1 << 64) - 1
            fps.add(x - (1 << 64) if x >> 63 else x)
    edges = simhash.near_edges(table(spark, [(f,) for f in fps], "fp long"), 4, tile=8)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    unsigned = {f: f & (1 << 64) - 1 for f in fps}
    true = plain_components(fps, [(a, b) for a in fps for b in fps if a < b and (unsigned[a] ^ unsigned[b]).bit_count() <= 4])
    groups = lambda label: sorted(sorted(n for n in fps if label.get(n, n) == r) for r in {label.get(n, n) for n in fps})
    assert groups(got) == groups(true)


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (100, 101), (200, 200)]
    found = {r["node"]: r["root"] for r in components(table(spark, edges, "a long, b long")).collect()}
    assert len({found[i] for i in range(61)}) == 1
    assert found[100] == found[101] != found[0] and found[200] == 200


def test_a_forest_is_never_larger_than_its_fingerprints():
    alike = np.arange(500, dtype=np.int64) & 15
    fps, label = simhash.forest_of(np.unique(alike), np.zeros(0, np.int64), 4)
    assert len(fps) == 16 and len(set(label.tolist())) == 1
