"""Spelling variants against plain counting and comparison of all words."""

import random
import re
import string
import zlib
from collections import Counter

import pytest
from cases import edge_rows, no_rows, table

from ebbtide.llm import spelling
from ebbtide.llm.spelling import OTHER_GROUPS, SAME_GROUPS, signatures, variants

import numpy as np


def one_apart(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(rows, modulus=199, least_length=6, least=5, ratio=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c in string.ascii_uppercase else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least}
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts.get(form[w], -1)) for w, n in counts.items())


def shown(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


def changed(word, draw):
    at, kind = draw.randrange(len(word)), draw.randrange(3)
    letter = draw.choice("abcdefghijklmnopqrstuvwxyzéßÿ×")
    return word[:at] + (letter if kind else "") + word[at + (kind != 1) :]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(6)
    base = ["".join(draw.choices("abcdeéßno", k=draw.randint(5, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "bananas", "Àéîõüÿ"]
    listed = []
    for word in base:
        chain = [word]
        for step in range(4):
            chain.append(changed(chain[draw.randrange(len(chain))], draw))
        for depth, w in enumerate(chain):
            listed += [w.capitalize() if draw.random() < 0.2 else w] * (700 // 5**depth + draw.randrange(4))
    draw.shuffle(listed)
    return [(i if i % 9 else None, " ".join(listed[i * 50 : i * 50 + 50]) + "\n1_") for i in range(-(-len(listed) // 50))]


def test_against_brute_force(spark, rows):
    df = table(spark, rows, "doc_id long, text string").repartition(4)
    wanted = brute_force(rows)
    assert shown(variants(df)) == wanted
    assert sum(r[1] != "" for r in wanted) > 20 and any(r[1] not in ("", r[2]) for r in wanted)


def test_many_deletions_against_brute_force(spark, rows):
    df = table(spark, rows, "doc_id long, text string").repartition(3)
    assert shown(variants(df, modulus=3, least=2, ratio=2)) == brute_force(rows, modulus=3, least=2, ratio=2)


def test_near_words_always_share_a_signature():
    draw = random.Random(7)
    for _ in range(2000):
        a = "".join(draw.choices("abcé", k=draw.randint(1, 10)))
        b = changed(a, draw)
        if a == b or not b:
            continue
        a, b = sorted((a, b), key=len)
        groups, apart = (SAME_GROUPS, 2) if len(a) == len(b) else (OTHER_GROUPS, 1)
        left, right = signatures([a, b], groups, apart, np.array([len(a)] * 2))
        assert (left == right).any(), (a, b)


def test_letters_outside_of_a_to_z_keep_their_case():
    assert spelling.lowered("ÀBÇ É") == "ÀbÇ É"


def test_hard_rows_and_none(spark):
    hard = [(r["doc_id"], r["text"]) for r in edge_rows(spark).collect()]
    assert shown(variants(edge_rows(spark), least=1)) == brute_force(hard, least=1)
    assert variants(no_rows(spark)).collect() == []


def test_one_word_of_a_third_of_all_rows(spark):
    hot = [(i, "frequent " * 200 + ("frequnt frequemt frequents " if i % 3 == 0 else "seldom ")) for i in range(300)]
    df = table(spark, hot, "doc_id long, text string").repartition(4)
    assert shown(variants(df)) == brute_force(hot)


def test_registered_query_against_brute_force(spark, folder):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert shown(entry.queries()["op12_spelling"](spark, folder)) == brute_force([(d["doc_id"], d["text"]) for d in docs])


def test_signatures_are_not_broadcast_by_the_size_of_the_words(spark):
    counted = spelling.written(table(spark, [("frequent", 9), ("frequnt", 1)], "word string, n long"))
    pairs = spelling.near_pairs(counted)
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert [(r["a"], r["n_a"], r["b"], r["n_b"]) for r in pairs.collect()] == [("frequnt", 1, "frequent", 9)]
