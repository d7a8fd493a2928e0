"""Alignment and its spill counting against whole-text encoding and plain counting."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import table

from ebbtide.llm import token_alignment
from ebbtide.llm.token_alignment import RUN, Pair, aligned, merged, run_blob, run_records, unit_pattern

FILES = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
LETTERS = "aAbB'sStTllreve <|>endoftext.,!?12éÉßẞΣσς\t\n\r\x0b\x1c\x85\xa0 ​᠎‍️😀日 \n  ▁;)}{\x00﻿　"


@pytest.fixture(scope="module")
def pair():
    return Pair(*FILES)


def odd_texts(n, seed=5):
    draw = random.Random(seed)
    texts = ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 60))) for _ in range(n)]
    return [*texts, "", " ", "  ", "\n", "a ", "a  b ", "a \n b\n\n", "\t\t x", "<|endoftext|>", "x<s>y</s>", "a▁b", "fn();\r\n  x"]


def whole(pair, text):
    """The tokens of a whole text by both libraries, or none where they spell something else."""
    if not text:
        return [], []
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    raw = (" " + text).encode()
    same = raw == b"".join(pair.a_bytes[i] for i in a) == b"".join(pair.b_bytes[i] for i in b)
    return (a, b) if same else ([], [])


def brute_force(pair, texts):
    rows, held = [], defaultdict(set)
    for doc, text in enumerate(texts):
        a, b = whole(pair, text)
        spans = []
        for ids, table_ in ((a, pair.a_bytes), (b, pair.b_bytes)):
            ends = np.cumsum([len(table_[i]) for i in ids]).tolist()
            spans.append(list(zip(ids, [0, *ends[:-1]], ends)))
        owners = [[n for n, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in spans]
        links = [(a[i], b[j]) for i, j in set(zip(*owners))]
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        sides = [[[] for _ in cuts] for _ in spans]
        for side, listed in zip(sides, spans):
            for x, _, e in listed:
                side[bisect_left(cuts, e)].append(str(x))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides)]
        for link in links:
            held[link].add(doc)
        rows.append((doc, len(a), len(b), len(groups), links, ";".join(groups)))
    highest = Counter()
    for (x, _), docs in held.items():
        highest[x] = max(highest[x], len(docs))
    return [
        (
            doc, n_a, n_b, n_groups, len(links), sum(len(held[p]) == highest[p[0]] for p in links), sum(len(held[p]) for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )
        for doc, n_a, n_b, n_groups, links, groups in rows
    ]


def plain_texts(n, seed=6):
    draw = random.Random(seed)
    letters = "aAbBstTllreve'',.!?<|>09 \n" + "éÉßÿÀ×÷ªº²µ¼" + "".join(map(chr, range(0x21, 0x7F)))
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(n)]


def test_units_give_the_tokens_of_the_whole_text(pair):
    for text in [*odd_texts(4000), *plain_texts(4000)]:
        units = pair.unit.findall(" " + text) if text else []
        assert "".join(units) == (" " + text if text else "")
        a, b = [], []
        for _, x, y in pair.encode(units):
            a, b = a + x, b + y
        raw = (" " + text).encode()
        if b"".join(pair.a_bytes[i] for i in a) == raw == b"".join(pair.b_bytes[i] for i in b):
            assert (a, b) == whole(pair, text)
        else:
            assert whole(pair, text) == ([], [])


def test_pieces_across_words_are_refused():
    with pytest.raises(ValueError):
        unit_pattern(["▁a", "a▁b"])
    with pytest.raises(ValueError):
        unit_pattern(["a\nb"])


def test_aligned():
    assert aligned([1, 2, 3], [1, 2, 1], [7, 8], [1, 3]) == ([(1, 7), (2, 8), (3, 8)], ["1|7", "2,3|8"])


def test_runs_merge_in_order_and_mark_the_highest_count():
    draw = random.Random(2)
    runs, total = [], Counter()
    for _ in range(7):
        own = {(draw.randrange(30) << 32) + draw.randrange(4): draw.randrange(1, 9) for _ in range(200)}
        run = np.array(sorted(own.items()), np.int64)
        runs.append(run_blob(np.rec.fromarrays(run.T, dtype=RUN)))
        total.update(own)
    assert Counter(dict(run_records(runs[0]))) <= total
    pairs, counts, best = merged(runs)
    assert dict(zip(pairs.tolist(), counts.tolist())) == total and pairs.tolist() == sorted(total)
    for p, n, is_best in zip(pairs.tolist(), counts.tolist(), best.tolist()):
        assert is_best == (n == max(c for q, c in total.items() if q >> 32 == p >> 32))


def test_a_long_run_is_read_in_blocks(monkeypatch):
    monkeypatch.setattr(token_alignment, "READ_BYTES", 160)
    run = np.rec.fromarrays([np.arange(0, 5000, 5), np.arange(1000)], dtype=RUN)
    assert list(run_records(run_blob(run))) == list(zip(range(0, 5000, 5), range(1000)))


def shown(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force(spark, pair, monkeypatch):
    texts = [*odd_texts(150, 8), *["the same words again and again"] * 40, None]
    texts += [" ".join(random.Random(i).choices(["token", "tokenize", "Tokenizer's", "für", "12,5", "naïve"], k=30)) for i in range(60)]
    df = table(spark, [(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert shown(token_alignment.alignment(df, *FILES)) == brute_force(pair, texts)


def test_many_segments_and_a_small_cache_change_nothing(spark, pair, monkeypatch):
    texts = odd_texts(60, 9) * 2
    units = token_alignment.Units(pair)
    monkeypatch.setattr(token_alignment, "CACHE_SIZE", 5)
    bodies = [token_alignment.segment_rows(texts[i : i + 7], units, 3) for i in range(0, len(texts), 7)]
    answers = {}
    for part in range(3):
        blobs = [run_blob(runs[part]) for _, runs in bodies if part in runs]
        answers[part] = dict(zip(*[x.tolist() for x in merged(blobs)[:2]]))
    wanted = brute_force(pair, texts)
    for n, (body, runs) in enumerate(bodies):
        counts = [answers[p][k] for p in sorted(runs) for k in runs[p]["pair"].tolist()]
        own = np.zeros(len(body["sums"]), np.int64)
        np.add.at(own, body["held_by"], body["times"] * np.repeat(counts, body["documents"]).astype(np.int64))
        assert own.tolist() == [w[6] for w in wanted[7 * n : 7 * n + 7]]


def test_registered_query_against_brute_force(spark, pair, folder):
    import __spark_entry__ as entry

    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    ids = [d["doc_id"] for d in docs]
    wanted = [(ids[row[0]], *row[1:]) for row in brute_force(pair, [d["text"] for d in docs])]
    assert shown(entry.queries()["op11_alignment"](spark, folder)) == wanted
