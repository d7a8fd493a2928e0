"""Base counts by plain loops, and the distances by numpy."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from cases import table

from ebbtide.llm import quality


def plain_base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    where = defaultdict(list)
    for i in range(len(words) - 7):
        where[tuple(words[i : i + 8])].append(i)
    covered = {p for starts in where.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    return words, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered)


def distance(p, q):
    total = sum(x * math.log2(2 * x / (x + y)) for x, y in zip(p, q) if x) + sum(y * math.log2(2 * y / (x + y)) for x, y in zip(p, q) if y)
    return math.sqrt(max(0, total / 2))


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(4)
    vocabulary = ["the", "of", "and", *[f"w{i}" for i in range(120)], "Ünïcode", "#tag", "a|b"]
    texts = []
    for _ in range(60):
        words = [draw.choice(vocabulary[:3]) if draw.random() < 0.4 else draw.choice(vocabulary) for _ in range(draw.randint(0, 150))]
        if draw.random() < 0.3:
            words += words[:30]
        if draw.random() < 0.2:
            words = ["x", "y"] * 20 + words
        texts.append("\n".join(" ".join(words[i : i + 10]) for i in range(0, len(words), 10)))
    texts += ["same same same same same same same same same", "a\na\n\n \na", None, "", "$$$ " * 60]
    return [(i, t, draw.choice(["en", "de", None]), "s") for i, t in enumerate(texts)]


def test_against_loops(spark, corpus):
    rows = {r["doc_id"]: r for r in quality.judged(table(spark, corpus), least_reference=100, least_share=0.01).collect()}
    base = {i: plain_base(t) for i, t, _, _ in corpus}
    langs = {i: lang or "" for i, _, lang, _ in corpus}
    for i, t, _, _ in corpus:
        words, chars, symbols, lines, repeats = base[i]
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), chars, symbols, lines, repeats), t
        assert r["base_failed"] == (len(words) < 20 or 100 * repeats > 30 * len(words))
    total = {g: Counter(w for i in base if langs[i] == g for w in base[i][0]) for g in set(langs.values())}
    kinds = [r"[a-z]", r"[A-Z]", r"[0-9]", r"[!-/:-@\[-`{-~]"]
    text = {i: "".join(base[i][0]) for i in base}
    by_class = lambda t: [len(re.findall(k, t)) for k in kinds]
    for i in base:
        words, g = base[i][0], langs[i]
        if not words:
            assert rows[i]["class_distance"] is None and not rows[i]["kept"]
            continue
        whole = "".join(text[j] for j in text if langs[j] == g)
        shares = lambda t: [n / len(t) for n in (*by_class(t), len(t) - sum(by_class(t)))]
        assert rows[i]["class_distance"] == pytest.approx(distance(shares(text[i]), shares(whole)), abs=1e-9)
        n = sum(total[g].values())
        common = [w for w, c in total[g].items() if c >= 0.01 * n]
        own = Counter(words)
        p = [own[w] / len(words) for w in common]
        q = [total[g][w] / n for w in common]
        wanted = distance([*p, max(0, 1 - sum(p))], [*q, max(0, 1 - sum(q))])
        assert rows[i]["word_distance"] == pytest.approx(wanted, abs=1e-7)
        near = rows[i]["class_distance"] <= 0.3 and rows[i]["word_distance"] <= 0.5
        assert rows[i]["kept"] == (not rows[i]["base_failed"] and (len(words) < 50 or near))


def test_short_documents_and_references_are_left_alone(spark):
    odd = "QQ!! " * 3 + " ".join(f"Z{i}!!" for i in range(30))
    rows = [(1, odd, "en", "s"), (2, odd + " X" * 2 + " " + " ".join(f"Y{i}!!" for i in range(40)), "xx", "s")]
    found = {r["doc_id"]: r["kept"] for r in quality.judged(table(spark, rows)).collect()}
    assert found == {1: True, 2: True}


def test_no_python_on_the_way(spark, corpus):
    plan = quality.judged(table(spark, corpus))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
