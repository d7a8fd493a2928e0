"""The stages on the test documents: each one's decisions, and that clean documents stay."""

import random
import re
from pathlib import Path

import corpus_pipeline
import pytest
from cases import table
from test_mixing import plain_targets
from test_simhash import corpus as near_copies
from test_simhash import plain_components, plain_fingerprint

from ebbtide.llm.batches import passing, written
from ebbtide.operators.lineage import checkpoint_dir


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    result = [docs]
    for _, stage in corpus_pipeline.STAGES:
        result.append(written(stage(spark, result[-1], folder)))
    return result


def test_columns_and_order(steps):
    for frame in steps[1:-1]:
        assert frame.columns == steps[0].columns
    assert steps[-1].columns == [*steps[0].columns, "copies"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "mixing"]


def test_decisions(spark, steps, folder):
    rows = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    raw, known, lines, single, clean, mixed = rows
    assert len(known) >= 0.99 * len(raw)
    keys = {}
    for i, r in lines.items():
        assert r["n_chars"] == len(r["text"])
        for line in r["text"].split("\n"):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if len(bare) >= 10:
                keys.setdefault(bare, set()).add(i)
    assert all(len(k) == 1 for k in keys.values())
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    items = [plain(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaked = {i for i, r in single.items() if any(q in plain(r["text"]) for q in items)}
    assert set(clean) == set(single) - leaked
    assert set(mixed) <= set(clean) and all(1 <= r["copies"] <= 3 for r in mixed.values())


def test_run_is_the_stages(spark, steps, folder):
    assert sorted(corpus_pipeline.run(spark, folder).collect()) == sorted(steps[-1].collect())


def one_of_each(docs):
    """The smallest id of each group, by all pairs of fingerprints."""
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    ids = sorted(prints)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    label = plain_components(ids, edges)
    return {i for i in ids if label[i] == i}


def test_one_of_each_group_of_near_duplicates(spark, steps):
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    assert {r["doc_id"] for r in steps[3].collect()} == one_of_each(before)
    texts = dict(enumerate(near_copies(random.Random(4), 90)))
    docs = table(spark, [(i, t, "en", "s") for i, t in texts.items()])
    found = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert found == one_of_each(texts) and len(found) < len(texts)


def test_the_mix_is_near_its_targets(steps):
    clean, mixed = steps[4].collect(), {r["doc_id"]: r["copies"] for r in steps[5].collect()}
    size = {r["doc_id"]: len([w for w in re.split(r"[\x20\x09-\x0D]+", r["text"] or "") if w]) for r in clean}
    whole, taken = {}, {}
    for r in clean:
        whole[r["source"]] = whole.get(r["source"], 0) + size[r["doc_id"]]
        taken[r["source"]] = taken.get(r["source"], 0) + size[r["doc_id"]] * mixed.get(r["doc_id"], 0)
    for source, target in plain_targets(whole).items():
        # What is left is less than the smallest document that could still move.
        off = taken[source] - target
        own = [r["doc_id"] for r in clean if r["source"] == source and size[r["doc_id"]]]
        movable = [size[i] for i in own if (mixed.get(i, 0) > 0 if off > 0 else mixed.get(i, 0) < 3)]
        assert abs(off) < min(movable, default=float("inf")) + 1e-6, source


def test_tables_in_passing_are_removed(spark):
    folder = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    with passing(spark) as made:
        written(spark.range(3))
        with passing(spark):
            written(spark.range(4))
        kept = written(spark.range(5))
        path = made.pop()
    assert {p.name for p in folder.iterdir()} - before == {Path(path).name} and kept.count() == 5


def test_run_leaves_its_result_alone(spark, folder):
    place = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = {p.name for p in place.iterdir() if p.name.startswith("table-")}
    rows = corpus_pipeline.run(spark, folder)
    assert len({p.name for p in place.iterdir() if p.name.startswith("table-")} - before) == 1 and rows.count() > 0
