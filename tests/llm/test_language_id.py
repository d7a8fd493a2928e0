"""Held-out accuracy, and the network's answers and gradients."""

import zlib

import numpy as np
from cases import by_id, table

from ebbtide.llm import language_id
from ebbtide.llm.language_id import Network, Settings, windows_of


def test_held_out_accuracy(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    found = by_id(language_id.languages(docs))
    held = [i for i, r in found.items() if r["held_out"]]
    assert set(held) == {i for i in found if zlib.crc32(str(i).encode()) % 5 == 0} and len(held) > 20
    assert np.mean([found[i]["lang_pred"] == truth[i] for i in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_labels_of_the_held_out_are_not_seen(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(150)
    hidden = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 'xx' ELSE lang END AS lang", "'?' AS source")
    assert sorted(language_id.languages(docs).collect()) == sorted(language_id.languages(hidden).collect())


def test_texts_without_letters_and_without_labels(spark):
    rows = [(1, "12 !?", "en", "s"), (2, None, "en", "s"), (3, "", None, "s"), (4, "words here", None, "s")]
    found = by_id(language_id.languages(table(spark, rows)))
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3))
    assert found[4]["lang_pred"] == "en"
    unlabelled = by_id(language_id.languages(table(spark, [(i, t, None, "s") for i, t, *_ in rows])))
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in unlabelled.values())


def test_windows_overlap_and_cover():
    s = Settings(window=16)
    text = bytes(range(97, 123)) * 3
    cut = windows_of(text, s)
    assert cut[0].tobytes() == text[:16] and s.stride == 13
    assert b"".join(c[: s.stride].tobytes() for c in cut[:-1]) + cut[-1].tobytes().rstrip(b"\0") == text
    assert len(windows_of(b"", s)) == 1 and not windows_of(b"", s).any()


def test_tables_answer_like_the_layers():
    s = Settings(window=20, filters=3, embedding=4)
    net = Network(s, ["a", "b", "c"]).start()
    draw = np.random.default_rng(0)
    for k in s.widths:
        net.weights[f"shift{k}"] = draw.normal(size=3).astype(np.float32)
    x = draw.integers(1, 256, (7, 20)).astype(np.uint8)
    pooled = []
    places = 20 - max(s.widths) + 1
    for k in s.widths:
        answer = (net._spread(x, k) @ net.weights[f"conv{k}"])[:, :places]
        pooled.append(np.maximum(answer.max(axis=1) + net.weights[f"shift{k}"], 0))
    wanted = language_id.softmax(np.concatenate(pooled, axis=1) @ net.weights["out"] + net.weights["bias"])
    assert np.allclose(net.apply(x, net.tables(), chunk=3), wanted, atol=1e-5)


def test_gradients():
    s = Settings(window=12, widths=(2, 3), filters=2, embedding=3)
    net = Network(s, ["a", "b"]).start()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    draw = np.random.default_rng(1)
    x, y = draw.integers(1, 40, (5, 12)).astype(np.uint8), np.array([0, 1, 0, 1, 1])

    def loss():
        pooled = [np.maximum((net._spread(x, k) @ net.weights[f"conv{k}"]).max(axis=1) + net.weights[f"shift{k}"], 0) for k in s.widths]
        p = language_id.softmax(np.concatenate(pooled, axis=1) @ net.weights["out"] + net.weights["bias"])
        return -np.log(p[np.arange(5), y]).mean()

    for name, g in net.gradients(x, y).items():
        for at in [tuple(draw.integers(0, n) for n in g.shape) for _ in range(12)]:
            if name == "embed" and at[0] == 0:
                continue
            was = net.weights[name][at]
            net.weights[name][at] = was + 1e-6
            up = loss()
            net.weights[name][at] = was - 1e-6
            down = loss()
            net.weights[name][at] = was
            assert abs((up - down) / 2e-6 - g[at]) < 1e-4, (name, at)
