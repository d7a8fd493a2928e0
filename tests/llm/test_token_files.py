"""Token files: round trips through the file format, look-ups, order, and the library's ids."""

import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import table
from tokenizers import Tokenizer

from ebbtide.llm import token_files, wavelet
from ebbtide.llm.token_files import Encoder, load, read_documents, write_shards
from ebbtide.llm.wavelet import WaveletMatrix, packed, planes_of

PATH = public_tokenizers.path("word_bpe_49k.json")
SIDE = pa.table({"doc_id": pa.array([1, None], pa.int64())})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def matrix(values, kind=np.uint16):
    values = np.array(values, kind)
    return WaveletMatrix(packed(values, planes_of(int(values.max(initial=0))), SIDE))


@pytest.mark.parametrize("size, largest", [(0, 1), (1, 0), (7, 3), (64, 1), (1000, 49407), (5000, 9), (3000, 100_000)])
def test_round_trip_and_look_ups(monkeypatch, size, largest):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 256)
    draw = np.random.default_rng(size)
    values = draw.integers(0, largest + 1, size)
    m = matrix(values, np.uint16 if largest < 1 << 16 else np.uint32)
    assert m.values().tolist() == values.tolist() and m.side.equals(SIDE)
    for place in draw.integers(0, size, 20).tolist() if size else []:
        value = int(values[place])
        assert m.access(place) == value
        assert m.count(value) == int((values == value).sum())
        start, end = sorted(draw.integers(0, size + 1, 2).tolist())
        assert m.count(value, start, end) == int((values[start:end] == value).sum())
        nth = int((values[:place] == value).sum())
        assert m.select(value, nth) == place
    assert m.count(largest + 1) == 0
    with pytest.raises(IndexError):
        m.select(largest + 1, 0)
    with pytest.raises(IndexError):
        m.access(size)


def test_another_file_is_refused():
    with pytest.raises(ValueError):
        WaveletMatrix(b"something else, and long enough for a head")


def test_words_give_the_ids_of_the_whole_text(library):
    draw = random.Random(3)
    letters = "aAbB'sStTllreve <|>endoftext.,!?12éÉßẞΣσς\t\n\x0b\x1c\x85\xa0 ‍́😀日"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    ascii_only = [chr(c) for c in [*range(1, 256), *range(0x2000, 0x2070)]]
    texts += ["".join(draw.choice(ascii_only) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["I'LL go, it's 1234x<|endoftext|>y", "<|EndOfText|>", "a<|startoftext|>b", "x<|", "|>y", "don't''d", "A1b2C3...!!a"]
    texts += ["", None, "a" * 3001, "ΑΣ ΣΑΣ.", "<|endoftext|>a<|startoftext|> <|endoftext|>", "x\x1cy\x85w​q　l", "e ́ é"]
    encoder = Encoder(PATH)
    found = [np.frombuffer(raw, encoder.kind).tolist() for raw in encoder(pa.array(texts, pa.string()), 2)]
    assert found == [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_KEPT", 3)
    encoder = Encoder(PATH)
    for text in ["one two, three", "Two 22 one", "für one", "three. two", ""] * 2:
        (raw,) = encoder(pa.array([text]), 2)
        assert np.frombuffer(raw, encoder.kind).tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]


def wanted(library, rows):
    """Rows in file order, by plain counting."""
    start, found = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_files_of_few_ids_against_brute_force(spark, library):
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices(["one", "Two", "three's", "4", "fünf"], k=draw.randint(0, 50)))) for i in range(200)]
    df = table(spark, draw.sample(rows, len(rows)), "doc_id long, text string").repartition(6)
    shards = write_shards(df, PATH, 2, size=400)
    listed = sorted(shards.collect(), key=lambda r: (r["part"], r["shard"]))
    assert len(listed) > 8 and all(r["n_ids"] < 400 + 100 for r in listed)
    assert [r["start"] for r in listed] == np.cumsum([0, *[r["n_ids"] for r in listed[:-1]]]).tolist()
    found = sorted(tuple(r) for r in read_documents(shards).collect())
    assert found == wanted(library, rows)
    ids = [i for _, text in rows for i in [*library.encode(text, add_special_tokens=False).ids, 2]]
    assert np.concatenate([load(r["path"]).values() for r in listed]).tolist() == ids
    one = load(listed[3]["path"])
    own = ids[listed[3]["start"] : listed[3]["start"] + listed[3]["n_ids"]]
    assert [one.select(2, n) for n in range(one.count(2))] == [p for p, i in enumerate(own) if i == 2]


@pytest.fixture
def ranges_as_dealt(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_a_hot_id_is_dealt_into_many_tasks(spark, ranges_as_dealt):
    df = table(spark, [(7 if i % 2 else None, f"word {i}") for i in range(4000)], "doc_id long, text string").repartition(4)
    shards = write_shards(df, PATH, 2, size=1000)
    assert shards.select("part").distinct().count() > 2
    rows = sorted((r["start"], r["doc_id"]) for r in read_documents(shards).collect())
    assert len({s for s, _ in rows}) == 4000 and [d for _, d in rows] == [None] * 2000 + [7] * 2000


def test_unfinished_files_are_not_read(spark, library):
    df = table(spark, [(1, "some words"), (2, "")], "doc_id long, text string")
    shards = write_shards(df, PATH, 2)
    path = shards.first()["path"]
    token_files.save(path.replace(".wm", "0.wm"), b"left behind by a lost executor")
    assert sorted(tuple(r) for r in read_documents(shards).collect()) == wanted(library, [(1, "some words"), (2, "")])


def test_registered_query_against_the_library(spark, library, folder):
    import __spark_entry__ as entry

    rows = [(d["doc_id"], d["text"]) for d in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()]
    assert sorted(tuple(r) for r in entry.queries()["op13_token_files"](spark, folder).collect()) == wanted(library, rows)
