"""Token counts against the library of the vocabulary file."""

import json
import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbtide.llm.token_counts import Counter, Merges

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        counter = Counter(json.load(f))
    return (lambda texts: [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]), counter


def test_documents(both, folder):
    library, counter = both
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{folder}/documents.parquet'").fetchall()]
    assert counter(texts) == library(texts)


def test_odd_texts(both):
    library, counter = both
    draw = random.Random(3)
    letters = "aAbB'sStTllreve <|>endoftext.,!?12éÉßẞΣσς\t\n\x0b\x1c\x85\xa0 ‍́😀日"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    texts += ["", "a" * 3001, "ab" * 2000, "ΑΣ ΣΑΣ.", "<|endoftext|>a<|startoftext|> <|endoftext|", "it's I'LL we'd", "x\x1cy\x85w​q　l"]
    assert counter(texts) == library(texts)


def test_a_bounded_cache_changes_nothing(both, monkeypatch):
    library, counter = both
    monkeypatch.setattr("ebbtide.llm.token_counts.CACHE_SIZE", 3)
    texts = [f"some words number {i} and more" for i in range(20)]
    assert [counter([t])[0] for t in texts] == library(texts)


def test_ambiguous_merges_are_refused():
    spec = {"model": {"vocab": {}, "end_of_word_suffix": "</w>", "merges": ["a bc", "ab c"]}}
    from ebbtide.llm.token_counts import byte_letters

    spec["model"]["vocab"] = {x: i for i, x in enumerate([*byte_letters(), *[c + "</w>" for c in byte_letters()], "ab", "bc", "abc"])}
    with pytest.raises(ValueError):
        Merges(spec)
