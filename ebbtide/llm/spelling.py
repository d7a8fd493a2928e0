"""Spelling variants: words one code point apart, found by PartEnum signatures.

A word's letters are a set of (letter, how manyth of its kind): a binary vector. Replacing one
code point changes two of its places, inserting or deleting one changes a single place. The
places are dealt into groups by hash. Two vectors that differ in d places agree on all groups
but d at most, so a signature for every choice of groups without d of them, made of the places
in those groups, is shared by every pair within d. Words of one length are joined by d = 2,
words whose lengths differ by one by d = 1; the join compares the words themselves.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import importable, mapped, pa_schema, slices, written

RUN = re.compile("[a-zÀ-ÿ]+")
# Groups that the places are dealt into, for words of one length and for lengths that differ by one.
SAME_GROUPS, OTHER_GROUPS = 7, 4
# Distinct words a task gathers before it hands on their counts.
GATHERED = 300_000
# Roles of a signature: of words of its length, of the shorter one of two, of the longer one.
SAME, SHORTER, LONGER = 0, 1, 2


def lowered(text: str) -> str:
    """A-Z in lower case, and nothing else."""
    return text.encode().lower().decode()


def word_of(doc_id: int | None, run: str, modulus: int) -> str:
    """The run, with one code point less if the check sum of document and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _words(modulus: int, least_length: int, target: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def handed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()))], schema=target)

    for part in slices(batches, "text"):
        for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            for run, n in Counter(RUN.findall(lowered(text)) if text else ()).items():
                # A run can only lose code points.
                if len(run) >= least_length and len(word := word_of(doc_id, run, modulus)) >= least_length:
                    counts[word] += n
        if len(counts) >= GATHERED:
            yield handed_on()
            counts.clear()
    if counts:
        yield handed_on()


def words(docs: DataFrame, modulus: int, least_length: int, least: int, id_col: str, text: str) -> DataFrame:
    """Every word with its occurrences `n`, counted in the tasks first."""
    importable(docs.sparkSession)
    schema = "word string, n long"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = rows.mapInArrow(partial(_words, modulus, least_length, pa_schema(docs.sparkSession, schema)), schema)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit mix (xor, shift and multiply by fixed odd numbers), so that sums of places tell sets apart."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def group_sums(listed: list[str], groups: int) -> np.ndarray:
    """Per word and group, the sum of the hashes of the word's places in the group."""
    lengths = np.array([len(w) for w in listed])
    letters = np.frombuffer("".join(listed).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(listed)), lengths)
    order = np.lexsort((letters, owner))
    owner, letters = owner[order], letters[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (letters[1:] != letters[:-1])][: len(owner)]
    nth = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    place = mixed(mixed(letters + np.uint64(groups << 32)) + nth.astype(np.uint64))
    sums = np.zeros((len(listed), groups), np.uint64)
    np.add.at(sums, (owner, (mixed(place) % np.uint64(groups)).astype(np.int64)), place)
    return sums


def signatures(listed: list[str], groups: int, apart: int, length: np.ndarray) -> np.ndarray:
    """Per word, one signature for each choice of all groups but `apart`, for words said to be of `length`."""
    sums = group_sums(listed, groups)
    found = []
    for n, chosen in enumerate(combinations(range(groups), groups - apart)):
        with np.errstate(over="ignore"):
            label = mixed(length.astype(np.uint64) * np.uint64(64) + np.uint64(n)) + np.uint64(groups)
            found.append(mixed(sums[:, list(chosen)].sum(axis=1, dtype=np.uint64) + label))
    return np.stack(found, axis=1).view(np.int64)


def _signed(part: pa.RecordBatch) -> dict:
    listed = part.column(0).to_pylist()
    lengths = np.array([len(w) for w in listed], np.int64)
    kinds = [
        (SAME, signatures(listed, SAME_GROUPS, 2, lengths)),
        (SHORTER, signatures(listed, OTHER_GROUPS, 1, lengths)),
        (LONGER, signatures(listed, OTHER_GROUPS, 1, lengths - 1)),
    ]
    at = np.concatenate([np.repeat(np.arange(len(listed)), s.shape[1]) for _, s in kinds])
    return {
        "sig": np.concatenate([s.ravel() for _, s in kinds]),
        "role": np.concatenate([np.full(s.size, role, np.int32) for role, s in kinds]),
        "word": part.column(0).take(pa.array(at)),
        "n": part.column(1).take(pa.array(at)),
    }


def near_pairs(counted: DataFrame) -> DataFrame:
    """Every pair of words one code point apart, once: `a`, `n_a`, `b`, `n_b`.

    Spark sizes the signatures like the words they are made of, some thirty times too low, so a
    side of the join is never broadcast.
    """
    signed = mapped(counted.select("word", "n"), "sig long, role int, word string, n long", "word", _signed)
    left = signed.where(F.col("role") != LONGER).select("sig", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = signed.where(F.col("role") != SHORTER).select("sig", F.col("word").alias("b"), F.col("n").alias("n_b"))
    once = (F.length("a") != F.length("b")) | (F.col("a") < F.col("b"))
    met = left.join(right.hint("merge"), (left.sig == right.sig) & once & (F.levenshtein("a", "b", 1) == 1))
    return met.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """From each word over its form to the last one, doubling the way at each step.

    A form is several times as frequent as its word, so that no way leads back and all are short.
    """
    state = written(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        state = written(
            state.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        )
        if state.where("_moved").isEmpty():
            return state.drop("_moved")
        state = state.drop("_moved")


def variants(
    docs: DataFrame,
    modulus: int = 199,
    least_length: int = 6,
    least: int = 5,
    ratio: int = 5,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per word: `word`, `form`, `root`, `n`, `n_near`, `form_n`.

    Words are the runs of letters (A-Z in lower case; a run loses a code point where `modulus`
    divides the check sum of document and run) of `least_length` code points and `least`
    occurrences. The form is the most frequent word one code point away, the smallest of equals,
    if `ratio` times as frequent or more, else null; the root is the last of the forms. A null
    id counts as an empty one in the check sum. Null and empty texts have no words; repeated
    rows count each; further columns are not read; an empty table gives no word.
    """
    counted = written(words(docs, modulus, least_length, least, id_col, text))
    pairs = written(near_pairs(counted))

    def side(*columns: str) -> Column:
        return F.struct(*[F.col(c).alias(name) for c, name in zip(columns, ("word", "near", "near_n"), strict=True)])

    both = F.array(side("a", "b", "n_b"), side("b", "a", "n_a"))
    first = F.min(F.struct((-F.col("near_n")).alias("by"), F.col("near")))
    near = pairs.select(F.inline(both)).groupBy("word").agg(F.count("*").alias("n_near"), first.alias("_first"))
    own = counted.join(near, "word", "left")

    def formed(value: Column) -> Column:
        return F.when(-F.col("_first.by") >= ratio * F.col("n"), value)

    rows = written(
        own.select(
            "word",
            formed(F.col("_first.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            formed(-F.col("_first.by")).alias("form_n"),
        )
    )
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
