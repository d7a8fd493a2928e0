"""Words of whole slices of texts as numbers, with what is known of each word found once."""

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def split(texts: pa.Array) -> pa.Array:
    """What ASCII white space separates, by text; nothing of a null one."""
    return pc.ascii_split_whitespace(pc.fill_null(texts, ""))


class Known(dict):
    """Numbers of words in the order they are first asked for, and the values of each, end to end."""

    def __init__(self, kind: np.dtype):
        self.new: list[str] = []
        self.values, self.start, self.size = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The number of each word of a list array, end to end. Words that repeat are looked up once."""
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return np.array([self[w] for w in distinct], np.int64)[coded.indices.to_numpy()]

    def learn(self, found: list[list[int]]) -> None:
        """The values of the words that are new, in order."""
        sizes = np.array([len(f) for f in found], np.int64)
        self.start = np.r_[self.start, np.cumsum(sizes) - sizes + len(self.values)]
        self.size = np.r_[self.size, sizes]
        self.values = np.r_[self.values, np.fromiter(chain.from_iterable(found), self.values.dtype, sizes.sum())]
        self.new = []

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The values of words by number, end to end."""
        reps = self.size[numbers]
        at = np.repeat(self.start[numbers] - (np.cumsum(reps) - reps), reps) + np.arange(reps.sum())
        return self.values[at]

    def ends(self, words: pa.Array, numbers: np.ndarray) -> np.ndarray:
        """Where the values of each list's words end."""
        return np.r_[0, np.cumsum(self.size[numbers])][np.cumsum(pc.list_value_length(words).to_numpy())]
