"""A cuckoo filter in numpy: sets of 64-bit hashes with insertion and deletion, whole arrays at a time."""

import numpy as np

SLOTS = 4
# The share of slots that a filter is sized for, and how often a print moves on before it is stashed.
LOAD, MOVES = 0.85, 400


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Cuckoo:
    """Buckets of four 16-bit prints, and a stash for prints that found no slot (rare at LOAD).

    Equal prints have the same two buckets, so whichever of them is deleted, the rest is right:
    there are no false negatives for hashes that were inserted once and not deleted.
    """

    def __init__(self, expected: int):
        buckets = 1 << max(4, (int(expected / SLOTS / LOAD)).bit_length())
        self.table = np.zeros((buckets, SLOTS), np.uint16)
        self.stash = np.zeros(0, np.int64)

    def _split(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prints and first buckets."""
        mixed = mix(hashes.view(np.uint64))
        prints = np.maximum(mixed & np.uint64(0xFFFF), np.uint64(1)).astype(np.uint16)
        return prints, (mixed >> np.uint64(16)).astype(np.int64) & (len(self.table) - 1)

    def _other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(prints).astype(np.int64) & (len(self.table) - 1))

    def _one(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """One number for a print and its two buckets."""
        return np.minimum(bucket, self._other(prints, bucket)) << 16 | prints.astype(np.int64)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, bucket = self._split(hashes)
        found = np.isin(self._one(prints, bucket), self.stash)
        for b in (bucket, self._other(prints, bucket)):
            found |= (self.table[b] == prints[:, None]).any(axis=1)
        return found

    def insert(self, hashes: np.ndarray) -> None:
        """Each hash once; the caller knows that they were not inserted before."""
        table, draw = self.table, np.random.default_rng(len(hashes))
        prints, bucket = self._split(hashes)
        for move in range(MOVES):
            if not len(prints):
                return
            order = np.argsort(bucket, kind="stable")
            prints, bucket = prints[order], bucket[order]
            lead = np.r_[True, bucket[1:] != bucket[:-1]]
            rank = np.arange(len(bucket)) - np.maximum.accumulate(np.where(lead, np.arange(len(bucket)), 0))
            free = table[bucket] == 0
            fits = rank < free.sum(axis=1)
            slot = np.argmax(np.cumsum(free[fits], axis=1) == (rank[fits] + 1)[:, None], axis=1)
            table[bucket[fits], slot] = prints[fits]
            prints, bucket = prints[~fits], bucket[~fits]
            if move:  # both buckets are full: one print of each bucket has to move on
                lead = np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)]
                b, s = bucket[lead], draw.integers(0, SLOTS, lead.sum())
                prints[lead], table[b, s] = table[b, s], prints[lead]
            bucket = self._other(prints, bucket)
        self.stash = np.r_[self.stash, self._one(prints, bucket)]

    def delete(self, hashes: np.ndarray) -> None:
        """Takes out each hash once; they must have been inserted."""
        prints, first = self._split(hashes)
        left = np.arange(len(prints))
        for second in (False, True):
            missed = []
            while len(left):
                bucket = self._other(prints[left], first[left]) if second else first[left]
                lead = np.zeros(len(left), bool)
                lead[np.unique(bucket, return_index=True)[1]] = True
                match = self.table[bucket[lead]] == prints[left[lead]][:, None]
                hit = match.any(axis=1)
                self.table[bucket[lead][hit], match[hit].argmax(axis=1)] = 0
                missed.append(left[lead][~hit])
                left = left[~lead]
            left = np.concatenate(missed) if missed else left
        stash = self.stash.tolist()
        for one in self._one(prints[left], first[left]).tolist():
            stash.remove(one)
        self.stash = np.array(stash, np.int64)

    def to_bytes(self) -> bytes:
        return np.array([len(self.table)], np.int64).tobytes() + self.table.tobytes() + self.stash.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Cuckoo":
        made = cls(0)
        buckets = int(np.frombuffer(data, np.int64, 1)[0])
        made.table = np.frombuffer(data, np.uint16, buckets * SLOTS, 8).reshape(buckets, SLOTS).copy()
        made.stash = np.frombuffer(data, np.int64, -1, 8 + 2 * buckets * SLOTS).copy()
        return made
