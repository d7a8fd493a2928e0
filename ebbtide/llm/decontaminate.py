"""Benchmark decontamination by canonical templates.

Numbers, names and units become typed placeholders, so a question that was asked again with
other values has the same template. Windows of template tokens are hash-joined between
documents and benchmark; where they meet on one alignment of a document and an item, the values
in the slots have to correspond one to one.
"""

import re
from collections import Counter, defaultdict
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import keyed, mapped, row_key, written
from ebbtide.llm.cuckoo import mix
from ebbtide.llm.substring_dedup import Sums
from ebbtide.llm.vocabulary import Known, split

# What a token is, and words that are units after a number.
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’-][^\W\d_]+)*")
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yards mi mile miles mg g kg gram grams lb lbs oz t ton tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years c f k degrees percent "
    "cent cents dollar dollars euro euros pound pounds usd eur mph kmh w kw kwh v a hz khz mhz ghz kb mb gb tb".split()
)
LITERAL, NUMBER, NAME, UNIT = range(4)
PLACEHOLDERS = mix(np.arange(1, 5, dtype=np.uint64))
# The prefilter has so many bits however large the benchmark is; the join behind it is exact.
FILTER_BITS, FILTER_SHIFT, CACHE_SIZE = 1 << 24, 24, 120_000
WINDOWS = "a long, b long, start int, size int, exact int, slots array<string>"


class Tokens(dict):
    """Of each word between white space, which no token spans, the hashes of its tokens, lower-cased,
    with their kinds in the two lowest bits."""

    def __missing__(self, word: str) -> bytes:
        self[word] = value = b"".join([self.packed(t).to_bytes(8, "little") for t in TOKEN.findall(word)])
        return value

    @staticmethod
    def packed(token: str) -> int:
        first = token[0]
        lower = token.lower()
        kind = NUMBER if first.isdigit() else NAME if first.isupper() else UNIT if lower in UNITS else LITERAL
        return xxhash.xxh64_intdigest(lower) & ~3 | kind

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and kinds of all tokens; see `words_and_kinds`."""
        if len(self) > CACHE_SIZE:
            self.clear()
        return words_and_kinds(np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8"), np.zeros(1, np.int64))


def words_and_kinds(packed: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and kinds of tokens; a unit is one only after a number of its text, and texts begin at these places."""
    kinds = (packed & np.uint64(3)).astype(np.int8)
    after = np.r_[False, kinds[:-1] == NUMBER][: len(kinds)]
    after[begins[begins < len(after)]] = False
    kinds[(kinds == UNIT) & ~after] = LITERAL
    return packed | np.uint64(3), kinds


class Template:
    """Hashes of a text's windows: of its template, or of its words where a window has few literal ones."""

    def __init__(self, raw: list[str], cache: Tokens, any_case: bool = False):
        self.raw = raw
        self._shape(*cache.of(raw), any_case)

    @classmethod
    def of_packed(cls, packed: np.ndarray, begins: np.ndarray, any_case: bool) -> "Template":
        """Of hashed tokens of several texts, which begin at these places."""
        made = cls.__new__(cls)
        made._shape(*words_and_kinds(packed, begins), any_case)
        return made

    def _shape(self, words: np.ndarray, kinds: np.ndarray, any_case: bool) -> None:
        self.words, self.kinds = words, kinds
        # Unless words count in any case, numbers and names are told apart (a unit hangs on the word before).
        self.any_case = any_case
        if not any_case:
            self.exact = self.words ^ (self.kinds % UNIT).astype(np.uint64)
        self.shaped = np.where(self.kinds == LITERAL, self.words, PLACEHOLDERS[self.kinds])
        self.literals = np.r_[0, np.cumsum(self.kinds == LITERAL)]
        self.sums: dict[tuple[str, int], Sums] = {}

    @cached_property
    def tokens(self) -> list[str]:
        return TOKEN.findall(" ".join(self.raw))

    def hashes(self, of: str, half: int, start: np.ndarray, size: int) -> np.ndarray:
        """One half of the hashes of windows of the template (`shaped`) or of the words (`words`, `exact`)."""
        of = "words" if self.any_case and of == "exact" else of
        if (of, half) not in self.sums:
            self.sums[of, half] = Sums(getattr(self, of), half)
        return self.sums[of, half](start, start + size)

    def starts(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows start, and whether they are mostly slots."""
        start = np.arange(max(0, len(self.words) - size + 1))
        return start, (self.literals[start + size] - self.literals[start]) * 2 < size

    def halves(self, size: int) -> list[tuple[int, np.ndarray]]:
        """First hash halves of all windows: by template (0), or by words where mostly slots; and by words (1)."""
        start, literal = self.starts(size)
        words = self.hashes("words", 0, start, size)
        exact = words if self.any_case else self.hashes("exact", 0, start, size)
        return [(0, np.where(literal, ~words, self.hashes("shaped", 0, start, size))), (1, exact)]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, two hash halves and whether the words themselves were hashed."""
        start, literal = self.starts(size)
        halves = [np.where(literal, ~self.hashes("words", h, start, size), self.hashes("shaped", h, start, size)) for h in (0, 1)]
        return start, *halves, literal

    def slots(self, start: int, size: int) -> list[str]:
        """Values of a window's slots."""
        return [self.tokens[i].lower() for i in range(start, start + size) if self.kinds[i] != LITERAL]

    def keys(self) -> tuple[int, int]:
        """Of the whole text: its template with its words; its template with which of its slots are equal.

        Whether slot values correspond one to one hangs on the second alone.
        """
        n, none = len(self.tokens), np.array([0])
        shape = b"".join(self.hashes("shaped", h, none, n).tobytes() for h in (0, 1)) + n.to_bytes(8, "little")
        words = b"".join(self.hashes("words", h, none, n).tobytes() for h in (0, 1))
        first: dict[str, int] = {}
        equal = np.array([first.setdefault(v, len(first)) for v in self.slots(0, n)], np.int64).tobytes()
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return signed(xxhash.xxh3_64_intdigest(shape + words)), signed(xxhash.xxh3_64_intdigest(shape + equal))


def benchmark_windows(items: DataFrame, size: int, any_case: bool = False) -> DataFrame:
    """Keys of items and of their classes, and their windows; an item shorter than a window is one by itself.

    A window is listed by its template (or by its words, if it is mostly slots), and once more
    by its words (`exact`).
    """
    cache = Tokens()

    def each(part: pa.RecordBatch) -> dict:
        rows = []
        for item, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            template = Template((text or "").split(), cache, any_case)
            n = len(template.tokens)
            if not n:
                continue
            own = min(size, n)
            keys = template.keys()
            start, a, b, _ = template.windows(own)
            exact = [template.hashes("exact", h, start, own) for h in (0, 1)]
            for s in start.tolist():
                values = template.slots(s, own)
                rows.append((item, *keys, n, a[s].astype(np.int64), b[s].astype(np.int64), s, own, 0, values))
                rows.append((item, *keys, n, exact[0][s].astype(np.int64), exact[1][s].astype(np.int64), s, own, 1, values))
        names = ["item_id", "item", "class", "length", "a", "b", "start", "size", "exact", "slots"]
        return dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, [])

    return mapped(items, "item_id long, item long, class long, length int, " + WINDOWS, "text", each)


def prefilter(windows: DataFrame) -> np.ndarray:
    """Two bits for each window hash, FILTER_BITS in all, put together by Spark: its size is fixed."""
    places = F.array(F.pmod("a", F.lit(FILTER_BITS)), F.pmod(F.shiftrightunsigned("a", FILTER_SHIFT), F.lit(FILTER_BITS)))
    bit = F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")
    set_bits = windows.select(F.explode(places).alias("place"))
    cells = set_bits.groupBy(F.floor(F.col("place") / 64).alias("cell")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    for r in cells:
        table[r["cell"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    return table


def let_through(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of hashes that have both bits in the prefilter."""
    at = np.arange(len(hashes))
    for shift in (0, FILTER_SHIFT):
        place = (hashes[at] >> np.uint64(shift)) & np.uint64(FILTER_BITS - 1)
        at = at[(table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
    return at


class Scan:
    """Which texts of a slice have a window that the prefilter lets through, all texts in one row of tokens."""

    def __init__(self, any_case: bool):
        self.any_case, self.known = any_case, Known(np.dtype("<u8"))

    def __call__(self, texts: pa.Array, sizes: list[int], table: np.ndarray) -> np.ndarray:
        if len(self.known) > CACHE_SIZE:
            self.known = Known(np.dtype("<u8"))
        cut = split(texts)
        numbers = self.known.numbers(cut)
        self.known.learn([[Tokens.packed(t) for t in TOKEN.findall(w)] for w in self.known.new])
        ends = self.known.ends(cut, numbers)
        template = Template.of_packed(self.known.of(numbers), np.r_[0, ends[:-1]], self.any_case)
        owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        found = []
        for size in sizes:
            for _, hashes in template.halves(size):
                at = let_through(table, hashes)
                found.append(owner[at[owner[at] == owner[at + size - 1]]])
        return np.unique(np.concatenate([*found, np.zeros(0, np.int64)]))


def document_windows(docs: DataFrame, sizes: list[int], table: np.ndarray, any_case: bool = False) -> DataFrame:
    """Windows of documents that the prefilter lets through, with their slots."""
    cache, scan = Tokens(), Scan(any_case)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def each(part: pa.RecordBatch) -> dict | None:
        owner, found = [], []
        bits, texts = shared.value, part.column(2)
        for i in scan(texts, sizes, bits).tolist():
            template = Template((texts[i].as_py() or "").split(), cache, any_case)
            for size in sizes:
                _, literal = template.starts(size)
                for exact, own in template.halves(size):
                    at = let_through(bits, own)
                    if not len(at):
                        continue
                    if exact:
                        other = template.hashes("exact", 1, at, size)
                    else:
                        other = np.where(literal[at], ~template.hashes("words", 1, at, size), template.hashes("shaped", 1, at, size))
                    owner += [i] * len(at)
                    for s, x, y in zip(at.tolist(), own[at].view(np.int64).tolist(), other.view(np.int64).tolist()):
                        found.append((x, y, s, size, exact, None if exact else template.slots(s, size)))
        if not found:
            return None
        rows = pa.array(owner, pa.int32())
        columns = {"_id": part.column(0).take(rows), "_row": part.column(1).take(rows)}
        return columns | dict(zip(["a", "b", "start", "size", "exact", "slots"], zip(*found)))

    return mapped(docs.select("_id", "_row", "text"), "_id long, _row long, " + WINDOWS, "text", each)


def one_to_one(pairs: set[tuple[str, str]]) -> bool:
    """Whether distinct pairs give each value one partner, both ways."""
    return len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs})


def consistent(windows: dict[tuple[int, int], set[tuple[str, str]]], partial: bool) -> set[tuple[int, int]]:
    """Start and size of windows of one alignment whose slot values correspond one to one.

    All of them or none; if `partial`, the larger of two parts: those whose pairs of values most
    windows have, and the longest run of windows.
    """
    fit = {w: windows[w] for w in sorted(windows) if one_to_one(windows[w])}
    if one_to_one(set().union(*fit.values())):
        return set(fit)
    if not partial:
        return set()
    forth: dict[str, str] = {}
    back: dict[str, str] = {}
    counts = Counter(pair for pairs in fit.values() for pair in sorted(pairs))
    for (x, y), _ in counts.most_common():
        if x not in forth and y not in back:
            forth[x], back[y] = y, x
    voted = {w for w, pairs in fit.items() if all(forth.get(x) == y for x, y in pairs)}
    return max(voted, longest_run(fit), key=lambda part: len({i for at, n in part for i in range(at, at + n)}))


def longest_run(windows: dict[tuple[int, int], set[tuple[str, str]]]) -> set[tuple[int, int]]:
    """The most consecutive windows whose pairs are one to one together; each one's own are."""
    order, held = list(windows), Counter()
    xs, ys = Counter(), Counter()
    left, best = 0, (0, 0)
    for right, w in enumerate(order):
        for x, y in windows[w]:
            held[x, y] += 1
            if held[x, y] == 1:
                xs[x] += 1
                ys[y] += 1
        # Only pairs of this window can clash with earlier ones.
        while any(xs[x] > 1 or ys[y] > 1 for x, y in windows[w]):
            for x, y in windows[order[left]]:
                held[x, y] -= 1
                if not held[x, y]:
                    xs[x] -= 1
                    ys[y] -= 1
            left += 1
        if right + 1 - left > best[1] - best[0]:
            best = left, right + 1
    return set(order[slice(*best)])


def covers(rep: int, length: int, hits: list[dict], partial: bool) -> dict[int, float]:
    """Cover of items of one class, the representative and those with windows of their own, by a document.

    A hit without an item is one for all items of the class.
    """
    equal: dict[int | None, set] = defaultdict(set)
    shaped: dict[int, dict] = defaultdict(dict)
    for h in hits:
        if h["y"] is None or not h["y"]:
            equal[h["item"]].add((h["shift"], h["at"], h["size"]))
        else:
            shaped[h["shift"]][h["at"], h["size"]] = set(zip(h["x"], h["y"]))
    found = {}
    for item in {rep, *equal} - {None}:
        same = equal[None] | equal[item] if item in equal else equal[None]
        covered = np.zeros(length, bool)
        for _, at, n in same:
            covered[at : at + n] = True
        for shift, windows in shaped.items():
            for at, n in consistent({w: pairs for w, pairs in windows.items() if (shift, *w) not in same}, partial):
                covered[at : at + n] = True
        found[item] = int(covered.sum()) / length
    return found


def matches(docs: DataFrame, items: DataFrame, size: int, any_case: bool = False, partial: bool = False) -> DataFrame:
    """`_id`, `_row`, `item_id`, `cover`: cover by document and item, over all alignments."""
    known = written(benchmark_windows(items, size, any_case))
    # Items with the same words are one; without an id, it is a negative number from its words.
    single = known.groupBy("item", "class").agg(F.coalesce(F.min("item_id"), F.expr("first(item) | shiftleft(1L, 63)")).alias("item_id"))
    # Items of one template whose slots are equal in the same places are one class. Their slot
    # checks have one result, so one of them, that with the smallest id, stands for all, and a
    # benchmark of one template with many values does not multiply the pairs. Windows with slots
    # are looked for by their words too, those of every item.
    reps = single.groupBy("class").agg(F.min_by("item", F.struct("item_id", "item")).alias("rep"))
    names = written(single.join(reps, "class"))
    slotted = (F.col("exact") == 1) & (F.size("slots") > 0)
    own = known.dropDuplicates(["item", "start", "size", "exact"]).join(names.select("item", "rep"), "item").where(slotted | (F.col("item") == F.col("rep")))
    each_item = F.when(slotted, F.col("item")).alias("item")
    own = written(own.select(each_item, "rep", "length", "a", "b", F.col("start").alias("at"), "size", "exact", F.col("slots").alias("x")))
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())
    hits = document_windows(docs, sizes, prefilter(own), any_case)
    met = hits.join(own, ["a", "b", "size", "exact"])
    values = F.when(F.col("exact") == 0, F.col("x")).alias("x"), F.col("slots").alias("y")
    hit = F.struct("item", (F.col("start") - F.col("at")).alias("shift"), "at", "size", *values)
    groups = met.groupBy("_id", "_row", "rep", "length").agg(F.collect_set(hit).alias("hits"))

    def each(part: pa.RecordBatch) -> dict:
        rows = []
        for r in part.to_pylist():
            rows += [(r["_id"], r["_row"], item, cover) for item, cover in covers(r["rep"], r["length"], r["hits"], partial).items()]
        return dict(zip(["_id", "_row", "item", "cover"], zip(*rows)))

    rated = mapped(groups.withColumn("by", F.lit(None).cast("binary")), "_id long, _row long, item long, cover double", "by", each)
    return rated.join(names.select("item", "item_id"), "item").groupBy("_id", "_row", "item_id").agg(F.max("cover").alias("cover"))


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = 12, least_cover: float = 0.25, id_col: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", any_case: bool = False, partial: bool = False,
) -> DataFrame:
    """`docs` with `_item_ids` (sorted) and `_cover` (the best share of an item found).

    An item counts as found if windows of `size` tokens cover `least_cover` of it over all
    alignments: windows with its words always, and windows with its template and other values if
    these correspond one to one in all such windows of their alignment; with `partial`, the part
    of those windows counts in which they do. A window with mostly slots is compared by its words. An item found with other
    values alone is reported by the smallest id of its class, the items that differ from it in
    slot values only; so are items with the same words. An item without an id is reported by a
    negative number. With `any_case`, windows with the item's words count in whatever letter case;
    else capitals have to stand where they do in the item. Items shorter than a window are looked for whole. Null and empty texts and
    items have no window.
    Repeated rows have one result, null ids are no hindrance, all columns stay; with an empty
    benchmark nothing is found.
    """
    rows = docs.select(*row_key(id_col, text), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    found = matches(rows, asked, size, any_case, partial).where(F.col("cover") >= least_cover)
    per_row = written(found.groupBy("_id", "_row").agg(F.sort_array(F.collect_set("item_id")).alias("_item_ids"), F.max("cover").alias("_cover")))
    joined = keyed(docs, id_col, text).join(per_row, ["_id", "_row"], "left")
    ids = F.coalesce("_item_ids", F.array().cast("array<bigint>"))
    return joined.select("_all.*", ids.alias("_item_ids"), F.coalesce("_cover", F.lit(0.0)).alias("_cover"))


def report(docs: DataFrame, items: DataFrame, size: int = 12, least_cover: float = 0.25, any_case: bool = False, partial: bool = False) -> DataFrame:
    """One row per contaminated row: `doc_id`, `items` (ids, comma-joined), `cover`; see `contaminated`."""
    rows = contaminated(docs.select("doc_id", "text"), items, size, least_cover, any_case=any_case, partial=partial).where(F.size("_item_ids") > 0)
    named = F.array_join(F.col("_item_ids").cast("array<string>"), ",").alias("items")
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), named, F.col("_cover").alias("cover"))
