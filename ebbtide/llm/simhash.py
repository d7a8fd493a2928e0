"""SimHash fingerprints, linked by tiled exact comparison.

Documents share few fingerprints' worth of bits by chance, so distinct fingerprints are first
dealt into blocks by equal bit bands: of radius + 1 bands two fingerprints within the radius
agree on one at least, which makes the blocks lossless. A block lies in tiles ordered by
population count; tile pairs whose counts differ beyond the radius are skipped, all others
are compared bit by bit with numpy. A tile pair is one row of work, so a block that holds
most fingerprints is many small tasks.
"""

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import importable, keyed, mapped, row_key, written
from ebbtide.llm.components import components

SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Hashes whose bits are added at a time, and rows of a tile compared at a time.
HASHES, ROWS = 1 << 14, 256


def fingerprint(text: bytes, width: int) -> int:
    """A bit is set if over half of the shingle hashes have it; zero without words."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    spans = list(zip(starts[:n].tolist(), last.tolist()))
    for at in range(0, n, HASHES):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans[at : at + HASHES]], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: `_id` and `_row` (see `row_key`), `doc_id` and `fp`, the fingerprint's 64 bits as a long."""
    rows = docs.select(*row_key(id_col, text), F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def each(part: pa.RecordBatch) -> dict:
        columns = dict(zip(["_id", "_row", "doc_id"], part.columns))
        return columns | {"fp": [fingerprint(t or b"", width) for t in part.column(3).to_pylist()]}

    return mapped(rows, "_id long, _row long, doc_id long, fp long", "text", each)


def band(fp: Column, k: int, bands: int) -> Column:
    """The k-th of `bands` runs of bits, all 64 of them dealt out as evenly as can be."""
    lo, hi = 64 * k // bands, 64 * (k + 1) // bands
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))


def near_edges(fps: DataFrame, radius: int, tile: int = 1024) -> DataFrame:
    """Edges a, b between distinct fingerprints `fp` that differ in at most `radius` bits.

    Of a tile pair only a spanning forest of its links is returned: connectivity is whole and
    the rows are never more than the fingerprints compared, however alike they are.
    """
    bands = radius + 1
    block = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), band(F.col("fp"), k, bands).alias("v")) for k in range(bands)]))
    rows = written(fps.select("fp", F.bit_count("fp").cast("int").alias("ones"), block.alias("at")).select("fp", "ones", "at.*"))
    # Where each population count of a block starts in the block's order: 65 numbers at most.
    counts = rows.groupBy("k", "v", "ones").agg(F.count("*").alias("n"))
    found = counts.groupBy("k", "v").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("ones", "n"))).alias("hist"))
    hist = found.where("total > 1").select("k", "v", "total", F.posexplode("hist").alias("i", "c"), "hist").select(
        "k", "v", "total", F.col("c.ones").alias("ones"), F.col("c.n").alias("n"),
        F.aggregate(F.slice("hist", 1, F.col("i")), F.lit(0).cast("long"), lambda s, c: s + c["n"]).alias("before"),
    )
    # A place in the block's order, ties dealt by hash; the key of this join splits large blocks.
    place = F.floor((F.col("before") + F.pmod(F.xxhash64("fp"), F.col("n"))) / F.lit(tile))
    tiled = rows.join(hist, ["k", "v", "ones"]).withColumn("tile", F.when(F.col("total") <= tile, 0).otherwise(place))
    tiles = written(
        tiled.groupBy("k", "v", "tile").agg(
            F.sort_array(F.collect_list("fp")).alias("fps"),
            F.min("ones").alias("lo"), F.max("ones").alias("hi"), (F.max("total") > tile).alias("large"),
        )
    )
    nothing = F.array().cast("array<long>")
    whole = tiles.select(F.col("fps").alias("left"), nothing.alias("right"))
    large = tiles.where("large")
    a = large.select("k", "v", F.col("tile").alias("ta"), F.col("hi").alias("top"))
    b = large.select("k", "v", F.col("tile").alias("tb"), F.col("lo").alias("bottom"))
    pairs = a.join(b, ["k", "v"]).where("ta < tb").where(F.col("bottom") - F.col("top") <= radius).select("k", "v", "ta", "tb")
    pairs = pairs.join(large.select("k", "v", F.col("tile").alias("ta"), F.col("fps").alias("left")), ["k", "v", "ta"])
    pairs = pairs.join(large.select("k", "v", F.col("tile").alias("tb"), F.col("fps").alias("right")), ["k", "v", "tb"])
    importable(fps.sparkSession)
    return whole.unionByName(pairs.select("left", "right")).mapInArrow(partial(_linked, radius=radius), "a long, b long")


def _linked(batches, radius: int):
    for batch in batches:
        left, right = batch.column(0), batch.column(1)
        a, b = [], []
        for i in range(batch.num_rows):
            x = left[i].values.to_numpy()
            y = right[i].values.to_numpy()
            fps, forest = forest_of(x, y, radius)
            node = np.flatnonzero(forest != np.arange(len(forest)))
            a.append(fps[node])
            b.append(fps[forest[node]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a, b)], names=["a", "b"]
        )


def forest_of(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All fingerprints, and for each the place of its tree's root; `y` empty: `x` against itself."""
    own = len(y) == 0
    x = x[np.argsort(np.bitwise_count(x.view(np.uint64)), kind="stable")]
    y = x if own else y[np.argsort(np.bitwise_count(y.view(np.uint64)), kind="stable")]
    fps = x if own else np.concatenate([x, y])
    label = np.arange(len(fps))
    bits, ones = y.view(np.uint64), np.bitwise_count(y.view(np.uint64)).astype(np.int64)
    for at in range(0, len(x), ROWS):
        rows = x[at : at + ROWS].view(np.uint64)
        count = np.bitwise_count(rows).astype(np.int64)
        lo, hi = np.searchsorted(ones, [count[0] - radius, count[-1] + radius + 1])
        lo = max(lo, at + 1) if own else lo
        if lo >= hi:
            continue
        i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ bits[None, lo:hi]) <= radius)
        i, j = i + at, j + lo + (0 if own else len(x))
        _union(label, i, j)
    return fps, label


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merges the trees of each i and j; `label` holds roots before and after."""
    while len(i):
        p, q = label[i], label[j]
        differ = p != q
        i, j, p, q = i[differ], j[differ], p[differ], q[differ]
        if not len(i):
            return
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def grouped(docs: DataFrame, width: int, radius: int, id_col: str, text: str, tile: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their fingerprints, and for each fingerprint the `first` row of its component.

    First is the smallest id, rows without an id last. The order of work: fingerprints once,
    written; distinct ones compared in tiles; components by contraction.
    """
    rows = written(fingerprints(docs, width, id_col, text))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_id", "_row")
    fps = written(rows.groupBy("fp").agg(F.min(place).alias("own")))
    roots = components(near_edges(fps, radius, tile)).select(F.col("node").alias("fp"), "root")
    named = written(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    first = named.groupBy("root").agg(F.min("own").alias("first"))
    return rows, written(named.select("fp", "root").join(first, "root").select("fp", "first"))


def near_duplicates(
    docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text: str = "text", tile: int = 1024
) -> DataFrame:
    """Per row: `doc_id`, `fingerprint` (16 hex digits) and `component_id`.

    Texts are lower-cased (A-Z only), cut into words at ASCII white space and into shingles of
    `width` words, repeats included; a shorter text is one shingle, a null, empty or blank one
    has fingerprint zero and is linked like any other. Fingerprints link at up to `radius`
    differing bits; `component_id` is the smallest id that is reachable. Ties and repeated
    rows have one fingerprint and so one component. Rows with a null id take part and get their
    component, which is null only if no row of it has an id. Further columns are left out;
    an empty table gives an empty one.
    """
    rows, named = grouped(docs, width, radius, id_col, text, tile)
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(named, "fp").select("doc_id", shown, F.col("first.doc_id").alias("component_id"))


def one_of_each(
    docs: DataFrame, width: int = 4, radius: int = 4, id_col: str = "doc_id", text: str = "text", tile: int = 1024
) -> DataFrame:
    """The first row of each component of near duplicates, with all its columns; see `near_duplicates`."""
    _, named = grouped(docs, width, radius, id_col, text, tile)
    keep = named.select("first._id", "first._row").distinct()
    rows = keyed(docs, id_col, text).join(keep, ["_id", "_row"], "left_semi")
    return rows.dropDuplicates(["_id", "_row"]).select("_all.*")
