"""Language identification by a convolutional network over bytes, trained and applied in numpy.

A window of bytes is embedded, filters of several widths run along it, each keeps its largest
answer, and a softmax layer reads those. A text is cut into consecutive windows that overlap
by what the widest filter needs; its languages' probabilities are the means over all windows.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.batches import mapped

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
LETTER = regex.compile(r"\p{L}")
NONE = "und"


@dataclass(frozen=True)
class Settings:
    """The sample is bounded: at most `languages` languages (the most frequent), `documents` or so
    of each and `windows` windows of a document; the network never sees more than that."""

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 16
    embedding: int = 8
    languages: int = 256
    documents: int = 400
    windows: int = 6
    epochs: int = 5
    batch: int = 64
    rate: float = 0.004
    seed: int = 1

    @property
    def stride(self) -> int:
        return self.window - max(self.widths) + 1


def windows_of(text: bytes, s: Settings) -> np.ndarray:
    """All windows of a text in order, the last one filled with zero bytes."""
    flat = np.frombuffer(text.translate(LOWER), np.uint8)
    n = max(1, -(-(len(flat) - s.window) // s.stride) + 1)
    padded = np.zeros((n - 1) * s.stride + s.window, np.uint8)
    padded[: len(flat)] = flat
    return np.lib.stride_tricks.sliding_window_view(padded, s.window)[:: s.stride]


@dataclass
class Network:
    settings: Settings
    labels: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> "Network":
        s, draw = self.settings, np.random.default_rng(self.settings.seed)
        n = len(s.widths) * s.filters
        w = {"embed": draw.normal(0, 0.5, (256, s.embedding)), "out": draw.normal(0, n**-0.5, (n, len(self.labels))), "bias": np.zeros(len(self.labels))}
        for k in s.widths:
            w[f"conv{k}"] = draw.normal(0, (k * s.embedding) ** -0.5, (k * s.embedding, s.filters))
            w[f"shift{k}"] = np.zeros(s.filters)
        self.weights = {k: v.astype(np.float32) for k, v in w.items()}
        self.weights["embed"][0] = 0
        return self

    def _spread(self, x: np.ndarray, k: int) -> np.ndarray:
        """The embedded bytes under a filter of width k at each place."""
        embedded = self.weights["embed"][x]
        places = np.lib.stride_tricks.sliding_window_view(embedded, k, axis=1)
        return places.transpose(0, 1, 3, 2).reshape(len(x), x.shape[1] - k + 1, -1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy."""
        s, w, rows = self.settings, self.weights, np.arange(len(x))
        pooled, kept = [], {}
        for k in s.widths:
            wide = self._spread(x, k)
            answer = wide @ w[f"conv{k}"]
            best = answer.argmax(axis=1)
            top = np.take_along_axis(answer, best[:, None], 1)[:, 0] + w[f"shift{k}"]
            kept[k] = (wide, best, top > 0)
            pooled.append(np.maximum(top, 0))
        features = np.concatenate(pooled, axis=1)
        error = softmax(features @ w["out"] + w["bias"])
        error[rows, y] -= 1
        error /= len(x)
        g = {"out": features.T @ error, "bias": error.sum(0), "embed": np.zeros_like(w["embed"])}
        back = np.split(error @ w["out"].T, len(s.widths), axis=1)
        for k, part in zip(s.widths, back):
            wide, best, on = kept[k]
            part = part * on
            under = wide[rows[:, None], best]
            g[f"conv{k}"] = np.einsum("nf,nfi->if", part, under)
            g[f"shift{k}"] = part.sum(0)
            inside = np.einsum("nf,if->nfi", part, w[f"conv{k}"]).reshape(len(x), s.filters, k, s.embedding)
            for j in range(k):
                np.add.at(g["embed"], x[rows[:, None], best + j], inside[:, :, j])
        g["embed"][0] = 0
        return g

    def train(self, x: np.ndarray, y: np.ndarray) -> "Network":
        """Adam, over shuffled batches with a fixed seed."""
        s, draw = self.settings, np.random.default_rng(self.settings.seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(s.epochs):
            order = draw.permutation(len(x))
            for at in range(0, len(x), s.batch):
                step += 1
                own = order[at : at + s.batch]
                for k, g in self.gradients(x[own], y[own]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    move = (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] -= (s.rate * move).astype(np.float32)
        return self

    def tables(self) -> list[np.ndarray]:
        """For each place under the filters, what a byte there adds to the answers of all that reach it.

        Columns run by width, the widest first, so that the filters that reach place j come first."""
        s, w = self.settings, self.weights
        result = []
        for j in range(max(s.widths)):
            parts = [w["embed"] @ w[f"conv{k}"][j * s.embedding : (j + 1) * s.embedding] for k in sorted(s.widths, reverse=True) if k > j]
            result.append(np.ascontiguousarray(np.concatenate(parts, axis=1)))
        return result

    def apply(self, x: np.ndarray, tables: list[np.ndarray], chunk: int = 128) -> np.ndarray:
        """Probabilities by window."""
        s, w, found = self.settings, self.weights, []
        widths = sorted(s.widths, reverse=True)
        order = [list(s.widths).index(k) for k in widths]
        out = np.concatenate([np.split(w["out"], len(widths))[i] for i in order])
        shift = np.concatenate([w[f"shift{k}"] for k in widths])
        for at in range(0, len(x), chunk):
            part = x[at : at + chunk]
            n = part.shape[1]
            # The last places of a window, which only narrower filters reach, are in the next one too.
            places = n - widths[0] + 1
            answer = tables[0][part[:, :places]]
            for j in range(1, widths[0]):
                answer[:, :, : tables[j].shape[1]] += tables[j][part[:, j : j + places]]
            features = np.maximum(answer.max(axis=1) + shift, 0)
            found.append(softmax(features @ out + w["bias"]))
        return np.concatenate(found)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """A network for the languages of `docs`, from rows with a language outside the held-out fifth.

    About `settings.documents` of each language are drawn by a hash of their id; only windows of
    those reach the driver. None without labelled text.
    """
    s = settings
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(id_col)))
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.languages).collect()
    if not counts:
        return None
    shares = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(s.documents / r["count"])) for r in counts], F.lit(0.0))
    place = F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(1 << 30)) / (1 << 30)
    drawn = known.where(place < shares).select("lang", F.col("text").cast("binary").alias("text"))

    def cut(part: pa.RecordBatch) -> dict:
        langs, found = [], []
        for label, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            all_windows = windows_of(t, s)
            for i in np.unique(np.linspace(0, len(all_windows) - 1, s.windows).astype(int)):
                if all_windows[i].any():
                    langs.append(label)
                    found.append(all_windows[i].tobytes())
        return {"lang": langs, "window": found}

    rows = sorted((r["lang"], bytes(r["window"])) for r in mapped(drawn, "lang string, window binary", "text", cut).collect())
    if not rows:
        return None
    labels = sorted({r[0] for r in rows})
    x = np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(-1, s.window)
    y = np.array([labels.index(r[0]) for r in rows])
    return Network(s, labels).start().train(x, y)


def predict(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `_lang_pred` and `_score`, from the whole text alone; `und` and 0 without a letter."""
    schema = docs.schema
    column = schema.names.index(text)
    tables = network.tables() if network else []

    def each(part: pa.RecordBatch) -> dict:
        texts = part.column(column).to_pylist()
        langs, scores = [NONE] * len(texts), [0.0] * len(texts)
        lettered = [i for i, t in enumerate(texts) if network and t and LETTER.search(t)]
        if lettered:
            cut = [windows_of(texts[i].encode(), network.settings) for i in lettered]
            starts = np.cumsum([0, *[len(c) for c in cut[:-1]]])
            sums = np.add.reduceat(network.apply(np.concatenate(cut), tables), starts, axis=0)
            for i, n, row in zip(lettered, map(len, cut), sums):
                best = int(row.argmax())
                langs[i], scores[i] = network.labels[best], min(1.0, float(row[best] / n))
        return {c: part.column(k) for k, c in enumerate(schema.names)} | {"_lang_pred": langs, "_score": scores}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return mapped(docs, f"{fields}, _lang_pred string, _score double", text, each)


def languages(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: `doc_id`, `held_out` (crc32 of the id's text mod 5 is 0; false without an id), `lang_pred`, `score`.

    The network learns from rows with a language outside the held-out fifth, and predicts from
    the text alone. Null and empty texts and texts without a letter are `und` with score 0, as
    is everything if no row is labelled. Equal texts have equal predictions; of equal
    probabilities the first language by name counts. Further columns are left out; an empty
    table gives an empty one.
    """
    network = train(docs, settings, id_col, text, lang)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text).alias("text"))
    found = predict(rows, network, "doc_id", "text")
    return found.select("doc_id", "held_out", F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))
