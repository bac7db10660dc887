"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on windows of ordinary documents,
one on those passages of toxic documents whose character n-grams toxic
documents use far more often than ordinary ones. A window of a text is
compressed with the ordinary dictionary, and with the toxic and the ordinary
one together; the bytes that the toxic dictionary saves are the window's gain.
Ordinary windows which gain by chance train a further part of the ordinary
dictionary. The threshold on gains and the weights of a document's statistics
over its windows are calibrated on the same labelled rows.

Fitting reads a sample of at most ``FIT_ROWS`` labelled rows of each class, of at most
``FIT_CHARS`` characters each (the first by a hash of doc_id). Scoring reads
every window of every text, in tasks of their own without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._sample import labelled_sample
from ._text import blocks, utf8

FIT_ROWS = {0: 4000, 1: 2000}
FIT_CHARS = 50_000       # labelled texts beyond are scored, but not fitted on
FIT_WINDOWS = 60_000     # ordinary windows, drawn from all of the fit rows, that set the chance dictionary and the threshold
DICT_WINDOWS = 40_000    # ... of which so many train the ordinary dictionary
WINDOW = 64          # bytes; so few literals stay uncompressed, and gains count whole bytes
LEVEL = 6
GRAM = 5
DICT_ORDINARY, DICT_TOXIC, DICT_CHANCE = 8192, 1024, 4096
FALSE_GAINS = 0.005  # share of ordinary windows that may reach the calibrated threshold
_FEATURES = 6


def normalise(text: str) -> bytes:
    """Lower case, one blank between words and at either end."""
    return b" " + " ".join(text.lower().split()).encode() + b" "


def windows(data: bytes) -> list[bytes]:
    """Cut at blanks into pieces of ``WINDOW`` bytes at most; a longer word is cut where it must be.

    A blank at a cut belongs to both pieces.
    """
    out, at, n = [], 0, len(data)
    while at < n - 1:
        to = at + WINDOW
        if to >= n:
            out.append(data[at:])
            break
        blank = data.rfind(b" ", at + 1, to)
        out.append(data[at:blank + 1] if blank > 0 else data[at:to])
        at = blank if blank > 0 else to
    return out


def _content(trained: bytes) -> bytes:
    """A trained dictionary's text: what follows its header, which ends in three start offsets (1, 4, 8)."""
    mark = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"
    return trained[trained.index(mark) + len(mark):]


def _train(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """Text that zstandard selects from ``samples``; too few samples to select from: the end of them."""
    samples = [s for s in samples if len(s) >= 8]
    if sum(map(len, samples)) > 4 * size and len(samples) >= 16:
        try:
            return _content(zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes())
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def _compressor(text: bytes) -> zstandard.ZstdCompressor:
    prepared = zstandard.ZstdCompressionDict(text or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    prepared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=prepared, write_content_size=False,
                                    write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    """Both dictionaries, the threshold on a window's gain and the logistic weights of a document's statistics."""

    ordinary: bytes = b""
    toxic: bytes = b""
    threshold: int = 4
    mean: np.ndarray = field(default_factory=lambda: np.zeros(_FEATURES))
    spread: np.ndarray = field(default_factory=lambda: np.ones(_FEATURES))
    weights: np.ndarray = field(default_factory=lambda: np.array([-8.0] + [0.0] * _FEATURES))

    def compressors(self):
        return _compressor(self.ordinary).compress, _compressor(self.toxic + self.ordinary).compress

    def statistics(self, gains: np.ndarray) -> np.ndarray:
        n, high = max(1, len(gains)), gains >= self.threshold
        top = np.sort(gains)[-3:] if len(gains) else np.zeros(1)
        return np.array([top[-1], top.mean(), gains.clip(0).sum() / n, (gains >= self.threshold - 1).sum() / n,
                         high.sum() / n, np.log1p(high.sum())])

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + (rows - self.mean) / self.spread @ self.weights[1:], -40, 40)))


def gains(compress, pieces: list[bytes]) -> np.ndarray:
    """Bytes that the toxic dictionary saves in each window."""
    plain, extended = compress
    return np.array([len(plain(w)) - len(extended(w)) for w in pieces], np.int64)


def _grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.int64)
    n = max(0, len(a) - GRAM + 1)
    codes = np.zeros(n, np.int64)
    for j in range(GRAM):
        codes = codes << 8 | a[j:j + n]
    return codes


def _telling_grams(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """Grams in far more toxic documents than chance allows (log-likelihood ratio of document counts)."""
    grams, seen = np.unique(np.concatenate([np.unique(_grams(x)) for x in toxic]), return_counts=True)
    least = max(3, len(toxic) // 200)
    grams, seen = grams[seen >= least], seen[seen >= least]
    if not len(grams):
        return grams
    other = np.zeros(len(grams))
    for x in ordinary:
        u = np.unique(_grams(x))
        at = np.minimum(np.searchsorted(grams, u), len(grams) - 1)
        other[at[grams[at] == u]] += 1
    n_t, n_o = len(toxic), max(1, len(ordinary))
    both, n = seen + other, len(toxic) + n_o

    def part(k, expected):
        return np.where(k > 0, 2 * k * np.log(np.maximum(k, 1e-9) / np.maximum(expected, 1e-9)), 0)

    ratio = (part(seen, n_t * both / n) + part(other, n_o * both / n)
             + part(n_t - seen, n_t * (n - both) / n) + part(n_o - other, n_o * (n - both) / n))
    ratio = np.where(seen / n_t >= 10 * other / n_o, ratio, 0)
    return grams[ratio >= max(15.0, 0.1 * ratio.max())]


def _passages(data: bytes, grams: np.ndarray) -> bytes:
    """The stretches of ``data`` covered by ``grams``."""
    hit = np.isin(_grams(data), grams)
    covered = np.zeros(len(data), bool)
    for j in range(GRAM):
        covered[j:j + len(hit)] |= hit
    return np.frombuffer(data, np.uint8)[covered].tobytes()


def fit_rows(rows: list[tuple[str, int, float]]) -> Model:
    """Fit on (text, label, weight) rows held here; without rows of both classes nothing is toxic."""
    rows = {t: (normalise(t), int(y), w) for t, y, w in rows}.values()  # copies tell nothing new
    toxic, ordinary = [t for t, y, _ in rows if y == 1], [t for t, y, _ in rows if y == 0]
    model = Model()
    if not toxic or not ordinary:
        return model
    plain = [w for t in ordinary for w in windows(t)]
    plain = [plain[i] for i in np.random.default_rng(0).permutation(len(plain))[:FIT_WINDOWS]]
    grams = _telling_grams(toxic, ordinary)
    model.ordinary = _train(plain[:DICT_WINDOWS], DICT_ORDINARY, 64, 8)
    model.toxic = _train([_passages(t, grams) for t in toxic], DICT_TOXIC, 16, 6) if len(grams) else b""
    first = gains(model.compressors(), plain)
    chance = [w for w, g in zip(plain, first) if g >= 3]
    if len(chance) > 50:
        model.ordinary = _train(chance, DICT_CHANCE, 32, 6) + model.ordinary
    compress = model.compressors()
    model.threshold = max(2, int(np.quantile(gains(compress, plain), 1 - FALSE_GAINS)) + 1) if plain else 4
    sample = toxic + ordinary
    x = np.array([model.statistics(gains(compress, windows(t))) for t in sample])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    weight = np.array([w for _, v, w in rows if v == 1] + [w for _, v, w in rows if v == 0])
    model.mean, model.spread = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([np.ones(len(x)), (x - model.mean) / model.spread])
    w, ridge = np.zeros(a.shape[1]), np.array([1e-6] + [0.3] * _FEATURES)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic 0/1): on a sample bounded by FIT_ROWS, FIT_CHARS and, of its ordinary windows, FIT_WINDOWS."""
    sample = labelled_sample(docs, labels, "toxic", FIT_ROWS).where(F.length("text") <= FIT_CHARS)
    return fit_rows(sorted(tuple(r) for r in sample.select("text", "toxic", "weight").collect()))


def _scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with their scores."""
    compress = model.compressors()
    for batch in batches:
        _, offsets = utf8(batch.column("text"))
        for lo, hi in blocks(offsets):
            part = batch.slice(lo, hi - lo)
            stats = [model.statistics(gains(compress, windows(normalise(t.as_py() or "")))) for t in part.column("text")]
            yield part, model.probability(np.array(stats).reshape(-1, _FEATURES))


def _scorer(model: Model, column: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scored(model, batches):
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(found, pa.float64())],
                                             [*names, column])
    return run


def _cleaner(model: Model, toxic_from: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _scored(model, batches):
            yield part.filter(pa.array(found < toxic_from))
    return run


def score(docs: DataFrame, model: Model, column: str = "score", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with the probability that a text is toxic.

    Null counts as empty: no window, statistics 0. An input column named
    ``column`` is replaced. Equal texts have equal scores.
    """
    rest = [f for f in docs.schema.fields if f.name != column and (keep is None or f.name in keep)]
    shown = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return (docs.withColumn("text", F.col("text").cast("string"))
            .mapInArrow(_scorer(model, column, [f.name for f in rest]), f"{shown}, `{column}` double"))


def drop_toxic(docs: DataFrame, model: Model, toxic_from: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``toxic_from``; nulls as in ``score``."""
    out = docs.withColumn("text", F.col("text").cast("string"))
    return out.mapInArrow(_cleaner(model, toxic_from), out.schema)
