"""A quality classifier by attention-based multiple-instance learning (Ilse, Tomczak and Welling, 2018).

A document is a bag of passages of PASSAGE words. Every passage is encoded; gated attention
weighs the passages, with nothing but document labels to learn from; the weighted sum of the
encodings is scored. Training runs in numpy on a bounded sample of labelled documents
(TRAIN_DOCS) and of the passages of each (BAG, evenly spaced), 50 MB of features at most;
scoring is one narrow stage over whole texts.

Features of a passage: shares of its bytes by class, word length, distinct words, words of
windows that repeat in the document, repeated lines, and signed sums of hashed words. The
label, lang, source and doc_id are never among them.

Defined cases: a null or empty text is a bag with one passage of zeros and gets that bag's
score; labels other than 0 and 1, or without a document, are not used, and a document with
both labels counts as 0; with no labelled document or a single class the score is the share
of label 1 (0.5 without labels); repeated rows are scored each; other columns are ignored, and a column named score gives way;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.llm import kernel

#: Words of a passage; the most labelled documents that are learned from, and the most passages of each (about 12 KB).
PASSAGE, TRAIN_DOCS, BAG = 100, 4000, 64
#: A document whose score is under this is predicted to be of label 0.
KEEP = 0.3
_HASHED = 32
_CLASS = np.zeros(256, np.int64)
for _name, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!?", b".,;:'\"()-", b" \t\r\x0b\x0c", b"\n")):
    _CLASS[list(_bytes)] = _name + 1
_CLASS[128:] = 9
_CLASSES = 10
WIDTH = _CLASSES + 6 + _HASHED


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the index of each text's first passage (with the total at the end)."""
    begin, end, word_at = kernel.words(data, offsets)
    count = -(-np.diff(word_at) // PASSAGE)
    at = np.concatenate([[0], np.cumsum(count)])
    n = int(at[-1])
    out = np.zeros((n, WIDTH), np.float32)
    if not n:
        return out, at
    of_text = np.repeat(np.arange(len(count)), count)
    first = np.repeat(word_at[:-1], count) + (np.arange(n) - np.repeat(at[:-1], count)) * PASSAGE
    size = np.diff(np.append(first, len(begin)))
    byte_first = begin[first]
    byte_end = np.minimum(np.append(byte_first[1:], len(data)), offsets[1:][of_text])
    width = byte_end - byte_first
    of_byte = np.repeat(np.arange(n), width)
    place = np.arange(len(of_byte)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(byte_first, width)
    shares = np.bincount(of_byte * _CLASSES + _CLASS[data[place]], minlength=n * _CLASSES).reshape(n, _CLASSES)
    out[:, :_CLASSES] = shares / width[:, None]
    of_word = np.repeat(np.arange(n), size)
    length = (end - begin).astype(np.float64)
    mean = np.add.reduceat(length, first) / size
    out[:, _CLASSES] = np.log(mean)
    out[:, _CLASSES + 1] = np.log1p(np.sqrt(np.maximum(np.add.reduceat(length**2, first) / size - mean**2, 0)))
    out[:, _CLASSES + 2] = np.log(size)
    hashes = kernel.span_hashes(data, begin, end)
    _, once = np.unique(kernel.mix(hashes + kernel.stream(of_word, 11)), return_index=True)
    out[:, _CLASSES + 3] = np.bincount(of_word[once], minlength=n) / size
    grams, of, gram_at = kernel.windows(hashes, word_at, 3)
    _, back, times = np.unique(kernel.mix(grams + kernel.stream(of, 3)), return_inverse=True, return_counts=True)
    covered = np.zeros(len(begin), bool)
    again = gram_at[times[back] > 1] if len(grams) else gram_at
    for k in range(3):
        covered[again + k] = True
    out[:, _CLASSES + 4] = np.add.reduceat(covered.astype(np.float64), first) / size
    lower = np.minimum(length, 1)
    capital = (_CLASS[data[begin]] == 2) & (_CLASS[data[np.maximum(end - 1, begin)]] != 1)
    out[:, _CLASSES + 5] = np.add.reduceat(capital * lower, first) / size
    slot = (hashes & np.uint64(_HASHED - 1)).astype(np.int64)
    sign = ((hashes >> np.uint64(8)) & np.uint64(1)).astype(np.float64) * 2 - 1
    out[:, _CLASSES + 6 :] = (np.bincount(of_word * _HASHED + slot, weights=sign, minlength=n * _HASHED).reshape(n, _HASHED)) / np.sqrt(size)[:, None]
    return out, at


def filled(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bags without a passage get one of zeros; passages and the bag of each."""
    count = np.diff(at)
    bag = np.repeat(np.arange(len(count)), np.maximum(count, 1))
    if (count > 0).all():
        return x, bag
    made = np.zeros((len(bag), x.shape[1]), np.float32)
    made[np.repeat(count > 0, np.maximum(count, 1))] = x
    return made, bag


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Encoder, gated attention and classifier; `prior` alone if there was nothing to learn."""

    prior: float = 0.5
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    w: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, bag: np.ndarray, n: int) -> dict[str, np.ndarray]:
        w = self.w
        z = np.tanh(x @ w["enc"] + w["enc0"])
        t, s = np.tanh(z @ w["v"]), _sigmoid(z @ w["u"])
        e = (t * s) @ w["att"]
        first = np.searchsorted(bag, np.arange(n))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        r = np.add.reduceat(a[:, None] * z, first, axis=0)
        return {"z": z, "t": t, "s": s, "a": a, "r": r, "first": first, "p": _sigmoid(r @ w["out"] + w["out0"])}

    def step(self, x: np.ndarray, bag: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy."""
        w, f = self.w, self.forward(x, bag, len(y))
        ds = (f["p"] - y) / len(y)
        dr = (ds[:, None] * w["out"])[bag]
        z, a, t, s = f["z"], f["a"], f["t"], f["s"]
        da = (z * dr).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, f["first"])[bag])
        dg = de[:, None] * w["att"]
        dt, du = dg * s * (1 - t * t), dg * t * s * (1 - s)
        dz = (a[:, None] * dr + dt @ w["v"].T + du @ w["u"].T) * (1 - z * z)
        g = {"enc": x.T @ dz, "enc0": dz.sum(axis=0), "v": z.T @ dt, "u": z.T @ du, "att": (t * s).T @ de, "out": f["r"].T @ ds, "out0": ds.sum(keepdims=True)}
        return {k: v + decay * w[k] for k, v in g.items()}

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The score of each bag."""
        n = len(at) - 1
        if not self.w or not n:
            return np.full(n, self.prior)
        x, bag = filled(x, at)
        return self.forward((x - self.mean) / self.scale, bag, n)["p"]


def fit(x: np.ndarray, at: np.ndarray, y: np.ndarray, seed: int = 7, steps: int = 1500, hidden: int = 32, gate: int = 16, rate: float = 3e-3, decay: float = 1e-3) -> Model:
    """Learns a model from bags (passages x, first passages at) and their labels, by about `steps` mini-batches with Adam.

    The steps do not hang on the number of labels: few labels are gone through more often.
    """
    if not len(y) or y.min() == y.max():
        return Model(prior=float(y.mean()) if len(y) else 0.5)
    x, bag = filled(x, at)
    x = x.astype(np.float64)
    model = Model(float(y.mean()), x.mean(axis=0), x.std(axis=0) + 1e-3)
    x = (x - model.mean) / model.scale
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    model.w = {"enc": draw(x.shape[1], hidden), "enc0": np.zeros(hidden), "v": draw(hidden, gate), "u": draw(hidden, gate), "att": draw(gate), "out": draw(hidden), "out0": np.zeros(1)}
    m, v, t = {k: 0.0 for k in model.w}, {k: 0.0 for k in model.w}, 0
    first = np.searchsorted(bag, np.arange(len(y) + 1))
    batches = max(1, len(y) // 128)
    for _ in range(-(-steps // batches)):
        for some in np.array_split(rng.permutation(len(y)), batches):
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in some])
            sizes = first[some + 1] - first[some]
            t += 1
            for k, g in model.step(x[rows], np.repeat(np.arange(len(some)), sizes), y[some], decay).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.w[k] = model.w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def held_out(key: Column) -> Column:
    """Every fifth document by the CRC-32 of its id as text; never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _thinned(x: np.ndarray) -> np.ndarray:
    """At most BAG passages, evenly spaced over the whole text."""
    return x if len(x) <= BAG else x[np.linspace(0, len(x) - 1, BAG).astype(np.int64)]


def train(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learns from at most `most` labelled documents that are not held out: those whose ids hash lowest."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(most)
    )
    rows = documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(known), "id")
    # Of several texts of one id, the one of the least features counts, wherever it stands.
    bags = rows.select(F.col("id").cast("string").alias("id"), "label", "text").mapInArrow(_featurise, "id string, label int, bag binary").groupBy("id", "label").agg(F.min("bag").alias("bag")).orderBy("id").collect()
    x = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in bags]
    at = np.concatenate([[0], np.cumsum([len(b) for b in x])]).astype(np.int64)
    return fit(np.concatenate(x) if x else np.zeros((0, WIDTH), np.float32), at, np.array([r["label"] for r in bags], np.float64))


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in kernel.texts(batch.column(2)):
            x, at = passages(data, offsets)
            bags = [_thinned(x[at[i] : at[i + 1]]).tobytes() for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(bags, pa.binary())], names=["id", "label", "bag"])


def scored(model: Model, text: Column) -> Column:
    """The score of each text. Texts alone go to Python and numbers alone come back; a row's other columns stay where they are."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            found = [model.score(*passages(data, offsets)) for _, _, data, offsets in kernel.texts(column)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            kernel.release()

    # Marked so that a filter on the score does not have it computed twice.
    return F.arrow_udf(run, "double").asNondeterministic()(text.cast("string"))


def score(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`documents` with `score`; one narrow stage."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "score"]
    return documents.select(*rest, scored(model, F.col(text)).alias("score"))


def classify(documents: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score, predicted of every document."""
    model = train(documents, labels, most, key, text)
    return score(documents.select(key, text), model, text).select(key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"))
