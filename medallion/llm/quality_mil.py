"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded from
character and word statistics (below), a gated attention network, learned from document
labels alone, weighs the passages, and the weighted representation is scored:
``h = tanh(x W)``, ``a = softmax(w . (tanh(h V) * sigmoid(h U)))``,
``score = sigmoid(c . sum(a h) + b)``.

Learning uses at most ``sample_rows`` labelled documents per class, drawn by hash, each with
all its passages.  What the driver receives is bounded by taking fewer of these documents:
in hash order as many as ``sample_bytes`` of features hold.  Scoring reads every passage of every document; nothing is
shuffled.

Edge cases: NULL and empty texts are one passage of zero words; very long texts are read
in slices of bounded size; rows with NULL labels are left out; without rows of both
classes every score is 0.5; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.bytewords import SPACE, Words, sliced
from medallion.llm.common import free_names, store, text_of
from medallion.llm.toxicity import labelled_sample

PASSAGE = 64
_CODES = np.arange(256)
_UPPER, _LOWER = (_CODES >= 65) & (_CODES <= 90), (_CODES >= 97) & (_CODES <= 122)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
# shares of these bytes in a passage
_CLASSES = [
    _UPPER, _LOWER, _DIGIT, _CODES >= 128, _CODES == 10, _CODES == ord("."), _CODES == ord(","),
    _CODES == ord("!"), _CODES == ord("?"), _CODES == ord("|"), _CODES == ord("<"),
    _CODES == ord("@"), np.isin(_CODES, list(b"#$%&*~^_=+")),
    np.isin(_CODES, list(b"()[]{}/\\:;'\"-")),
]
N_FEATURES = len(_CLASSES) + 11


def passage_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """One row of features per passage, and the number of passages of each text."""
    per_text = np.diff(words.first)
    per_bag = np.maximum(1, -(-per_text // PASSAGE))
    bag_first = np.concatenate([[0], np.cumsum(per_bag)])
    total = int(bag_first[-1])
    out = np.zeros((total, N_FEATURES), np.float32)
    if len(words.start):
        text = np.repeat(np.arange(len(per_text)), per_text)
        nth = np.arange(len(words.start)) - words.first[:-1][text]
        passage = bag_first[:-1][text] + nth // PASSAGE
        begins = np.flatnonzero(np.diff(passage, prepend=-1))
        used = passage[begins]

        def share(flag: np.ndarray) -> np.ndarray:
            return np.add.reduceat(flag.astype(np.float32), begins)

        n = share(np.ones(len(passage)))
        size = (words.end - words.start).astype(np.float32)
        # bytes from a passage's first word to the next passage's (the last to its word's end)
        lo = words.start[begins]
        hi = words.end[np.append(begins[1:], len(passage)) - 1]
        bounds = np.stack([lo, hi], 1).ravel()
        raw = np.append(words.raw, np.uint8(0))
        bytes_ = np.maximum(hi - lo, 1).astype(np.float32)
        for i, members in enumerate(_CLASSES):
            out[used, i] = np.add.reduceat(members[raw].astype(np.float32), bounds)[::2] / bytes_
        same = np.zeros(len(passage), bool)
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (passage[1:] == passage[:-1])
        # distinct words per passage: the first of each (passage, word) in sorted order
        by_passage = np.lexsort((words.hash, passage))
        h, p = words.hash[by_passage], passage[by_passage]
        fresh = np.ones(len(p), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
        distinct = np.bincount(p[fresh], minlength=total)[used]
        first, last = words.raw[words.start], words.raw[words.end - 1]
        second = raw[np.minimum(words.start + 1, len(words.raw))]
        more = (
            np.log1p(n), np.add.reduceat(size, begins) / n / 10,
            share(size <= 3) / n, share(size >= 12) / n, share(same) / n, distinct / n,
            share(_UPPER[first]) / n, share(_UPPER[first] & (_UPPER[second] | (size == 1))) / n,
            share(~(_LOWER[last] | _UPPER[last] | (last >= 128))) / n,
            share(size == 1) / n,
            np.add.reduceat(SPACE[raw].astype(np.float32), bounds)[::2] / bytes_)
        for i, column in enumerate(more, len(_CLASSES)):
            out[used, i] = column
    return out, per_bag


@dataclass
class Network:
    """Weights, and the shift and scale of the features."""

    shift: np.ndarray
    scale: np.ndarray
    W: np.ndarray
    V: np.ndarray
    U: np.ndarray
    w: np.ndarray
    c: np.ndarray
    b: np.ndarray

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """``first``: index of each bag's first passage."""
        h = np.tanh(((x - self.shift) * self.scale) @ self.W)
        t, g = np.tanh(h @ self.V), _sigmoid(h @ self.U)
        e = (t * g) @ self.w
        sizes = np.diff(np.append(first, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        a /= np.repeat(np.add.reduceat(a, first), sizes)
        z = np.add.reduceat(a[:, None] * h, first)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes,
                "p": _sigmoid(z @ self.c + self.b[0])}


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def train_network(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 16, gate: int = 8,
                  epochs: int = 60, batch: int = 64, rate: float = 0.01, decay: float = 1e-4,
                  seed: int = 7) -> Network:
    """Mini-batch Adam on the cross-entropy, both classes weighing the same."""
    rng = np.random.default_rng(seed)
    flat = np.concatenate(bags)
    shift, spread = flat.mean(axis=0, dtype=float), flat.std(axis=0, dtype=float)
    d = flat.shape[1]
    net = Network(shift, 1 / np.maximum(spread, 1e-3),
                  rng.normal(0, d ** -0.5, (d, hidden)), rng.normal(0, 0.25, (hidden, gate)),
                  rng.normal(0, 0.25, (hidden, gate)), rng.normal(0, 0.25, gate),
                  rng.normal(0, 0.25, hidden), np.zeros(1))
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    names = ("W", "V", "U", "w", "c", "b")
    m = {n: np.zeros_like(getattr(net, n)) for n in names}
    v = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            x = np.concatenate([bags[i] for i in pick])
            sizes = np.array([len(bags[i]) for i in pick])
            grads = _gradients(net, x, np.cumsum(sizes) - sizes, labels[pick], weight[pick])
            step += 1
            for n in names:
                g = grads[n] + decay * getattr(net, n)
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.999 * v[n] + 0.001 * g * g
                move = m[n] / (1 - 0.9 ** step) / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, n, getattr(net, n) - rate * move)
    return net


def _gradients(net: Network, x: np.ndarray, first: np.ndarray, y: np.ndarray,
               weight: np.ndarray) -> dict[str, np.ndarray]:
    f = net.forward(x, first)
    h, t, g, a, sizes = f["h"], f["t"], f["g"], f["a"], f["sizes"]
    dy = (f["p"] - y) * weight / len(y)
    dz = np.repeat(dy[:, None] * net.c, sizes, axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, first), sizes))
    dt, dg = de[:, None] * net.w * g * (1 - t * t), de[:, None] * net.w * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ net.V.T + dg @ net.U.T) * (1 - h * h)
    return {"W": ((x - net.shift) * net.scale).T @ dh, "V": h.T @ dt, "U": h.T @ dg,
            "w": (t * g).T @ de, "c": f["z"].T @ dy, "b": np.array([dy.sum()])}


def sampled_bags(sample: DataFrame, sample_bytes: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Feature bags and labels of the sample; whole bags, of about ``sample_bytes`` in all."""

    @F.arrow_udf("binary")
    def bag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for _, _, words in sliced(batch):
                x, per_bag = passage_features(words)
                out += [rows.tobytes() for rows in np.split(x, np.cumsum(per_bag)[:-1])]
            yield pa.array(out, pa.binary())

    stored = store(sample.select("_id", "_y", bag(F.col("_text")).alias("bag"),
                                 F.monotonically_increasing_id().alias("_row")), "bags")
    sizes = stored.select("_row", "_y", F.xxhash64("_id").alias("_h"), "_id",
                          F.length("bag").alias("n")).toPandas()
    sizes = sizes.sort_values(["_h", "_id", "_row"], kind="stable")
    # each class has its half; the first that does not fit ends the row, however long it is
    before = sizes.groupby("_y")["n"].cumsum() - sizes["n"]
    fits = (before + sizes["n"] <= sample_bytes // 2) | (before == 0)
    if not fits.all():
        chosen = sample.sparkSession.createDataFrame(
            [(int(r),) for r in sizes["_row"][fits]], "_row bigint")
        stored = stored.join(F.broadcast(chosen), "_row", "left_semi")
    rows = stored.select("_id", "_y", "bag").toPandas().sort_values("_id", kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows["bag"]]
    return bags, rows["_y"].to_numpy(float)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", modulus: int = 3, held_out: int = 1,
          sample_rows: int = 2000, sample_bytes: int = 64 << 20) -> Network | None:
    """The network, or None without training rows of both classes."""
    sample = labelled_sample(docs, labels, label, key, text, modulus, held_out, sample_rows)
    bags, y = sampled_bags(sample, sample_bytes)
    if not len(y) or y.min() == y.max():
        return None
    return train_network(bags, y)


def quality(text: Column, net: Network | None) -> Column:
    if net is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for _, _, words in sliced(batch, 2 << 20):
                x, per_bag = passage_features(words)
                out.append(net.forward(x, np.cumsum(per_bag) - per_bag)["p"])
            yield pa.array(np.concatenate(out) if out else [], pa.float64())

    return score(text)


def score_quality(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``."""
    score, predicted = free_names(docs, "score", "predicted")
    scored = docs.withColumn(score, quality(text_of(text), net))
    return scored.withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
