"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and of its neighbours; forward-backward gives each line's marginal,
and the marginals, weighted by the lines' lengths, give the document's quality, put on the labels' scale by a logistic
curve. Features see only the text.

The field is fitted on labelled documents in order of their id hashes, whatever their length, until there are `max_docs` of them
(MAX_DOCS by default) or their texts hold `max_bytes` (MAX_BYTES; a text above that alone is passed over); their lines all carry the document's label. So the driver holds a
bounded sample. Everything else covers every document whole.

Defined results: a text without a non-blank line (null and empty too) scores the share of label 1 among the documents fitted
on, as does every text when nothing was fitted on. Repeated rows stay repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

MAX_DOCS, MAX_BYTES, STEPS, RATE, PENALTY = 1200, 64 << 20, 150, 0.1, 1e-3
OWN = 11  # features of a line itself


def _class(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_SPACE = _class(b" \t\r\x0b\x0c")
_CLASSES = [
    _class(b"#*$%&<>"), _class(b"|"), _class(b"!"), _class(bytes(range(48, 58))), _class(bytes(range(65, 91))),
    _class(bytes(range(97, 123)) + bytes(range(128, 256))), _class(b".,;:?"), _class(b"{}[]()=/\\@_~^"),
]


def line_features(data: np.ndarray, offs: np.ndarray):
    """(lengths, features with those of both neighbours and a constant, line bounds of the rows)."""
    ls, le = vec.runs(data != 10, offs)
    blank = np.concatenate([[0], np.cumsum(~_SPACE[data] & (data != 10))])
    ok = blank[le] > blank[ls]
    ls, le = ls[ok], le[ok]
    size = (le - ls).astype(float)
    bounds = np.searchsorted(ls, offs, side="left")
    row = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
    share = []
    for c in _CLASSES:
        n = np.concatenate([[0], np.cumsum(c[data])])
        share.append(3 * np.sqrt((n[le] - n[ls]) / size))  # rare marks count
    # words equal to the word before them
    prefix = vec.prefix(data)
    ws, we = vec.runs(~_SPACE[data] & (data != 10), offs)
    wh = vec.span_hash(prefix, ws, we)
    again = np.concatenate([[False], wh[1:] == wh[:-1]])[: len(wh)]
    at = np.searchsorted(ws, ls, side="left"), np.searchsorted(ws, le, side="left")
    n = np.concatenate([[0], np.cumsum(again)])
    words = np.maximum(at[1] - at[0], 1)
    # lines equal to an earlier line of the text
    key = vec.mix(vec.span_hash(prefix, ls, le) + row.astype(vec.U) * vec.P)
    copy = np.ones(len(key))
    copy[np.unique(key, return_index=True)[1]] = 0
    own = np.stack([*share, (n[at[1]] - n[at[0]]) / words, copy, np.log1p(size) / 5], axis=1)
    first = np.zeros(len(own), bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    last = np.zeros(len(own), bool)
    last[bounds[1:][np.diff(bounds) > 0] - 1] = True
    before = np.vstack([np.zeros((1, OWN)), own[:-1]])[: len(own)]
    before[first] = 0
    after = np.vstack([own[1:], np.zeros((1, OWN))])[: len(own)]
    after[last] = 0
    return size, np.hstack([own, before, after, np.ones((len(own), 1))]), bounds


def chain(a: np.ndarray, bounds: np.ndarray, t: np.ndarray):
    """Log odds of each line from the lines before it (its own score counted) and from those after it, for all rows at once."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    start, n = bounds[:-1][order], n[order]
    r, s = a.copy(), np.zeros(len(a))
    for k in range(1, int(n[0]) if len(n) else 0):
        i = start[: np.searchsorted(-n, -k, side="left")] + k
        p = r[i - 1]
        r[i] = a[i] + np.logaddexp(t[0, 1], p + t[1, 1]) - np.logaddexp(t[0, 0], p + t[1, 0])
    for k in range(int(n[0]) - 2 if len(n) else -1, -1, -1):
        i = start[: np.searchsorted(-n, -(k + 1), side="left")] + k
        q = a[i + 1] + s[i + 1]
        s[i] = np.logaddexp(t[1, 0], q + t[1, 1]) - np.logaddexp(t[0, 0], q + t[0, 1])
    return r, s


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass
class Field:
    w: np.ndarray
    t: np.ndarray
    curve: tuple[float, float]
    prior: float

    def quality(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Length-weighted share of good lines; nan without lines."""
        size, x, bounds = line_features(data, offs)
        r, s = chain(x @ self.w, bounds, self.t)
        good = np.concatenate([[0], np.cumsum(size * sigmoid(r + s))])
        total = np.concatenate([[0], np.cumsum(size)])
        have = bounds[1:] > bounds[:-1]
        out = np.full(len(offs) - 1, np.nan)
        out[have] = ((good[bounds[1:]] - good[bounds[:-1]]) / (total[bounds[1:]] - total[bounds[:-1]]))[have]
        return np.clip(out, 0, 1)

    def score(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        q = self.quality(data, offs)
        return np.where(np.isnan(q), self.prior, sigmoid(self.curve[0] * _logit(q) + self.curve[1]))


def _logit(q):
    q = np.clip(q, 1e-4, 1 - 1e-4)
    return np.log(q / (1 - q))


def _adam(grad, x: np.ndarray, steps: int, rate: float) -> np.ndarray:
    m = v = np.zeros_like(x)
    for k in range(1, steps + 1):
        g = grad(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return x


def fit(texts: list[str], labels: list[int]) -> Field:
    y_doc = np.array(labels, float)
    if not len(y_doc):
        return Field(np.zeros(3 * OWN + 1), np.zeros((2, 2)), (0.0, 0.0), 0.5)
    prior = float(y_doc.mean())
    data, offs = vec.strings(pa.array([x or "" for x in texts], pa.large_string()))
    _, x, bounds = line_features(data, offs)
    lines = np.diff(bounds)
    y = np.repeat(y_doc, lines)
    # documents count alike, and both labels count alike
    weight = np.repeat(1 / np.maximum(lines, 1) / np.where(y_doc == 1, max(prior, 1e-9), max(1 - prior, 1e-9)), lines) / (2 * len(y_doc))
    pair = np.ones(len(y), bool)
    pair[bounds[:-1][lines > 0]] = False
    i = np.flatnonzero(pair)

    def grad(z):
        w, t = z[:-4], z[-4:].reshape(2, 2)
        a = x @ w
        r, s = chain(a, bounds, t)
        g = x.T @ (weight * (sigmoid(r + s) - y))
        cells = np.stack([t[p, q] + p * r[i - 1] + q * (a[i] + s[i]) for p in (0, 1) for q in (0, 1)], axis=1)
        cells = np.exp(cells - cells.max(axis=1, keepdims=True)) if len(i) else cells
        cells = cells / cells.sum(axis=1, keepdims=True)
        truth = np.zeros_like(cells)
        truth[np.arange(len(i)), (2 * y[i - 1] + y[i]).astype(int)] = 1
        return np.concatenate([g, weight[i] @ (cells - truth)]) + PENALTY * z

    z = _adam(grad, np.zeros(x.shape[1] + 4), STEPS, RATE)
    f = Field(z[:-4], z[-4:].reshape(2, 2), (1.0, 0.0), prior)
    q = f.quality(data, offs)
    ok = ~np.isnan(q)
    u, target = _logit(q[ok]), y_doc[ok]
    curve = _adam(lambda c: np.array([np.mean((sigmoid(c[0] * u + c[1]) - target) * u), np.mean(sigmoid(c[0] * u + c[1]) - target)]) + PENALTY * c, np.array([1.0, 0.0]), 400, 0.05)
    return Field(f.w, f.t, (max(float(curve[0]), 1e-3), float(curve[1])), prior)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Field:
    """docs: doc_id, text; labels: doc_id, label (0 or 1). Ids are picked first, so no text is sorted; of rows that repeat an id the
    smallest text counts."""
    ids = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).select("doc_id", "label", F.xxhash64("doc_id").alias("turn"))
    text = F.coalesce("text", F.lit(""))
    mine = docs.select("doc_id", text.alias("text")).join(F.broadcast(ids), "doc_id")
    sizes = mine.groupBy("doc_id", "turn").agg(F.min(F.octet_length("text")).alias("n")).collect()  # max_docs numbers at most
    chosen, total = [], 0
    for r in sorted(sizes, key=lambda r: (r["turn"], r["doc_id"])):
        if r["n"] > max_bytes:  # passed over, so that the next ones count
            continue
        total += r["n"]
        if total > max_bytes:
            break
        chosen.append(r["doc_id"])
    rows = mine.where(F.col("doc_id").isin(chosen)).groupBy("doc_id").agg(F.min_by("text", F.struct(F.octet_length("text"), "text")).alias("text"), F.max("label").alias("label"))
    rows = rows.toPandas().sort_values("doc_id")
    return fit(rows["text"].tolist(), rows["label"].tolist())


def score(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The rows of docs, without the text, with score; a column of that name is replaced."""
    docs = docs.drop("score") if text_col != "score" else docs

    def run(batches):
        for b in batches:
            out = [field.score(data, offs) for _, _, data, offs in vec.chunks(b, text_col)]
            keep = [i for i, n in enumerate(b.schema.names) if n != text_col]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(np.concatenate(out) if out else np.zeros(0))], [*[b.schema.names[i] for i in keep], "score"])

    rest = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(run, rest + "score double")
