"""Toxicity by multiple-instance learning: sentences are scored, a document is toxic if any of its sentences is (noisy-or).

A sentence's score is the logistic function of its words' weights and a constant; a document's is 1 - prod(1 - sentence score). The weights
are learned from document labels alone, by the gradient of the noisy-or's log likelihood, so they settle on the sentences that make a document
toxic. `locate` gives those sentences back.

Fitted on labelled documents in order of their id hashes, of any length: at most MAX_DOCS of them or MAX_BYTES of text, equal texts once; a text
above MAX_BYTES alone is passed over. Only words that tell labels apart have a weight (`telling`). Everything else reads every document whole.

Defined results: a text without a sentence (null and empty too) scores 0, as does every text if nothing was fitted on. Repeated rows stay repeated; an
empty table gives an empty result. Columns of any name may come along, `score` and `sentences` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec

MAX_DOCS, MAX_BYTES, FEW = 6000, 24 << 20, 4
RATIO = 10.83
STEPS, RATE, PENALTY = 250, 0.2, 0.2
THRESHOLD = 0.5
U = vec.U

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_END = np.zeros(256, bool)
_END[list(b".!?\n\r")] = True
_WORD = np.zeros(256, bool)
_WORD[list(range(48, 58)) + list(range(97, 123)) + list(range(128, 256))] = True


def sentences(data: np.ndarray, offs: np.ndarray):
    """(starts, ends, bounds of the rows, sentence and hash of each word); sentences without a word are left out."""
    low = _LOW[data]
    s, e = vec.runs(~_END[low], offs)
    ws, we = vec.runs(_WORD[low], offs)
    h = vec.span_hash(vec.prefix(low), ws, we)
    of = np.searchsorted(s, ws, side="right") - 1
    have, of = np.unique(of, return_inverse=True)
    s, e = s[have], e[have]
    return s, e, np.searchsorted(s, offs, side="left"), of, h


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


@dataclass
class Model:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    constant: float

    def logits(self, of: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
        """A sentence's constant and the weights of its words."""
        if not len(self.words):
            return np.full(n, self.constant)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return self.constant + np.bincount(of, np.where(self.words[at] == h, self.weights[at], 0.0), n)


def noisy_or(z: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """1 - prod(1 - sigmoid(z)) of each row's sentences."""
    total = np.concatenate([[0.0], np.cumsum(softplus(z))])
    return np.clip(-np.expm1(-np.maximum(total[bounds[1:]] - total[bounds[:-1]], 0)), 0, 1)


def likelihood(z: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """(mean negative log likelihood of the documents, its gradient by z)."""
    n = np.diff(bounds)
    row = np.repeat(np.arange(len(n)), n)
    total = np.bincount(row, softplus(z), len(n))
    miss = np.exp(-total)
    p = np.maximum(-np.expm1(-total), 1e-9)
    each = np.where(y == 1, -np.log(p), total)
    up = np.where(y == 1, -np.minimum(miss / p, 1e6), 1.0)
    return float(each.mean()), up[row] * sigmoid(z) / len(n)


def telling(which: np.ndarray, doc: np.ndarray, h: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which words may have a weight: those after FEW different words or more (copies of one passage show one) and whose documents
    differ from the others in their labels by a log likelihood ratio of at least RATIO."""
    before = np.concatenate([np.zeros(1, U), h[:-1]])
    before[np.concatenate([[True], doc[1:] != doc[:-1]])] = 0
    n = int(which.max(initial=-1)) + 1
    first = np.unique(vec.mix(before + which.astype(U) * vec.P), return_index=True)[1]
    contexts = np.bincount(which[first], minlength=n)
    held = np.unique(which * len(y) + doc)
    df, up = np.bincount(held // len(y), minlength=n).astype(float), np.bincount(held // len(y), y[held % len(y)], n)
    total, bad = float(len(y)), float(y.sum())

    def part(k, m):  # k * log(k / expected k), for m documents
        return np.where(k > 0, k * np.log(np.maximum(k, 1) * total / np.maximum(m, 1)), 0)

    ratio = 2 * (part(up, df * bad) + part(df - up, df * (total - bad)) + part(bad - up, (total - df) * bad) + part(total - df - bad + up, (total - df) * (total - bad)))
    return (contexts >= FEW) & (ratio >= RATIO)


def fit(texts: list[str], labels: list[int]) -> Model:
    data, offs = vec.strings(pa.array(texts, pa.large_string()))
    s, _, bounds, of, h = sentences(data, offs)
    have = np.diff(bounds) > 0  # a document without a sentence teaches nothing
    y = np.array(labels, float)[have]
    if not len(y):
        return Model(np.zeros(0, U), np.zeros(0), -np.inf)
    bounds = np.concatenate([[0], bounds[1:][have]])
    doc = np.searchsorted(bounds, of, side="right") - 1
    all_words, which = np.unique(h, return_inverse=True)
    ok = telling(which, doc, h, y)
    new = np.cumsum(ok) - 1
    use = ok[which]
    of, which, k, n = of[use], new[which[use]], int(ok.sum()), len(s)
    x = np.zeros(k + 1)
    x[k] = np.log(max(y.mean(), 1e-3) / max(1, n / len(y)))
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        z = x[k] + np.bincount(of, x[which], n)
        _, gz = likelihood(z, bounds, y)
        g = np.append(np.bincount(which, gz[of], k) + PENALTY * x[:k] / len(y), gz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - RATE * (1 - step / (STEPS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(all_words[ok], x[:k], float(x[k]))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Model:
    """docs: doc_id, text; labels: doc_id, label (0 or 1). Of rows that repeat an id the shortest, then smallest text counts."""
    ids = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).select("doc_id", "label", F.xxhash64("doc_id").alias("turn"))
    mine = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id").where(F.octet_length("text") <= max_bytes)
    rows = mine.groupBy("doc_id", "turn", "label").agg(F.min(F.struct(F.octet_length("text").alias("n"), F.xxhash64("text").alias("h"))).alias("t")).collect()  # max_docs numbers at most
    chosen, seen, total = [], set(), 0
    for r in sorted(rows, key=lambda r: (r["turn"], r["doc_id"])):
        if r["t"]["h"] not in seen and total + r["t"]["n"] <= max_bytes:
            seen.add(r["t"]["h"])
            total += r["t"]["n"]
            chosen.append((r["doc_id"], r["t"]["h"]))
    if not chosen:
        return fit([], [])
    picked = docs.sparkSession.createDataFrame(chosen, f"doc_id {dict(docs.dtypes)['doc_id']}, h long")
    got = mine.join(F.broadcast(picked), "doc_id").where(F.xxhash64("text") == F.col("h")).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    got = got.toPandas().sort_values("doc_id")
    return fit(got["text"].tolist(), got["label"].tolist())


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, without the text, with score and sentences: start and end byte and score of those of at least THRESHOLD; if
    the document reaches it by many weak ones only, the strongest."""
    docs = docs.drop(*({"score", "sentences"} - {text_col}))
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            keep = [i for i, n in enumerate(b.schema.names) if n != text_col]
            for i, j, data, offs in vec.chunks(b, text_col):
                s, e, bounds, of, h = sentences(data, offs)
                z = held.value.logits(of, h, len(s))
                p, own = noisy_or(z, bounds), sigmoid(z)
                row = np.repeat(np.arange(j - i), np.diff(bounds))
                order = np.lexsort((-own, row))
                top = np.zeros(len(s), bool)
                top[order[bounds[:-1][np.diff(bounds) > 0]]] = True
                hit = np.flatnonzero((own >= THRESHOLD) | (top & (p[row] >= THRESHOLD)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=j - i))]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(s[hit] - offs[row[hit]], pa.int32()), pa.array(e[hit] - offs[row[hit]], pa.int32()), pa.array(own[hit])], ["start", "end", "score"]),
                ).cast(kind)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(i, j - i) for c in keep], pa.array(p), lists], [*[b.schema.names[c] for c in keep], "score", "sentences"])

    rest = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(run, rest + "score double, sentences array<struct<start: int, end: int, score: double>>")


def locate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """A row for each offending sentence: the columns of docs besides the text, with sentence, its text and its score."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, "score", "sentence")]
    text = F.col(f"`{text_col}`")
    scored = score(docs.select(F.struct(*rest).alias("row"), text.alias("t"), text.cast("binary").alias("bytes")), model, "t")
    each = scored.select("row", "bytes", F.explode("sentences").alias("x"))
    part = F.decode(F.substring("bytes", F.col("x.start") + 1, F.col("x.end") - F.col("x.start")), "UTF-8")
    return each.select("row.*", F.btrim(part).alias("sentence"), F.col("x.score").alias("score"))
