"""Language identification by unigrams with the segmentation summed out.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a word is the sum over all
ways to cut it into pieces (forward algorithm); probabilities of pieces come from expected counts over all cuts (EM), taken
over the word counts of all training texts. A text's score is the posterior of its best language.

Words are runs of letters, lower-cased. Words of up to LONGEST letters are summed together by length; the few longer ones letter by letter in
logarithms, so a run of any length is one word and its sum goes over all its segmentations. Only the text is scored. Training takes (text,
lang) of all rows given to it; what the driver gets is one number for each piece and language.

Defined results: null text or no letter gives `und` with score 0; ties go to the smaller language; rows with null lang don't
train; without training rows every text is `und`. Repeated rows stay repeated.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
ROUNDS, LONGEST, SMOOTHING = 3, 32, 0.5
SLICE = 6 << 20
BLOCK = 20_000  # words in one array
LETTERS = 1 << 16  # of a long word looked up at once
U = np.uint64
Q, SHIFT = U(0x9E3779B97F4A7C15), 46
FLOOR = 1e-8


def read_pieces(path: str) -> list[str]:
    """The vocabulary's pieces that are letters, after an optional word mark."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {m.id_to_piece(i) for i in range(m.get_piece_size())}
    return sorted(p for p in found if p == p.lower() and (p == "▁" or p.lstrip("▁").isalpha()))


@dataclass
class Model:
    """probs: a row for each piece, one for a character outside the vocabulary, and zeros; a column for each language."""

    pieces: list[str]
    langs: list[str]
    probs: np.ndarray
    prior: np.ndarray

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.keys = np.array([self._key(p) for p in self.pieces], U)
        self.tables, left = [], np.arange(len(self.pieces))
        while len(left):
            slot = ((self.keys[left] * U(0xBF58476D1CE4E5B9 + 2 * len(self.tables))) >> U(SHIFT)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            t = np.full(1 << (64 - SHIFT), -1, np.int32)
            t[slot[first]] = left[first]
            self.tables.append(t)
            left = np.delete(left, first)
        self.keys = np.append(self.keys, U(0))  # for -1

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for ch in piece:
            h = (h * int(Q) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashed strings; len(pieces) + 1 where there is none."""
        out = np.full(len(h), len(self.pieces) + 1, np.int32)
        for k, t in enumerate(self.tables):
            at = t[((h * U(0xBF58476D1CE4E5B9 + 2 * k)) >> U(SHIFT)).astype(np.int64)]
            ok = (at >= 0) & (self.keys[at] == h)
            out[ok] = at[ok]
        return out

    def lattice(self, x: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Piece numbers of x[:, i:j] for words x of equal length, given as code points."""
        n, size = x.shape
        out = {}
        none = len(self.pieces) + 1
        for i in range(size):
            h = np.zeros(n, U)
            for j in range(i + 1, min(size, i + self.longest) + 1):
                h = h * Q + x[:, j - 1]
                at = self.ids(h)
                if j == i + 1:
                    at[at == none] = none - 1
                elif (at == none).all():
                    continue
                out[i, j] = at
        return out

    def forward(self, cells, n: int, size: int, probs: np.ndarray) -> np.ndarray:
        a = np.zeros((size + 1, n, probs.shape[1]))
        a[0] = 1
        for (i, j), at in cells.items():
            a[j] += a[i] * probs[at]
        return a

    def expected(self, x: np.ndarray, weight: np.ndarray, probs: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces in words x, each `weight` times, for one language's probabilities."""
        n, size = x.shape
        cells = self.lattice(x)
        a = self.forward(cells, n, size, probs[:, None])[:, :, 0]
        b = np.zeros((size + 1, n))
        b[size] = 1
        for (i, j), at in reversed(cells.items()):
            b[i] += probs[at] * b[j]
        out, scale = np.zeros(len(probs)), weight / a[size]
        for (i, j), at in cells.items():
            out += np.bincount(at, a[i] * probs[at] * b[j] * scale, len(probs))
        return out


    def _starting(self, x: np.ndarray, i: int, j: int) -> np.ndarray:
        """Piece numbers of the strings of 1, 2, ... letters that start at i..j of one word: a row for each length."""
        none = len(self.pieces) + 1
        part = x[i : j + self.longest]
        out, h = np.full((self.longest, j - i), none, np.int32), np.zeros(len(part), U)
        for k in range(self.longest):
            n = len(part) - k
            if n <= 0:
                break
            h[:n] = h[:n] * Q + part[k:]
            out[k, : min(n, j - i)] = self.ids(h[: min(n, j - i)])
        out[0][out[0] == none] = none - 1
        return out

    def long_forward(self, x: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """For one word and the logarithms of probs: log sums up to each letter; a column for each language."""
        a = np.full((len(x) + 1, logs.shape[1]), -np.inf)
        a[0] = 0
        for i in range(0, len(x), LETTERS):
            j = min(len(x), i + LETTERS)
            lo = max(0, i - self.longest)
            at = self._starting(x, lo, j)
            for e in range(i + 1, j + 1):
                k = np.arange(min(self.longest, e))
                s = e - 1 - k
                a[e] = np.logaddexp.reduce(a[s] + logs[at[k, s - lo]], axis=0)
        return a

    def long_expected(self, x: np.ndarray, weight: float, probs: np.ndarray) -> np.ndarray:
        """Expected counts of the pieces in one word, for one language's probabilities."""
        with np.errstate(divide="ignore"):
            logs = np.log(probs)[:, None]
        n, a = len(x), self.long_forward(x, logs)[:, 0]
        b = np.full(n + 1, -np.inf)
        b[n], out = 0, np.zeros(len(probs))
        for i in range((n - 1) // LETTERS * LETTERS, -1, -LETTERS):
            j = min(n, i + LETTERS)
            at = self._starting(x, i, j)
            for s in range(j - 1, i - 1, -1):
                k = np.arange(min(self.longest, n - s))
                b[s] = np.logaddexp.reduce(logs[at[k, s - i], 0] + b[s + 1 + k])
            for k in range(self.longest):
                s = np.arange(i, min(j, n - k))
                got = at[k, s - i]
                out += np.bincount(got, np.exp(a[s] + logs[got, 0] + b[s + 1 + k] - a[n]), len(probs))
        return out * weight


def words_of(text: pa.Array) -> pa.Array:
    """A list of words for each text."""
    clean = pc.replace_substring_regex(pc.fill_null(text, ""), r"[^\pL]+", " ")
    return pc.utf8_split_whitespace(pc.utf8_lower(clean))


def by_length(words: pa.Array):
    """(positions in words, the words: code points with the word mark in front), in blocks of equal length up to LONGEST."""
    n = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    order = np.argsort(n, kind="stable")
    cuts = np.flatnonzero(np.diff(n[order])) + 1
    for group in np.split(order, cuts):
        size = int(n[group[0]]) if len(group) else 0
        if not 0 < size <= LONGEST:
            continue
        for k in range(0, len(group), BLOCK):
            part = group[k : k + BLOCK]
            text = "".join(words.take(pa.array(part)).to_pylist())
            x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), size).astype(U) + U(1)
            yield part, np.concatenate([np.full((len(part), 1), ord("▁") + 1, U), x], axis=1)


def long_words(words: pa.Array):
    """(position, code points with the word mark in front) of the words of over LONGEST letters."""
    for i in np.flatnonzero(pc.utf8_length(words).to_numpy(zero_copy_only=False) > LONGEST):
        yield int(i), np.frombuffer(("▁" + words[int(i)].as_py()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(1)


@lru_cache(maxsize=2)
def _load(blob: bytes) -> Model:
    return Model(*pickle.loads(blob))


def _dump(m: Model) -> bytes:
    return pickle.dumps((m.pieces, m.langs, m.probs, m.prior))


def word_counts(training: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of (text, lang); batches count first, so no word is hot in the shuffle."""

    def run(batches):
        for b in batches:
            size = max(1, int(len(b) * SLICE / max(1, b.column("text").nbytes)))
            for k in range(0, len(b), size):
                part = b.slice(k, size)
                langs = part.column("lang")
                for lang in pc.unique(langs).to_pylist():
                    v = pc.value_counts(pc.list_flatten(words_of(part.column("text").filter(pc.equal(langs, lang)))))
                    w, n = v.field(0), v.field(1)
                    ok = pc.not_equal(w, "")
                    w, n = w.filter(ok), n.filter(ok)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w), pa.string()), w.cast(pa.string()), n], ["lang", "word", "n"])

    counts = training.select("text", "lang").where("text is not null and lang is not null").mapInArrow(run, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(training: DataFrame, vocabulary: str = VOCABULARY, rounds: int = ROUNDS) -> Model:
    pieces = read_pieces(vocabulary)
    words = stash(word_counts(training), "lang-words")
    sizes = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    rows = len(pieces) + 2
    probs = np.full((rows, len(langs)), 1.0 / rows)
    probs[-1] = 0
    m = Model(pieces, langs, probs, np.array([sizes[x] for x in langs], float))
    for _ in range(rounds if langs else 0):
        blob = _dump(m)

        def run(batches, blob=blob):
            m = _load(blob)
            total = np.zeros(m.probs.shape)
            for b in batches:
                n = b.column("n").to_numpy().astype(float)
                for k, lang in enumerate(m.langs):
                    own = np.flatnonzero(pc.equal(b.column("lang"), lang).to_numpy(zero_copy_only=False))
                    mine = b.column("word").take(pa.array(own))
                    for part, x in by_length(mine):
                        total[:, k] += m.expected(x, n[own[part]], m.probs[:, k])
                    for i, x in long_words(mine):
                        total[:, k] += m.long_expected(x, n[own[i]], m.probs[:, k])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["at", "n"])

        got = words.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(probs.size)
        counts[got["at"].to_numpy()] = got["n"].to_numpy()
        counts = counts.reshape(probs.shape) + SMOOTHING
        counts[-1] = 0
        m = Model(pieces, langs, np.maximum(counts / counts.sum(axis=0), FLOOR) * (np.arange(rows) < rows - 1)[:, None], m.prior)
    return m


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs, without the text, with lang_pred and score; columns of these names are replaced."""
    docs = docs.drop(*({"lang_pred", "score"} - {text_col}))
    blob = _dump(model)
    schema = docs.schema

    def run(batches):
        m = _load(blob)
        prior = np.log(m.prior / m.prior.sum()) if len(m.langs) else np.zeros(0)
        with np.errstate(divide="ignore"):
            logs = np.log(m.probs)
        for b in batches:
            pred, score = [], []
            size = max(1, int(len(b) * SLICE / max(1, b.column(text_col).nbytes)))
            for k in range(0, len(b), size):
                lists = words_of(b.column(text_col).slice(k, size))
                coded = pc.list_flatten(lists).dictionary_encode()
                words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
                real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
                logp = np.zeros((len(words), len(m.langs)))
                if m.langs:
                    for part, x in by_length(words):
                        logp[part] = np.log(m.forward(m.lattice(x), *x.shape, m.probs)[-1])
                    for i, x in long_words(words):
                        logp[i] = m.long_forward(x, logs)[-1]
                bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
                sums = np.concatenate([np.zeros((1, len(m.langs))), np.cumsum(logp[codes], axis=0)])
                held = np.concatenate([[0], np.cumsum(real[codes])])
                s = sums[bounds[1:]] - sums[bounds[:-1]] + prior
                some = held[bounds[1:]] > held[bounds[:-1]]
                if not m.langs:
                    pred += ["und"] * len(s)
                    score += [0.0] * len(s)
                    continue
                best = s.argmax(axis=1)
                post = 1 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
                pred += [m.langs[i] if ok else "und" for i, ok in zip(best, some, strict=True)]
                score += np.where(some, post, 0.0).tolist()
            cols = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] != text_col]
            names = [x for x in b.schema.names if x != text_col]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != text_col)
    return docs.mapInArrow(run, (rest + ", " if rest else "") + "lang_pred string, score double")


def held_out(doc_id, folds: int, fold: int):
    """Whether crc32 of the id as text leaves `fold`; a null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
