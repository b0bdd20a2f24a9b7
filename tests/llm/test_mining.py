"""Hard negatives, toxicity and phrases against plain statements of their rules."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dossier.llm import hard, phrases, toxic, vec

# hard negatives


def plain_negatives(rows, every=50, k=5, m=3):
    e = []
    for r, (i, x, label) in enumerate(rows):
        if i is None or x is None or label is None or not x or any(c is None or not math.isfinite(c) or abs(c) > hard.LARGEST for c in x):
            continue
        e.append((r, i, label, [math.floor(256 * c) for c in x]))
    out = []
    for r, i, label, v in e:
        if i % every:
            continue
        score = [(sum(a * b for a, b in zip(v, w, strict=True)), j, s, other) for s, j, other, w in e if s != r and len(w) == len(v)]
        score.sort(key=lambda x: (-x[0], x[1], x[2]))
        for p, j, _, _ in [x for x in score if x[3] == label][:k]:
            fit = [x for x in score if x[3] != label and 50 * p <= 100 * x[0] <= 95 * p][:m]
            out += [(i, j, n + 1, x[1], p, x[0]) for n, x in enumerate(fit)]
    return Counter(out)


def odd_vectors(rng, n=400, dim=12):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c, size = rng.choice(centres), rng.choice([0.1, 1, 1, 3])
        rows.append((i, [size * (x + rng.gauss(0, 0.6)) for x in c], rng.randrange(4)))
    copy = rows[7][1]
    rows += [(n + k, copy, k % 3) for k in range(60)]  # one vector many times
    rows += [rows[50], rows[50], rows[100]]  # rows that repeat
    rows += [(None, copy, 1), (1000, None, 1), (1050, copy, None), (1100, [], 1), (1150, [1.0, None, *copy[2:]], 1), (1200, [float("nan"), *copy[1:]], 1), (1250, [float("inf"), *copy[1:]], 1)]
    rows += [(1300, [0.0] * dim, 2), (1350, copy[:3], 1), (1351, copy[:3], 1), (1352, copy[:3], 0), (1400, [-x for x in copy], 1), (1450, [hard.LARGEST * 1.0] * dim, 3), (1451, [hard.LARGEST * 0.8] * dim, 2), (1452, [hard.LARGEST * 0.9] * dim, 3), (1453, [hard.LARGEST * 3.0] * dim, 3)]
    return rows


@pytest.mark.parametrize("block", [2048, 24])
def test_hard_negatives_against_all_scores(spark, block):
    rows = odd_vectors(random.Random(block))
    d = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, r string, id int").repartition(3)
    got = hard.hard_negatives(d, F.col("id") % 50 == 0, block=block, anchor_block=max(4, block // 8))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    mine = Counter(tuple(r) for r in got.collect())
    want = plain_negatives(rows)
    assert len(want) > 50
    assert mine == want
    assert hard.hard_negatives(d.where("false"), F.col("id") % 50 == 0).count() == 0


def test_no_row_that_can_count_is_pruned():
    rng = np.random.default_rng(3)
    for dim in (1, 2, 16):
        v = np.floor(rng.normal(0, 200, (120, dim)))
        v[:5] = 0
        v[5:20] = v[20]
        b = hard.Block(np.arange(120), np.arange(120), np.zeros(120), v)
        q = np.concatenate([np.floor(rng.normal(0, 300, (40, dim))), np.zeros((1, dim)), v[20:22]])
        s = q @ v.T
        for need in (-np.inf, -1e5, 0.0, 1.0, 0.5 * s.max(), s.max(), 2 * s.max()):
            may = b.candidates(q, np.full(len(q), need))
            assert may[s >= need].all()
        tight = b.candidates(q, np.partition(s, -3, axis=1)[:, -3].astype(float))
        assert tight.sum() < 0.8 * tight.size or dim != 2


# toxicity


def test_noisy_or_and_its_gradient():
    rng = np.random.default_rng(1)
    n = [3, 1, 0, 5]
    bounds, z, y = np.concatenate([[0], np.cumsum(n)]), rng.normal(0, 2, 9), np.array([1.0, 0, 0, 1])
    p = toxic.noisy_or(z, bounds)
    for k in range(4):
        assert p[k] == pytest.approx(1 - math.prod(1 - 1 / (1 + math.exp(-x)) for x in z[bounds[k] : bounds[k + 1]]))
    keep = np.array([0, 1, 3])  # documents with a sentence
    b = np.array([0, 3, 4, 9])
    loss, g = toxic.likelihood(z, b, y[keep])
    assert loss == pytest.approx(-np.mean(np.log(np.where(y[keep] == 1, p[keep], 1 - p[keep]))))
    for i in range(9):
        step = np.zeros(9)
        step[i] = 1e-6
        assert g[i] == pytest.approx((toxic.likelihood(z + step, b, y[keep])[0] - toxic.likelihood(z - step, b, y[keep])[0]) / 2e-6, rel=1e-4)


def abusive(rng, n, bad):
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    out = []
    for i in range(n):
        s = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 12))) for _ in range(rng.randint(1, 15))]
        y = int(rng.random() < 0.3)
        if y:
            k = rng.randrange(len(s))
            w = s[k].split()
            w.insert(rng.randrange(len(w)), rng.choice(bad))
            s[k] = " ".join(w)
        out.append((i, ". ".join(s).capitalize() + ".", y))
    return out


def test_toxicity(spark):
    rng, bad = random.Random(4), ["zork", "zapf", "ünk"]
    rows = abusive(rng, 600, bad)
    d = spark.createDataFrame([(i, t, "s", 1.0) for i, t, _ in rows], "doc_id long, text string, row string, score double").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 400] + [(None, 1), (3, None)], "doc_id long, label int")
    model = toxic.train(d, labels)
    got = {r["doc_id"]: r for r in toxic.score(d, model).collect()}
    test = [(i, t, y) for i, t, y in rows if i >= 400]
    assert sum((got[i]["score"] >= 0.5) == (y == 1) for i, _, y in test) >= 0.98 * len(test)
    # the sentences that hold the word, and no others
    found = defaultdict(list)
    for r in toxic.locate(d, model).collect():
        found[r["doc_id"]].append(r["sentence"])
    for i, t, y in test:
        if y and got[i]["score"] >= 0.5:
            assert found[i] == [s.strip() for s in re.split(r"[.!?\n]", t) if any(w in s.lower() for w in bad)]
    assert toxic.score(d.where("false"), model).count() == 0


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(9)
    rows = abusive(rng, 200, ["zork"])
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    model = toxic.train(d, labels)
    long = "ab cd. " * 300_000  # beyond a chunk
    odd = [(1, None), (2, ""), (3, " .!?\n"), (4, long), (5, long + "you zork. "), (6, "zork"), (6, "zork"), (None, "Zork!"), (7, "x" * 700_000)]
    got = toxic.score(spark.createDataFrame([(i, t, "e") for i, t in odd], "doc_id long, t string, sentences string"), model, "t").collect()
    assert len(got) == len(odd)
    by = {(r["doc_id"], len(r["sentences"])): r["score"] for r in got}
    assert by[1, 0] == by[2, 0] == by[3, 0] == 0
    assert [r["score"] for r in got if r["doc_id"] == 6] == [by[6, 1]] * 2 and by[6, 1] > 0.5 and by[None, 1] == by[6, 1]
    (last,) = [r for r in got if r["doc_id"] == 5]
    assert last["score"] > 0.5 and (len(long), len(long) + 8) in [(s["start"], s["end"]) for s in last["sentences"]] or last["sentences"][-1]["end"] >= len(long)
    # nothing to learn from: every text scores 0
    nothing = toxic.train(d, labels.where("false"))
    assert {r["score"] for r in toxic.score(d, nothing).collect()} == {0.0}


def test_toxicity_sample(spark):
    rows = [(i, f"word{i} a b c. d e f") for i in range(40)] + [(40, "z " * 3000), (41, "word1 a b c. d e f"), (5, "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, label int")
    seen = []
    real = toxic.fit
    try:
        toxic.fit = lambda t, y: seen.append(t) or real(t, y)
        toxic.train(d, labels, max_docs=10)
        toxic.train(d, labels, max_bytes=200)
        toxic.train(d, labels)
    finally:
        toxic.fit = real
    assert len(seen[0]) <= 10 and 0 < sum(map(len, seen[1])) <= 200
    assert len(seen[2]) == len(set(seen[2])) and "a" in seen[2]  # equal texts once; of repeated ids the shortest


# phrases


def plain_phrases(rows, least, top, longest=5):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang, text = lang or "und" if lang is None else lang, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if a >= least and len(p) >= 2}
        longer = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        rows = []
        for p, a in cand.items():
            if longer[p] and 100 * longer[p] >= 100 * a:
                continue
            s, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def wordy(rng, n, long=200_000):
    words = [chr(97 + i) * (1 + i % 3) for i in range(9)] + ["É", "ß", "no break", "x" * 3000]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for _ in range(n):
        w = rng.choices(words, weight, k=rng.randint(0, 60))
        if rng.random() < 0.5:
            w[3:3] = "New York City Hall is".split()
        rows.append((rng.choice(["en", "en", "fr", None, "und", ""]), "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n"]) for x in w)))
    return rows + [("en", None), (None, ""), ("en", " .,;"), rows[0], rows[0], ("fr", "a b " * long)]


@pytest.mark.parametrize(("width", "bits", "held"), [(64, phrases.BITS, 1 << 20), (7, 1 << 10, 500), (64, 1 << 10, 500)])
def test_phrases_against_all_ngrams(spark, monkeypatch, width, bits, held):
    monkeypatch.setattr(phrases, "HELD", held)
    rows = wordy(random.Random(width), 120, 200_000 if held > 500 else 2_000)
    d = spark.createDataFrame([(i if i % 9 else None, *r, "k") for i, r in enumerate(rows)], "doc_id long, lang string, text string, seed string").repartition(4)
    for least, top in ((4, 2000), (12, 5)):
        got = sorted(tuple(r) for r in phrases.collocations(d, least, top=top, width=width, bits=bits).collect())
        assert got == plain_phrases(rows, least, top)
        if least == 12:
            break
        assert len(got) > 100
    assert phrases.collocations(d.where("false")).count() == 0


def test_scores_pass_64_bits(spark):
    rows = [("en", "aa bb " * 40_000), ("en", "cc dd")]
    d = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in phrases.collocations(d).collect()) == plain_phrases(rows, 100, 2000)


def test_hashes_of_texts_beyond_the_tables():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 3 * vec.CHUNK + 77).astype(np.uint8)
    part = data[5000:5100]
    data[-100:] = part
    data[vec.CHUNK - 50 : vec.CHUNK + 50] = part
    c = vec.prefix(data)
    s = np.array([5000, vec.CHUNK - 50, len(data) - 100, 6000])
    h = vec.span_hash(c, s, s + 100)
    assert h[0] == h[1] == h[2] != h[3]
    own = vec.prefix(part)
    assert h[0] == vec.span_hash(own, np.array([0]), np.array([100]))[0]
    assert all(len(x) <= vec.CHUNK for x in vec._powers.values())
    assert len(vec.strings(pa.array(["a", None]))[0]) == 1
