"""Each operator against a plain statement of its rule, on rows with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dossier.llm import chat, crf, decontam, langid, near, packing, quality, shards, suffix, urls, vec, warc
from dossier.llm.common import shared_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, t string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(25, 120)) for _ in range(20)]
    passage = prose(rng, 60)
    out = [None, "", " \n\t", "one", "é ü ß", base[0], base[0], base[1], base[1].replace(" ", "  ")]
    out += [b[: len(b) // 2] + " " + passage + " " + b[len(b) // 2 :] for b in base[2:8]]
    out += base[8:] + [base[9] + " plus", base[10].upper(), "x" * 3000, (prose(rng, 9) + "\n") * 30, prose(rng, 4000) + passage, passage, "no ctrl \x00\x1f word"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i * 3 % 41, t, "en", f"s{i % 3}" if i % 4 else None, len(t or ""), "r", "t") for i, t in enumerate(texts)]
    rows += [(None, texts[5], None, None, None, None, None), rows[7], rows[7]]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(docs):
    return docs.where("false")


def collect(df):
    return [r.asDict() for r in df.collect()]


def bag(rows):
    return Counter(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)


# 1


def test_warc_round_trip(spark, tmp_path):
    big = "ü" * 700
    rows = [(1, "http://a/b", big), (2, None, big), (3, "http://a/\r\nx ü", "small"), (4, "u", None), (5, "u", "small"), (9, "u", big), (None, "u", big), (6, "u", "y" * 5000)]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")
    folder = shared_path(spark, "warc-test")
    index = warc.write_warc(pages, folder, frame_bytes=3000, bundle_bytes=4000)
    got = {r["page_id"]: r for r in collect(warc.read_records(index, folder))}
    for i, _, h in rows:
        raw = (h or "").encode()
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        head = 9 if h == big and i != 9 else None
        assert (r["record_type"], r["refers_to"]) == (("revisit", head) if head else ("response", None))
        assert head or bytes(r["payload"]) == raw
    assert [r["page_id"] for r in collect(warc.lookup(index, folder, [6]))] == [6]
    assert warc.round_trip(pages.where("false")).count() == 0
    from pyarrow import fs

    store, _ = fs.FileSystem.from_uri(folder)
    name = index.first()["bundle"]
    table = warc.read_seek_table(store.open_input_file(name))
    own = index.where(F.col("bundle") == name).select("frame_at", "frame_bytes").distinct().collect()
    assert {(a, c) for a, c, _ in table} == {(r["frame_at"], r["frame_bytes"]) for r in own}


# 2


def brute_probability(word, probs, unk):
    word = "▁" + word
    a = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            p = probs.get(word[i:j])
            a[j] += a[i] * (p if p is not None else unk if j == i + 1 else 0)
    return a[-1]


def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "▁ab", "abc", "c"])
    rng = np.random.default_rng(0)
    p = np.append(rng.random((len(pieces) + 1, 2)), np.zeros((1, 2)), axis=0)
    m = langid.Model(pieces, ["x", "y"], p, np.ones(2))
    for word in ["a", "abc", "abcab", "azb", "zzz"]:
        for part, x in langid.by_length(pa.array([word])):
            got = m.forward(m.lattice(x), *x.shape, m.probs)[-1][0]
        for k in (0, 1):
            assert np.isclose(got[k], brute_probability(word, {q: p[i, k] for i, q in enumerate(pieces)}, p[len(pieces), k]))


def test_long_words_are_summed_whole(monkeypatch):
    pieces = sorted(["▁", "▁a", "a", "ab", "b", "▁ab", "abc", "c", "bca"])
    p = np.append(np.random.default_rng(0).random((len(pieces) + 1, 2)) / 3, np.zeros((1, 2)), axis=0)
    m, word, n = langid.Model(pieces, ["x", "y"], p, np.ones(2)), "abcabzcab" * 3 + "abc", np.array([2.0])
    (_, x), *_ = langid.by_length(pa.array([word]))
    whole, counts = np.log(m.forward(m.lattice(x), *x.shape, m.probs)[-1][0]), m.expected(x, n, p[:, 1])
    monkeypatch.setattr(langid, "LONGEST", 5)
    monkeypatch.setattr(langid, "LETTERS", 7)
    assert not list(langid.by_length(pa.array([word])))
    ((i, x),) = langid.long_words(pa.array([word]))
    with np.errstate(divide="ignore"):
        assert i == 0 and np.allclose(whole, m.long_forward(x, np.log(p))[-1])
    assert np.allclose(counts, m.long_expected(x, 2.0, p[:, 1]))


def brute_languages(rows, texts, pieces, rounds):
    """(language, posterior) of each text by EM over all segmentations, written out."""
    words = lambda t: ["▁" + w for w in re.findall(r"[^\W\d_]+", (t or "").lower())]
    langs = sorted({g for _, g in rows})
    counts = {g: Counter(w for t, h in rows if h == g for w in words(t)) for g in langs}
    index, size = {p: k for k, p in enumerate(pieces)}, len(pieces) + 2
    spans = lambda w: [(i, j, index.get(w[i:j], size - 2 if j == i + 1 else None)) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
    cuts = {w: [x for x in spans(w) if x[2] is not None] for g in langs for w in counts[g]} | {w: [x for x in spans(w) if x[2] is not None] for t in texts for w in words(t)}

    def sums(w, p):
        a, b = [1.0] + [0.0] * len(w), [0.0] * len(w) + [1.0]
        for i, j, k in sorted(cuts[w], key=lambda x: x[1]):
            a[j] += a[i] * p[k]
        for i, j, k in sorted(cuts[w], key=lambda x: -x[0]):
            b[i] += p[k] * b[j]
        return a, b

    probs = {g: np.append(np.full(size - 1, 1 / size), 0) for g in langs}
    for _ in range(rounds):
        for g in langs:
            got = np.full(size, langid.SMOOTHING)
            got[-1] = 0
            for w, n in counts[g].items():
                a, b = sums(w, probs[g])
                for i, j, k in cuts[w]:
                    got[k] += n * a[i] * probs[g][k] * b[j] / a[-1]
            probs[g] = np.append(np.maximum(got[:-1] / got.sum(), langid.FLOOR), 0)
    total = sum(sum(c.values()) for c in counts.values())
    for t in texts:
        s = np.array([np.log(sum(counts[g].values()) / total) + sum(np.log(sums(w, probs[g])[0][-1]) for w in words(t)) for g in langs])
        yield (langs[s.argmax()], 1 / np.exp(s - s.max()).sum()) if words(t) else ("und", 0.0)


def test_language_id_against_brute_force(spark):
    rng = random.Random(3)
    say = {"aa": ["der", "schön", "haus", "x" * 40], "bb": ["the", "nice", "house", "der"]}
    rows = [(" ".join(rng.choice(say[g]) for _ in range(rng.randint(1, 9))), g) for g in ("aa", "bb", "bb") for _ in range(8)]
    rows += rows[:3]
    train = spark.createDataFrame([(t, g, "s", 0.5) for t, g in rows], "text string, lang string, source string, score double")
    texts = ["der", "nice house", "Haus THE", "y" * 50, None, "", "12", "der der the"]
    m = langid.train(train, rounds=2)
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(0, "der", "s")], "doc_id long, text string, lang string")
    got = collect(langid.identify(docs, m))
    want = list(brute_languages(rows, texts, m.pieces, 2))
    assert len(got) == len(texts) + 1 and got[0].keys() == {"doc_id", "lang", "lang_pred", "score"}
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0] and np.isclose(r["score"], want[r["doc_id"]][1], rtol=1e-5)


def test_language_id(spark):
    rng = random.Random(1)
    words = {"aa": ["der", "und", "schön", "haus"], "bb": ["the", "and", "house", "nice"]}
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(30)), g) for i, g in enumerate(["aa", "bb"] * 20)]
    train = spark.createDataFrame([*rows, (98, None, "aa"), (99, "zz", None)], "doc_id long, text string, lang string")
    m = langid.train(train, rounds=2)
    odd = [(100, None), (101, ""), (102, "12 !!"), (103, "x" * 500), (104, "Der und HAUS")]
    test = spark.createDataFrame([(i, t) for i, t, _ in rows] + odd, "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in collect(langid.identify(test, m))}
    assert all(got[i][0] == g for i, _, g in rows) and got[104][0] == "aa"
    assert [got[i] for i in (100, 101, 102)] == [("und", 0.0)] * 3 and got[103][0] in ("aa", "bb")
    assert langid.identify(test.where("false"), m).count() == 0
    none = langid.train(train.where("false"))
    assert {r["lang_pred"] for r in collect(langid.identify(test, none))} == {"und"}


# 3


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for trial in range(40):
        data = rng.integers(0, rng.integers(1, 5) + 1, int(rng.integers(0, 300))).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[: len(data) // 4], 4)
        b = data.tobytes()
        sa, rank = suffix.suffix_array(data)
        want = sorted(range(len(b)), key=lambda i: b[i:])
        assert sa.tolist() == want and all(rank[i] == k for k, i in enumerate(want))
        lcp = lambda i, j: next((k for k in range(len(b)) if max(i, j) + k >= len(b) or b[i + k] != b[j + k]), len(b))
        assert suffix.common_prefixes(data, sa).tolist() == [lcp(want[k - 1], want[k]) if k else 0 for k in range(len(b))]


def brute_cuts(rows):
    first = defaultdict(set)
    key = lambda i: suffix.LAST if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first[b[p : p + 50]].add(key(i))
    low = {w: min(s) for w, s in first.items()}
    for i, t in rows:
        b = (t or "").encode()
        cut = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if low[b[p : p + 50]] < key(i):
                cut[p : p + 50] = True
        yield i, b, cut


def shards_of_suffixes(parts, hot):
    """The three passes over shards in memory, with the exchanges written out; a mask of removed bytes for each shard."""
    bits, buckets, each = 40, 5, []
    for rows in parts:
        data, offs = vec.strings(pa.array([t for _, t in rows], pa.string()))
        each.append((data, offs, np.array([i for i, _ in rows]), suffix._digests(data, offs)))
    least = {}
    for _, _, ids, ds in each:
        for d, i in zip(ds, ids.tolist(), strict=True):
            least[d] = min(i, least.get(d, i))
    gone = [np.array([d is not None and least[d] < i for d, i in zip(ds, ids.tolist(), strict=True)], bool) for _, _, ids, ds in each]
    keys = []
    for (data, offs, _, _), g in zip(each, gone, strict=True):
        keys.append(suffix.anchor_keys(data[~np.repeat(g, np.diff(offs))], np.concatenate([[0], np.cumsum(np.where(g, 0, np.diff(offs)))]), bits))
    old, suffix.HOT = suffix.HOT, hot
    met = suffix.met_anchors([k for k, _ in keys], [v for _, v in keys])
    suffix.HOT = old
    out, answers = [], []
    for (data, offs, ids, _), g, m in zip(each, gone, met, strict=True):
        x = np.cumsum(m, dtype=np.uint64)
        found = suffix.candidates(data, offs, bits, x >> np.uint64(2), (x & np.uint64(3)).astype(np.uint8), g)
        out.append(suffix.judged(data, offs, ids, g, found, buckets))
        answers.append(np.zeros(len(out[-1][3]), np.uint32))
    for b in range(buckets):
        held = [(k, np.flatnonzero(o[3] == b)) for k, o in enumerate(out)]
        held = [(k, w) for k, w in held if len(w)]
        if held:
            for (k, w), bits_ in zip(held, suffix.smaller_elsewhere([out[k][1][w].ravel() for k, w in held], [out[k][2][w] for k, w in held]), strict=True):
                answers[k][w] = bits_
    return [suffix.cut_of(len(data), offs, o[0], a) for (data, offs, _, _), o, a in zip(each, out, answers, strict=True)]


def repeated_passages(seed):
    rng = random.Random(seed)
    passages, docs = [prose(rng, rng.randint(8, 40)) for _ in range(6)], []
    for i in range(rng.randint(1, 40)):
        text = ""
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            text += prose(rng, rng.randint(0, 12)) + ("ü" if seed % 2 else "") + p[rng.randint(0, len(p) // 2) : rng.randint(len(p) // 2, len(p))]
        docs.append((rng.randint(0, 30) if seed % 3 == 0 else i, "ab" * rng.randint(1, 200) if rng.random() < 0.2 else text))
    docs += docs[:3]
    rng.shuffle(docs)
    n = rng.randint(1, 5)
    return [p for p in (docs[k::n] for k in range(n)) if p]


@pytest.mark.parametrize("hot", [1024, 1, 3])
def test_shards_of_suffixes_against_brute_force(hot):
    """hot: places from which the strings of an anchor go one by one."""
    for seed in range(25):
        parts = repeated_passages(seed)
        want = np.concatenate([c for _, _, c in brute_cuts([d for p in parts for d in p])])
        assert (np.concatenate(shards_of_suffixes(parts, hot)) == want).all()


def test_suffix_order_decides(monkeypatch):
    """With suffixes in a wrong order the result is wrong: nothing else finds repeats inside a shard."""
    parts = [[d for p in repeated_passages(4) for d in p]]
    want = np.concatenate([c for _, _, c in brute_cuts(parts[0])])
    real = suffix.suffix_array

    def shuffled(data):
        sa = np.random.default_rng(1).permutation(real(data)[0])
        rank = np.empty(len(sa), np.int64)
        rank[sa] = np.arange(len(sa))
        return sa, rank

    assert want.any() and (shards_of_suffixes(parts, 1024)[0] == want).all()
    monkeypatch.setattr(suffix, "suffix_array", shuffled)
    assert (shards_of_suffixes(parts, 1024)[0] != want).any()


def test_suffix_dedup(docs, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD", 4000)
    rows = [(r["doc_id"], r["text"]) for r in collect(docs)]
    want = Counter()
    kept = Counter()
    for i, b, cut in brute_cuts(rows):
        edge = np.diff(np.concatenate([[0], cut.astype(int), [0]]))
        left = np.frombuffer(b, np.uint8)[~cut].tobytes()
        want[i, len(b), int(cut.sum()), int((edge == 1).sum()), hashlib.sha256(left).hexdigest()] += 1
        kept[i, left.decode("utf-8", "ignore")] += 1
    got = collect(suffix.repeated_spans(docs))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    out = suffix.without_repeats(docs)
    assert out.schema == docs.schema
    assert Counter((r["doc_id"], r["text"] or "") for r in collect(out)) == kept
    assert suffix.repeated_spans(empty(docs)).count() == 0 and suffix.without_repeats(empty(docs)).count() == 0


# 4

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(t):
    return WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))


def test_winnowing_keeps_a_hash_of_every_window():
    h = np.random.default_rng(2).integers(0, 50, 500).astype(np.uint64)
    for w in (1, 2, 6, 25):
        p = set(vec.winnowed(h, w).tolist())
        assert all(any(i in p for i in range(k, k + w)) for k in range(len(h) - w + 1))
        assert p == {j for k in range(len(h) - w + 1) for j in range(k, k + w) if h[j] == h[k : k + w].min()}


def test_decontamination(spark, docs, texts):
    items = [(1, texts[10]), (2, "one"), (3, texts[5][30:160]), (4, None), (5, ""), (6, " ".join(texts[7].split()[3:10]).upper()), (7, texts[5][30:160]), (None, texts[12]), (8, "ü ß"), (9, "never seen words here")]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, found string")
    want = Counter()
    for r in collect(docs):
        w = words_of(r["text"])
        hit, ids = set(), set()
        for i, t in items:
            v = words_of(t)
            n = min(10, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for p in range(len(w) - n + 1) if n else []:
                if tuple(w[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    ids |= {str(i)} if i is not None else set()
        want[r["doc_id"], len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)] += 1
    got = collect(decontam.judge(docs, bench))
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == want
    clean = decontam.clean_only(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(v for k, v in want.items() if not k[-1])
    assert decontam.judge(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontam.judge(empty(docs), bench).count() == 0


# 5


def test_quality_rules(docs):
    def base(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        g = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        rep = {i + k for i in range(len(w) - 7) if g[tuple(w[i : i + 8])] > 1 for k in range(8)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep)

    got = collect(quality.quality_rules(docs))
    want = Counter((r["doc_id"], *base(r["text"])) for r in collect(docs))
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"]) and r["kept"] == (r["rejected_by"] is None)
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema
    assert Counter(r["doc_id"] for r in collect(kept)) == Counter(r["doc_id"] for r in got if r["kept"])
    assert quality.quality_rules(empty(docs)).count() == 0


def test_rule_order_is_measured(spark):
    """A rule that rejects as much at a hundredth of the cost comes first, each time."""
    text = F.col("t")
    for _ in range(40):
        text = F.regexp_replace(text, "[^a-y]", "q")
    rows = spark.createDataFrame([(i, "z" * 3000 if i % 2 else "fine") for i in range(200)], "id long, t string")
    dear, cheap, never = quality.Rule("dear", F.contains(text, F.lit("qq"))), quality.Rule("cheap", F.length("t") > 100), quality.Rule("never", F.lit(False))
    for _ in range(5):
        assert [r.name for r in quality.plan_cascade(rows, [never, dear, cheap], 200)] == ["cheap", "dear", "never"]
    assert quality.plan_cascade(rows.where("false"), [dear, cheap]) == [dear, cheap]


def test_rule_order_changes_no_verdict(spark, docs):
    rules = quality.default_rules()
    f = quality.base_features(docs)
    got = [Counter(r["id"] for r in collect(f.select("id", quality.cascade_verdict(o).isNull().alias("ok"))) if r["ok"]) for o in (rules, rules[::-1])]
    assert got[0] == got[1]
    slow = quality.Rule("never", F.lit(False))
    hits = quality.Rule("always", F.lit(True))
    assert quality.plan_cascade(f, [slow, hits])[0].name == "always"


# 6


def test_chain_against_all_labelings():
    rng = np.random.default_rng(4)
    a, t, bounds = rng.normal(size=7), rng.normal(size=(2, 2)), np.array([0, 4, 4, 7])
    r, s = crf.chain(a, bounds, t)
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        n = hi - lo
        on, all_ = np.zeros(n), 0.0
        for z in range(1 << n):
            y = [z >> i & 1 for i in range(n)]
            w = np.exp(sum(a[lo + i] * y[i] for i in range(n)) + sum(t[y[i], y[i + 1]] for i in range(n - 1)))
            all_ += w
            on += w * np.array(y)
        if n:
            assert np.allclose(crf.sigmoid((r + s)[lo:hi]), on / all_)


def test_quality_classifier(spark, docs):
    rng = random.Random(2)
    rows = [(i, "\n".join(prose(rng, 12) + ("." if i % 2 else " ### *** $$$") for _ in range(5)), i % 2) for i in range(80)]
    d = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    lab = spark.createDataFrame([(i, y) for i, _, y in rows if i < 60] + [(None, 1), (500, None)], "doc_id long, label int")
    f = crf.train(d, lab)
    got = {r["doc_id"]: r["score"] for r in collect(crf.score(d, f))}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows if i >= 60)
    odd = [r["score"] for r in collect(crf.score(docs.select("doc_id", "text"), f))]
    assert len(odd) == docs.count() and all(0 <= x <= 1 for x in odd)
    assert {round(r["score"], 6) for r in collect(crf.score(docs.where("doc_id in (0, 3)").select("doc_id", "text"), f))} == {round(f.prior, 6)}
    assert crf.score(empty(docs).select("doc_id", "text"), f).count() == 0
    assert crf.train(d.where("false"), lab).prior == 0.5


def plain_features(text):
    """(lengths, features) of a text's lines that aren't blank, written out."""
    lines = [x for x in text.split("\n") if re.search(r"[^ \t\r\x0b\x0c]", x)]
    own, seen = [], set()
    for x in lines:
        b = x.encode()
        count = lambda keep: sum(keep(c) for c in b)
        kinds = [lambda c: chr(c) in "#*$%&<>", lambda c: chr(c) == "|", lambda c: chr(c) == "!", lambda c: 48 <= c <= 57, lambda c: 65 <= c <= 90, lambda c: 97 <= c <= 122 or c >= 128, lambda c: chr(c) in ".,;:?", lambda c: chr(c) in "{}[]()=/\\@_~^"]
        own.append([3 * np.sqrt(count(k) / len(b)) for k in kinds] + [0, float(x in seen), np.log1p(len(b)) / 5])
        seen.add(x)
    last = None
    for x, f in zip(lines, own, strict=True):
        words = re.findall(r"[^ \t\r\x0b\x0c]+", x)
        f[8] = sum(a == b for a, b in zip([last, *words], words, strict=False)) / max(1, len(words))
        last = words[-1]
    zero = [0.0] * 11
    rows = [own[i] + (own[i - 1] if i else zero) + (own[i + 1] if i + 1 < len(own) else zero) + [1.0] for i in range(len(own))]
    return [len(x.encode()) for x in lines], np.array(rows).reshape(len(rows), 34)


def test_scores_against_all_labelings(spark):
    rng = np.random.default_rng(6)
    f = crf.Field(rng.normal(size=34), rng.normal(size=(2, 2)), (1.3, -0.2), 0.4)
    texts = ["one line", "The the END!\n\n  \n### | 12 12\nthe the end", "a b\na b\n{x} == y;\nÜber über", "", None, " \t\n", "x" * 500 + "\n" + "y z " * 30]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(0, texts[0], 0.1)], "doc_id long, text string, score double")
    got = collect(crf.score(docs, f))
    assert len(got) == len(texts) + 1 and got[0].keys() == {"doc_id", "score"}
    for r in got:
        size, x = plain_features(texts[r["doc_id"]] or "")
        if not size:
            assert r["score"] == f.prior
            continue
        a, n = x @ f.w, len(size)
        on, total = np.zeros(n), 0.0
        for z in range(1 << n):
            y = [z >> i & 1 for i in range(n)]
            w = np.exp(sum(a[i] * y[i] for i in range(n)) + sum(f.t[y[i], y[i + 1]] for i in range(n - 1)))
            total, on = total + w, on + w * np.array(y)
        q = min(max(np.average(on / total, weights=size), 1e-4), 1 - 1e-4)
        assert np.isclose(r["score"], 1 / (1 + np.exp(-(1.3 * np.log(q / (1 - q)) - 0.2))))


def test_classifier_sample(spark):
    """Repeated ids count once with their smallest text, long texts count, and the bounds hold."""
    rows = [(i, "good line.\n" * (3 if i else 4000) if i % 2 else "### $$$\n" * 5) for i in range(40)] + [(1, "zzz")] * 200
    d, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 0)] * 50, "doc_id long, label int")
    f = crf.train(d, lab)
    assert f.prior == 0.5 and crf.train(d, lab, max_docs=1).prior in (0.0, 1.0) and crf.train(d, lab, max_bytes=1).prior == 0.5


# 7


def brute_pack(items, capacity):
    bins, out = [], {}
    key = lambda v: (v is not None, v or 0)
    rest = []
    for d, n, s, c in sorted(items, key=lambda x: (key(x[0]), key(x[3]), key(x[2]))):
        for _ in range(n // capacity):
            bins.append([0, set(), set()])
        if n % capacity:
            rest.append((n % capacity, d, s, c))
    rest.sort(key=lambda x: -x[0])
    for n, d, s, c in rest:
        ok = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and (s is None or s not in b[1]) and (c is None or c not in b[2])]
        if ok:
            i = min(ok)[1]
        else:
            bins.append([capacity, set(), set()])
            i = len(bins) - 1
        bins[i][0] -= n
        bins[i][1].add(s)
        bins[i][2].add(c)
        out[d] = i
    return out


def test_packing(docs):
    rng = random.Random(7)
    for _ in range(20):
        items = [(i, rng.choice([0, 1, 5, 30, 64, 100, 130]), rng.choice([None, 1, 2, 65]), rng.choice([None, i, 3])) for i in range(60)]
        got = packing.pack_group(items, 100)
        want = brute_pack(items, 100)
        assert {r[0]: r[4] for r in got if r[3] and r[3] < 100 and r[4] is not None} == want
        assert Counter({i: n for i, n, _, _ in items}) == sum((Counter({r[0]: r[3]}) for r in got), Counter({i: 0 for i in range(60)})) or all(sum(r[3] for r in got if r[0] == i) == n for i, n, _, _ in items)
    rows = collect(packing.pack_documents(docs, capacity=64, group=8))
    n_words = Counter()
    for r in collect(docs):
        n_words[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    got = Counter()
    fill = Counter()
    for r in rows:
        got[r["doc_id"]] += r["n_tokens"]
        fill[r["bin_id"]] += r["n_tokens"]
    assert +got == +n_words and all(v <= 64 for b, v in fill.items() if b is not None)
    assert {r["doc_id"] for r in rows if r["bin_id"] is None} >= {0, 3, 6}
    assert packing.pack_documents(empty(docs)).count() == 0


def test_packing_of_equal_rows(spark):
    """Rows that repeat conflict with one another, so each has a bin of its own; they are spread over the groups."""
    rows = [(7, "a b c", "s")] * 9000 + [(None, "d e", None)] * 500 + [(1, "one", "t"), (2, None, "t")]
    got = collect(packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3), capacity=8))
    bins = Counter(r["bin_id"] for r in got if r["doc_id"] == 7)
    assert len(bins) == 9000 and max(bins.values()) == 1 and sum(r["doc_id"] is None for r in got) == 500
    groups = Counter(b >> 32 for b in bins)
    assert max(groups.values()) < 2 * packing.GROUP and len(groups) >= 9


# 8


def brute_classes(rows):
    bags = []
    for _, t in rows:
        w = words_of(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter())
    df = Counter(s for b in bags for s in b)
    weigh = lambda b: {s: float(near.weights(np.array([n]), np.array([df[s]]), len(rows))[0]) for s, n in b.items()}
    bags = [weigh(b) for b in bags]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                both = sum(min(bags[i][s], bags[j][s]) for s in bags[i].keys() & bags[j].keys())
                if both / (sum(bags[i].values()) + sum(bags[j].values()) - both) >= near.SIMILAR - 1e-6:
                    label[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    low = {g: min((x for x in m if x is not None), default=None) for g, m in groups.items()}
    return Counter((rows[i][0], low[find(i)]) for i in range(len(rows))), len(groups)


def test_near_duplicates(docs, monkeypatch):
    monkeypatch.setattr(shards.pack, "__defaults__", ("text", 4000))
    want, n = brute_classes([(r["doc_id"], r["text"]) for r in collect(docs)])
    got = collect(near.near_duplicates(docs))
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want
    out = near.one_of_each(docs)
    assert out.schema == docs.schema and out.count() == n
    assert near.near_duplicates(empty(docs)).count() == 0 and near.one_of_each(empty(docs)).count() == 0


def dense_classes(rows, damp=None):
    """Classes (id -> smallest id) over all pairs, without a limit on how common a shingle is."""
    bags = []
    for _, t in rows:
        w = words_of(t)
        bags.append(Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    number = {s: k for k, s in enumerate({s for b in bags for s in b})}
    m = np.zeros((len(rows), len(number)))
    for r, b in enumerate(bags):
        m[r, [number[s] for s in b]] = list(b.values())
    m = near.weights(m, (m > 0).sum(axis=0), len(rows)) if damp is None else m * (1 + damp * np.log(len(rows) / (m > 0).sum(axis=0)) / np.log(len(rows)))
    total, label = m.sum(axis=1), np.arange(len(rows))
    for i in range(len(rows)):
        on = np.flatnonzero(m[i])
        both = np.minimum(m[: i + 1, on], m[i, on]).sum(axis=1)
        for j in np.flatnonzero(both >= (near.SIMILAR - 1e-6) * (total[: i + 1] + total[i] - both)):
            label[label == label[i]] = label[j]
    low = {}
    for (i, _), c in zip(rows, label, strict=True):
        low[c] = min(i, low.get(c, i))
    return {i: low[c] for (i, _), c in zip(rows, label, strict=True)}


def near_groups(seed):
    """Large groups of copies with random edits, so that most pairs lie near 0.8, and a chain whose ends share nothing."""
    rng, rows = random.Random(seed), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    for size in (600, 200, 60, 30, 9):
        base = [word() for _ in range(150)]
        for _ in range(size):
            mine = list(base)
            for k in rng.sample(range(150), rng.randint(1, 3)):
                mine[k] = word()
            rows.append(" ".join(mine))
    walk = [word() for _ in range(150 + 12 * 60)]
    rows += [" ".join(walk[12 * k : 12 * k + 150]) for k in range(60)]
    rows += [" ".join(word() for _ in range(40)) for _ in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("tight", [False, True])
def test_large_groups_keep_every_link(spark, monkeypatch, tight):
    """tight: few leaders, small parts and blocks, and every bucket of three or more by the broadcast that large ones take."""
    for name, value in (("ALL_PAIRS", 2), ("PART", 16), ("LEADERS", 1), ("ROUNDS", 1), ("BIG", 2)) if tight else ():
        monkeypatch.setattr(near, name, value)
    rows = near_groups(11 + tight)
    want = dense_classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in collect(near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))}
    found = Counter(zip(want.values(), (got[i] for i in want), strict=True))
    pairs = lambda n: n * (n - 1) // 2
    recall = sum(map(pairs, found.values())) / sum(map(pairs, Counter(want.values()).values()))
    assert recall >= 0.99 and all(want[c] == want[i] for i, c in got.items())


def test_no_link_depends_on_leaders(spark, monkeypatch):
    """Mixes of passages, each with one partner: with one leader a bucket and no further rounds, most partners never meet a leader."""
    for name, value in (("ALL_PAIRS", 2), ("LEADERS", 1), ("ROUNDS", 0)):
        monkeypatch.setattr(near, name, value)
    rng, rows, pool = random.Random(5), [], [" ".join(f"w{i}x{k}" for k in range(8)) for i in range(30)]
    for p in range(80):
        mine = rng.sample(range(30), 20)
        for copy in range(2):
            rows.append((2 * p + copy, " ".join(pool[i] for i in sorted(mine))))
            mine[0] = next(i for i in range(30) if i not in mine)
    want, n = brute_classes(rows)
    assert n > 30
    got = collect(near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(9)
    keys = np.sort(rng.integers(0, 1 << 40, 300).astype(np.uint64))
    w = [rng.random(300).astype(np.float32) + 0.2 for _ in range(2)]
    same = [near.samples(keys, w[0], np.array([0]), k)[0] == near.samples(keys, w[1], np.array([0]), k)[0] for k in range(1500)]
    assert abs(np.mean(same) - np.minimum(*w).sum() / np.maximum(*w).sum()) < 0.05


# 9


def test_long_turns_keep_the_system_turn(spark):
    say = lambda n: " ".join(["a"] * n)  # noqa: E731  n tokens, and 5 for the turn and its role
    turns = [("system", 20), ("user", 35), ("assistant", 10), ("user", 60), ("assistant", 9), ("user", 96), ("assistant", 5)]
    df = spark.createDataFrame([(1, i, r, say(n)) for i, (r, n) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = sorted(chat.format_windows(df, 100, 2, None).collect(), key=lambda r: r["window"])
    assert [(r["n_repeated"], r["n_new"], r["tokens"]) for r in got] == [(0, 3, 80), (1, 1, 90), (1, 1, 39), (0, 1, 101), (1, 1, 35)]
    for r in got:
        new = r["tokens"] if r["n_repeated"] == 0 else 0
        assert r["text"].startswith("<|im_start|>system") or 25 + new > 100
    assert [r["over_budget"] for r in got] == [False] * 3 + [True, False]


def test_chat_windows(spark):
    rng = random.Random(3)
    rows = []
    for c in [None, -1, 0, 1, 2]:
        for k in range(rng.randint(2, 14)):
            role = "system" if k == 0 and c != 1 else rng.choice(["user", "assistant", "assistant", "a\nb\\n", None])
            rows.append((c, k, role, rng.choice([None, "", "<|im_end|><|im_start|>assistant ok", "a\\n <\\| b <<|", prose(rng, 40), prose(rng, 200)])))
    rows += [rows[-1], (2, None, "assistant", "null turn")]
    conv = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, window int")
    for vocabulary in (chat.VOCABULARY, None):
        win = chat.format_windows(conv, budget=120, vocabulary=vocabulary)
        got = {r["conv_id"]: r for r in collect(chat.read_back(win))}
        for c in {r[0] for r in rows}:
            mine = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
            said = "".join(t for _, role, t in mine if role == "assistant")
            g = got[c]
            assert (g["n_turns"], g["turns_sha256"]) == (len(mine), hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in mine).encode()).hexdigest())
            assert (g["loss_chars"], g["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        for r in collect(win):
            assert r["over_budget"] == (r["tokens"] > 120) and (not r["over_budget"] or r["n_new"] == 1)
    first = [r for r in collect(win) if r["conv_id"] == 0]
    assert all(r["text"].startswith("<|im_start|>system") for r in first if r["n_repeated"] or r["window"] == 0)
    assert chat.read_back(chat.format_windows(conv.where("false"))).count() == 0


def test_a_very_long_conversation(spark):
    rows = [(c, i, "system" if i == 0 else "assistant" if i % 2 else "user", f"turn {i} " + "w " * (i % 40)) for c, n in ((1, 6000), (2, 3)) for i in range(n)]
    win = chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=100, vocabulary=None)
    got = {r["conv_id"]: r for r in collect(chat.read_back(win))}
    said = "".join(t for c, _, role, t in rows if c == 1 and role == "assistant")
    assert got[1]["n_turns"] == 6000 and got[1]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert all(r["text"].startswith("<|im_start|>system") and (r["tokens"] <= 100) for r in collect(win))


def test_windows_take_the_longest_span(spark):
    """Each window ends where the next turn would pass the budget."""
    rng = random.Random(9)
    rows = [(c, i, rng.choice(["user", "assistant"]), "w " * rng.randint(1, 40)) for c in range(5) for i in range(30)]
    win = collect(chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=90, history=0, vocabulary=None))
    size = {c: [len(t.split()) + 1 + chat.TURN_OVERHEAD for k, _, _, t in rows if k == c] for c in range(5)}
    for c in range(5):
        at = 0
        for r in sorted((r for r in win if r["conv_id"] == c), key=lambda r: r["window"]):
            end = at + r["n_new"]
            assert r["tokens"] == sum(size[c][at:end]) <= 90 and (end == 30 or sum(size[c][at : end + 1]) > 90)
            at = end
        assert at == 30


# 10


def test_urls(spark):
    rng = random.Random(8)
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("b.c", "/x", "block"), ("B.c", "/x", "allow"), ("", "/", "block"), (None, "/", "block")]
    hosts, paths = ["a.NET", "example.net", "notexample.net", "m.example.com", "example.org", "q.b.c", "b.c", "net", "", "x..net", ".net"], ["", "/", "/en/1", "/en", "/de/?x", "/fr/#a", "/x", "/xy/z", "?a=/en/", "#/"]
    made = [None, "", "no scheme.net/", "://net/", "http://", "a://b.c/x://net/"] + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(120)]
    made += ["http://" + "a." * 3000 + "net/" + "p/" * 3000]
    pages = spark.createDataFrame([(i % 90, u, "h") for i, u in enumerate(made)] + [(1, "http://net/", "h")] * 3, "page_id long, url string, host string")
    table = {}
    for h, p, v in rules:
        if h:
            table[h.lower(), p] = "block" if "block" in (v, table.get((h.lower(), p))) else "allow"

    def judge(u):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h + p), v == "block", h + p, v) for (h, p), v in table.items() if ("." + host).endswith("." + h) and path.startswith(p)]
        return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, "allow")

    want = Counter((r["page_id"], *judge(r["url"])) for r in collect(pages))
    rule_df = spark.createDataFrame(rules, "host string, path string, verdict string")
    for bound in (urls.BROADCAST_RULES, 0):
        old, urls.BROADCAST_RULES = urls.BROADCAST_RULES, bound
        got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in collect(urls.judge_urls(pages, rule_df)))
        urls.BROADCAST_RULES = old
        assert got == want
    assert {r["verdict"] for r in collect(urls.judge_urls(pages, rule_df.where("false"), default="block"))} == {"block"}
    assert urls.judge_urls(pages.where("false"), rule_df).count() == 0
