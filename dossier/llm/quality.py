"""Quality rules as a short-circuit cascade, in DataFrame functions only.

`plan_cascade` evaluates every rule on a bounded sample between two readings of the clock, in one job that reads only as many
partitions as the sample needs and returns numbers; it orders the rules by rejections per nanosecond. `cascade_verdict` compiles that
order into one lazily evaluated CASE, so a row stops at its first rejecting rule. The order changes cost only: a text is
kept exactly when no rule rejects it. Rules that reject nothing in the sample come last, in the order given: every kept row meets them all.

In `quality_rules` the base columns are results and are computed for every row. In `keep_good` the base conditions are rules like
the others, and what a rule needs beyond the words of a text (windows, lines, letters) is inside its branch of the CASE.

Defined results: a null or empty text has no words, zero counts and fails the base rule. Repeated rows stay repeated. An
empty table gives an empty result and the rules keep the order given. 8-word windows are compared by 64-bit hashes. Columns of
any name may come along.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 400  # bound of the sample that orders the rules; it decides no row
LEAST_NS = 1000  # a shorter evaluation counts as this


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once, and only where the result is."""
    return F.transform(F.array(value), use)[0]


def _count_of(text: Column, chars: str) -> Column:
    """How often any of the given characters occurs; replace() searches bytes and builds no object per character."""
    rest = text
    for ch in chars:
        rest = F.replace(rest, F.lit(ch), F.lit(""))
    return (F.length(text) - F.length(rest)).cast("long")


def _matching(text: Column, other: str) -> Column:
    """Characters outside the class `other`."""
    return F.length(F.regexp_replace(text, f"{other}+", "")).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words in WINDOW-word windows that are in the text twice or more."""
    n = F.size(words)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    same = lambda p, x, j: F.coalesce(F.get(p, j)["g"] == x["g"], F.lit(False))
    twice = lambda p: F.filter(p, lambda x, j: same(p, x, j + 1) | F.when(j > 0, same(p, x, j - 1)).otherwise(False))
    covered = lambda starts: F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
    )["n"]
    of = lambda g: _let(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), lambda p: covered(F.sort_array(F.transform(twice(p), lambda x: x["i"]))))
    # only a text with a repeated window pays for the sort
    found = _let(_let(hashes, grams), lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), of(g)).otherwise(F.lit(0).cast("long")))
    return F.when(n > WINDOW, found).otherwise(F.lit(0).cast("long"))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, t (the text, null as empty), words, n_words."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    words = _let(F.btrim("t", F.lit(SPACE)), lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, r"[\x20\x09-\x0D]+")))
    return d.withColumn("words", words).withColumn("n_words", F.size("words").cast("long"))


def _features() -> dict[str, Column]:
    """What rules ask of t and words."""
    lines = F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    return {
        "n_words": F.col("n_words"),
        "word_chars": F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "n_symbols": _count_of(F.col("t"), SYMBOLS),
        "lines": _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("copies"))),
        "n_repeat_words": _repeat_words(F.col("words")),
    }


def base_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, t (the text, null as empty), n_words, word_chars, n_symbols, lines (n, copies), n_repeat_words."""
    return _read(docs, id_col, text_col).select("id", "t", *[c.alias(name) for name, c in _features().items()])


def base_rules(f: dict[str, Column]) -> list[Rule]:
    return [Rule("short", f["n_words"] < MIN_WORDS), Rule("repeats", 100 * f["n_repeat_words"] > 30 * f["n_words"])]


def base_failed() -> Column:
    short, repeats = base_rules({k: F.col(k) for k in ("n_words", "n_repeat_words")})
    return short.rejects | repeats.rejects


def default_rules(f: dict[str, Column] | None = None) -> list[Rule]:
    """Rules over t and the columns of base_features, or over the expressions given for these."""
    f = f or {k: F.col(k) for k in _features()}
    n, letters = f["n_words"], _matching(F.col("t"), r"\P{L}")
    return [
        Rule("symbols", 100 * f["n_symbols"] > 10 * n),
        Rule("exclamations", 100 * _count_of(F.col("t"), "!") > 20 * n),
        Rule("capitals", 100 * _matching(F.col("t"), r"\P{Lu}") > 50 * letters),
        Rule("no_letters", 2 * letters < f["word_chars"]),
        Rule("line_copies", _let(f["lines"], lambda x: (x["n"] >= 4) & (2 * x["copies"] > x["n"]))),
        Rule("word_length", _let(f["word_chars"], lambda x: (x > 25 * n) | (2 * x < 3 * n))),
        Rule("braces", 100 * _count_of(F.col("t"), "{}") > 10 * n),
    ]


def plan_cascade(features: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS, judged: Column | None = None) -> list[Rule]:
    """The rules by rejections per nanosecond on a sample of at most sample_rows rows, best first; ties keep the order given.

    judged: which rows of the sample count. Each rule's time is the median over the later half of the rows, when code is compiled."""
    clock = F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    cells = [F.coalesce(F.lit(True) if judged is None else judged, F.lit(False)).alias("judged"), clock.alias("c0")]
    for k, r in enumerate(rules):
        cells += [F.coalesce(r.rejects, F.lit(False)).alias(f"r{k}"), clock.alias(f"c{k + 1}")]
    rows = [x[0] for x in features.select(F.struct(*cells)).take(sample_rows)]  # reads partition by partition until it has enough
    seen = [x for x in rows if x["judged"]]
    if not seen:
        return rules
    score = []
    for k in range(len(rules)):
        ns = median(x[f"c{k + 1}"] - x[f"c{k}"] for x in rows[len(rows) // 2 :])
        score.append(sum(x[f"r{k}"] for x in seen) / len(seen) / max(ns, LEAST_NS))
    return [r for _, _, r in sorted(((-s, k, r) for k, (s, r) in enumerate(zip(score, rules, strict=True))), key=lambda x: x[:2])]


def cascade_verdict(rules: list[Rule]) -> Column:
    """The first rejecting rule's name, or null."""
    out = None
    for r in rules:
        out = F.when(r.rejects, r.name) if out is None else out.when(r.rejects, r.name)
    return F.lit(None).cast("string") if out is None else out


def quality_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the base columns, base_failed, kept and rejected_by (`base`, a rule's name, or null) for each row."""
    f = base_features(docs, id_col, text_col)
    rules = plan_cascade(f, default_rules() if rules is None else rules, sample_rows, ~base_failed())
    by = F.when(base_failed(), "base").otherwise(cascade_verdict(rules))
    return f.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", F.col("lines.copies").alias("n_dup_lines"), "n_repeat_words",
        base_failed().alias("base_failed"), by.isNull().alias("kept"), by.alias("rejected_by"),
    )


def keep_good(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns."""
    d = _read(docs.select(F.struct("*").alias("row"), F.col("text").alias("t")), "row", "t")
    f = _features()
    rules = plan_cascade(d, [*base_rules(f), *default_rules(f)], sample_rows)
    kept = d.select("id", cascade_verdict(rules).isNull().alias("kept"))
    # a filter would be pushed down and repeat the words' expressions; a generator is not
    return kept.select("id", F.explode(F.when(F.col("kept"), F.array(F.lit(1)))).alias("one")).select("id.*")
