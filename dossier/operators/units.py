"""Predicates and names on text units (inventory F1-F28). Sections are in sections.py, narrative predicates in narrative.py."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.rules import EVENT_RULES, EventRules
from dossier.functions.text import any_of, chinese_number, date_key, let, norm, squash

from .headings import EVENT_NUMBERING, level_of

# The two date forms, in order of precedence; disclosed counts by type; types that name two events at once; ordinals.
DATES = [r"(?:19|20)\d{2}年(?:\d{1,2}月(?:\d{1,2}日)?)?", r"(?:19|20)\d{2}[./-]\d{1,2}(?:[./-]\d{1,2})?"]
_C = "([一二两三四五六七八九十\\d]+)"
COUNTS = [("EQUITY_TRANSFER", f"{_C}次(?:股权转让|股份转让)"), ("CAPITAL_INCREASE", f"{_C}次(?:增资扩股|增资)"), ("SHARE_CAPITAL_CHANGE", f"{_C}次资本公积转增股本"), ("LISTING_OR_DIRECTIONAL_FINANCING", f"共进行过{_C}次定向发行")]
COMBINED = r"(?:股权转让|股份转让).{0,12}(?:和|及|并).{0,12}增资|增资.{0,12}(?:和|及|并).{0,12}(?:股权转让|股份转让)"
ORDINAL = r"第([一二三四五六七八九十百\d]+)次"
HEADING_CHARS, NEGATIVE_UNITS, HISTORY_UNITS, REFERENCE_UNITS = 150, 10, 7, 3


def _matches(s: Column, patterns: list[str]) -> Column:
    return s.rlike("|".join(f"(?:{p})" for p in patterns))


def _holds(s: Column, terms: list[str]) -> Column:
    return s.rlike(any_of(terms))


def dates_of(c: Column) -> Column:
    """dates in order of pattern, each once."""
    return let(squash(c), lambda s: F.array_distinct(F.concat(*[F.regexp_extract_all(s, F.lit(p), F.lit(0)) for p in DATES])))


def dates_in(flat: Column) -> Column:
    """dates_of() of a text that has no white space: a pattern is tried only where one of its characters is."""
    marks = [["年"], [".", "/", "-"]]
    has = lambda xs: reduce(or_, [flat.contains(x) for x in xs])
    found = [F.when(has(xs), F.regexp_extract_all(flat, F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")) for p, xs in zip(DATES, marks, strict=True)]
    return F.array_distinct(F.concat(*found))


def heading_like(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """F3."""
    return let(norm(c), lambda s: (F.length(s) <= HEADING_CHARS) & ((level_of(s, EVENT_NUMBERING, 9) < 9) | s.rlike(f"(?:{any_of(rules.heading_suffixes)})$")))


def typed(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """struct(types, combined): the event types of a text, longest term or pattern first, then by priority; broader types go where a
    narrower is found; several stay only where the text combines them; a trading venue is no transfer."""

    def of(s: Column) -> Column:
        hits = []
        for rank, kind in enumerate(rules.priority):
            sizes = [F.when(s.contains(t), len(t)) for t in rules.terms.get(kind, [])] + [F.length(F.regexp_extract(s, p, 0)) for p in rules.patterns.get(kind, [])]
            n = F.greatest(F.lit(0), *sizes)
            hit = (n > 0) & ~_holds(s, rules.venues) if kind == "EQUITY_TRANSFER" else n > 0
            hits.append(F.when(hit, F.struct((-n).alias("n"), F.lit(rank).alias("r"), F.lit(kind).alias("kind"))))
        return F.transform(F.array_sort(F.array_compact(F.array(*hits))), lambda x: x["kind"])

    def left(found: Column) -> Column:
        out = found
        for kind, by in rules.suppressed.items():
            out = F.when(F.arrays_overlap(found, F.array(*[F.lit(b) for b in by])), F.array_remove(out, kind)).otherwise(out)
        return out

    one = lambda k, both: F.struct(F.when(both, k).otherwise(F.slice(k, 1, 1)).alias("types"), both.alias("combined"))
    return let(norm(c), lambda s: let(let(of(s), left), lambda k: one(k, (F.size(k) > 1) & (_holds(s, rules.combined) | s.rlike(COMBINED)))))


def event_types(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    return typed(c, rules)["types"]


def generic_summary(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a heading of a whole history."""
    return _holds(norm(c), rules.generic_summary)


def background_heading(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a heading of an event's circumstances."""
    return _holds(norm(c), rules.background)


def provider_mentions(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """the service providers named, in the rules' order."""
    return let(norm(c), lambda s: F.array_compact(F.array(*[F.when(s.contains(t), F.lit(t)) for t in rules.providers])))


def provider_only(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a service provider acts or supports, and the issuer does nothing."""
    return let(norm(c), lambda s: _holds(s, rules.providers) & ~_holds(s, rules.issuer_deals) & (_holds(s, rules.provider_actions) | _holds(s, rules.provider_support)))


def negative_reason(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """the first pattern by which a text (a section's first NEGATIVE_UNITS units) denies an event, or null."""
    return let(norm(c), lambda s: F.coalesce(*[F.when(s.rlike(p), F.lit(p)) for p in rules.negative]))


def ordinals(c: Column) -> Column:
    """F8: `第N次` labels, each once."""
    return F.array_distinct(F.transform(F.regexp_extract_all(norm(c), F.lit(ORDINAL), F.lit(1)), lambda x: F.concat(F.lit("第"), x, F.lit("次"))))


def provider_history(context: Column, rules: EventRules = EVENT_RULES) -> Column:
    """in a unit and the HISTORY_UNITS after it on its page, a provider, a report and a disclosed count."""
    return let(norm(context), lambda s: _holds(s, rules.providers) & _holds(s, rules.provider_reports) & _matches(s, [p for _, p in COUNTS]))


def timeline_row(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a row of a table of years."""
    return _matches(norm(c), rules.timeline_rows)


def aggregate_statement(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """says how many events there were."""
    return _matches(norm(c), rules.aggregate)


def metadata_date(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a field of the company's particulars."""
    return _matches(norm(c), rules.metadata_dates)


def reference_only(context: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a text (REFERENCE_UNITS units at most) that points elsewhere and gives no detail."""
    return let(norm(context), lambda s: _matches(s, rules.references) & ~_matches(s, rules.details))


def date_role(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """the first role whose words the text holds."""
    return let(norm(c), lambda s: F.coalesce(*[F.when(_holds(s, words), F.lit(role)) for role, words in rules.date_roles.items()], F.lit("other_date")))


def section_dates(units: DataFrame, keys: list[str], rules: EventRules = EVENT_RULES) -> DataFrame:
    """(keys, date_role, date_key, seq), each role and date of a section once, in order; dates of its title are its event_period.

    units: keys, global_index, line, is_title."""
    d = units.select(*keys, "global_index", "is_title", date_role(F.col("line"), rules).alias("role"), F.posexplode(dates_of(F.col("line"))).alias("at", "text"))
    d = d.withColumn("date_key", date_key(F.col("text")))
    titles = d.where("is_title").select(*keys, F.lit("event_period").alias("date_role"), "date_key", F.struct(F.lit(-1).cast("long").alias("i"), "at").alias("seq"))
    rest = d.select(*keys, F.col("role").alias("date_role"), "date_key", F.struct(F.col("global_index").cast("long").alias("i"), "at").alias("seq"))
    return titles.unionByName(rest).groupBy(*keys, "date_role", "date_key").agg(F.min("seq").alias("seq"))


def disclosed_counts(c: Column) -> Column:
    """a map of type and largest disclosed count."""
    tops = lambda s: F.array(*[F.array_max(F.transform(F.regexp_extract_all(s, F.lit(p), F.lit(1)), chinese_number)) for _, p in COUNTS])
    kinds = F.array(*[F.lit(k) for k, _ in COUNTS])
    return let(norm(c), lambda s: F.map_filter(F.map_from_arrays(kinds, tops(s)), lambda k, v: v.isNotNull()))


def with_context(units: DataFrame, name: str, before: int, after: int, same_page: bool = False, sep: str = "") -> DataFrame:
    """units with the joined lines from `before` units before to `after` units after, of the page alone if same_page. A range frame
    of bounded length over global_index."""
    w = W.partitionBy("company_id", *(["page"] if same_page else [])).orderBy("global_index").rangeBetween(-before, after)
    return units.withColumn(name, F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("global_index", "line")).over(w)), lambda x: x["line"]), sep))
