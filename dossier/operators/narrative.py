"""Narrative predicates, subjects and date preference (inventory E4, E5, F12, F13, F15-F25, F27, F28, G23, H1, H2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossier.functions.rules import DATE_CHOICE, DATE_ROLES, EARLIEST_DATE, EVENT_RULES, WINDOW, EventRules
from dossier.functions.text import any_of, let, norm, squash

from .units import dates_of, ordinals

# Procedures, marks of an event that stands alone, what stands before a set-up's subject and what tells it.
PROCEDURAL = ["签署", "签订", "召开股东会", "召开董事会", "审议通过", "支付", "缴款", "到账", "办理工商变更", "完成工商变更", "办理完毕工商变更", "取得营业执照", "出具", "验资", "审验", "评估", "核准", "登记"]
MARKERS = ["第一次股权转让", "第二次股权转让", "第三次股权转让", "第一次增资", "第二次增资", "第三次增资", "整体变更", "股份公司设立", "有限公司设立", "资本公积转增股本", "吸收合并"]
_CHAR = "[一-鿿A-Za-z0-9（）()]"
_LEGAL = "(?:有限责任公司|有限公司|有限)"
_BEFORE = r"(?:^|[，。；、：:]|公司前身|发行人前身|本公司前身|前身|(?:19|20)\d{2}年(?:\d{1,2}月(?:\d{1,2}日)?)?)"
_SET_UP = "(?:成立(?!日期|时间)|设立(?:情况|程序)?|取得[^，。；]{0,16}?营业执照|办理[^，。；]{0,16}?工商(?:设立|注册)?登记)"
SCOPE_UNITS, OPENING_UNITS = 40, 6


def range_signals(text: Column, rules: dict = WINDOW) -> tuple[Column, Column]:
    """(distinct date tokens, event categories) of a range's text."""
    s = squash(text)
    return dates_of(text), F.array_compact(F.array(*[F.when(s.rlike(any_of(ts)), F.lit(k)) for k, ts in sorted(rules["categories"].items())]))


def valid_range(text: Column, title: Column | None = None, rules: dict = WINDOW) -> Column:
    """E5: enough categories and dates, no excluded word, and no title of a fixed table."""
    d, c = range_signals(text, rules)
    ok = (F.size(d) >= rules["least_dates"]) & (F.size(c) >= rules["least_categories"]) & ~squash(text).rlike(any_of(rules["exclude"]))
    return ok if title is None else ok & ~F.coalesce(norm(title).rlike(any_of(rules["static"])), F.lit(False))


def wrapper_heading(line: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a heading that sorts events under it."""
    return norm(line).rlike(any_of(rules.wrappers))


def procedural(line: Column, rules: EventRules = EVENT_RULES) -> Column:
    """starts with a year, tells a procedure, and names no ordinal or event that stands alone."""
    s = norm(line)
    return s.rlike(r"^(?:19|20)\d{2}年") & (F.size(ordinals(line)) == 0) & ~s.rlike(any_of(MARKERS)) & s.rlike(any_of(PROCEDURAL))


def preferred_roles(kind: Column) -> Column:
    """the date roles of an event type, best first."""
    table = F.create_map(*[x for k, roles in DATE_CHOICE.items() for x in (F.lit(k), F.array(*[F.lit(r) for r in roles]))])
    return F.coalesce(table[kind], F.array(*[F.lit(r) for r in DATE_ROLES]))


def primary_date(dates: DataFrame, keys: list[str], kind: str = "kind") -> DataFrame:
    """(keys, primary_date, role, basis): the first date of the title; else, of the best role of the type that has any, the earliest for set-ups and changes of
    form and the first found otherwise. Keys without such a date have no row.

    dates: keys, kind, date_role, date_key, seq (in order of finding) and title (whether the date is one of the title)."""
    rank = F.when(F.col("title"), 0).otherwise(F.array_position(preferred_roles(F.col(kind)), F.col("date_role")))
    tie = F.when(F.col(kind).isin(EARLIEST_DATE) & ~F.col("title"), F.col("date_key")).otherwise(F.lit(""))
    best = F.min(F.struct(rank.alias("r"), tie.alias("t"), "seq", "date_key", "date_role"))
    b = dates.where(F.col("title") | (rank > 0)).groupBy(*keys).agg(best.alias("b"))
    basis = F.when(F.col("b.r") == 0, "TITLE_DATE").otherwise(F.concat(F.lit("ROLE_PRIORITY:"), F.col("b.date_role")))
    return b.select(*keys, F.col("b.date_key").alias("primary_date"), F.when(F.col("b.r") == 0, "event_period").otherwise(F.col("b.date_role")).alias("role"), basis.alias("basis"))


def clean_subject(c: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a name without a year, leading phrases and trailing particles, as often as they come."""
    s = F.regexp_replace(norm(c), r"^(?:19|20)\d{2}年", "")
    s = F.regexp_replace(s, f"^(?:{any_of(rules.subject_prefixes)})+", "")
    return F.regexp_replace(s, f"(?:{any_of(rules.subject_suffixes)})+$", "")


def generic_subject(cleaned: Column, rules: EventRules = EVENT_RULES) -> Column:
    """no name but a legal form, numbered or not."""
    bare = F.regexp_replace(cleaned, r"^[（(]?[一二三四五六七八九十百\d]+[）)、.]?", "")
    return (cleaned == "") | cleaned.isin(rules.generic_subjects) | bare.isin(rules.generic_subjects)


def issuer_tokens(short_name: Column, rules: EventRules = EVENT_RULES) -> Column:
    """the issuer's short name, what is left of it as business words go from its end one by one, and the last two characters of the rest."""
    strip = lambda s: F.regexp_replace(s, f"^(.+?)(?:{any_of(rules.business_suffixes)})$", "$1")
    start = F.struct(norm(short_name).alias("s"), F.array(norm(short_name)).alias("all"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(16)), start, lambda a, _: let(strip(a["s"]), lambda s: F.struct(s.alias("s"), F.array_union(a["all"], F.array(s)).alias("all"))))
    return let(end, lambda x: F.filter(F.array_union(x["all"], F.when(F.length(x["s"]) >= 2, F.array(F.right(x["s"], F.lit(2)))).otherwise(F.array().cast("array<string>"))), lambda t: t != ""))


def named(text: Column, patterns: list[str], rules: EventRules) -> Column:
    found = F.concat(*[F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in patterns])
    return F.array_distinct(F.filter(F.transform(found, lambda x: clean_subject(x, rules)), lambda x: x != ""))


def predecessors(text: Column, rules: EventRules = EVENT_RULES) -> Column:
    """names that a text relates to the issuer as its predecessor."""
    return let(norm(text), lambda s: named(s, rules.relations, rules))


def absorbed(text: Column, rules: EventRules = EVENT_RULES) -> Column:
    """counterparties of mergers."""
    return let(norm(text), lambda s: named(s, rules.counterparties, rules))


def meets(name: Column, names: Column) -> Column:
    """Whether the name is, holds or is held by one of the names."""
    return F.exists(names, lambda x: (x == name) | x.contains(name) | name.contains(x))


def other_subjects(text: Column, short_name: Column, rules: EventRules = EVENT_RULES) -> Column:
    """Subjects of a text that are neither generic, nor the issuer, its predecessor or a provider; counterparties of mergers count."""

    def keep(x: Column, own: Column) -> Column:
        mine = (own["issuer"] != "") & (own["issuer"].contains(x) | x.contains(own["issuer"]))
        before = meets(x, own["before"]) | (x.rlike(f"(?:{any_of(rules.legal_suffixes)})$") & F.exists(own["tokens"], lambda t: x.contains(t)))
        return ~generic_subject(x, rules) & ~mine & (meets(x, own["gone"]) | ~(before | x.rlike(any_of(rules.providers))))

    own = F.struct(norm(short_name).alias("issuer"), predecessors(text, rules).alias("before"), absorbed(text, rules).alias("gone"), issuer_tokens(short_name, rules).alias("tokens"), let(norm(text), lambda s: named(s, rules.subjects, rules)).alias("found"))
    return let(own, lambda o: F.filter(o["found"], lambda x: keep(x, o)))


def entity_scope(text: Column, short_name: Column, rules: EventRules = EVENT_RULES) -> Column:
    """F16: whether a section's text (its first SCOPE_UNITS units) speaks of a subsidiary or another entity."""
    risk = norm(text).rlike(any_of(rules.subsidiaries)) | (F.size(other_subjects(text, short_name, rules)) > 0)
    return F.when(risk, "SUBSIDIARY_OR_OTHER_ENTITY_RISK").otherwise("ISSUER_OR_UNRESOLVED")


def stem(name: Column, rules: EventRules) -> Column:
    return F.regexp_replace(clean_subject(name, rules), f"(?:{any_of(rules.legal_suffixes)})$", "")


def best_predecessor(names: DataFrame, issuers: DataFrame, rules: EventRules = EVENT_RULES) -> DataFrame:
    """by exact core, then fewest characters beside a core, then length, then name. issuers: company_id, issuer."""
    j = names.join(issuers, "company_id").withColumn("_s", stem(F.col("name"), rules)).withColumn("_t", issuer_tokens(F.col("issuer"), rules)).withColumn("_c", clean_subject(F.col("name"), rules))
    extra = F.array_min(F.transform(F.filter("_t", lambda t: F.col("_s").contains(t)), lambda t: F.length("_s") - F.length(t)))
    key = F.struct((~F.array_contains("_t", F.col("_s"))).cast("int").alias("a"), F.coalesce(extra, F.length("_s")).alias("b"), F.length("_c").alias("c"), F.col("_c").alias("name"))
    return j.groupBy("company_id").agg(F.min(key)["name"].alias("predecessor"))


def setup_row(line: Column, rules: EventRules = EVENT_RULES) -> Column:
    """a row that tells an unnamed set-up."""
    return norm(line).rlike("|".join(f"(?:{p})" for p in rules.setup_rows))


_SAID = f"({_BEFORE}{_CHAR}{{1,36}}?{_LEGAL})(?=[^，。；]{{0,24}}?{_SET_UP})"
_SAID_AT_ONCE = f"({_BEFORE}{_CHAR}{{1,36}}?{_LEGAL})(?=的?(?:成立(?!日期|时间)|设立(?:情况|程序)?))"


def set_up_names(flat: Column, tokens: Column, at_once: bool = False) -> Column:
    """names that begin with one of the tokens, have a legal form and are said to be set up (at_once: by the very next word). One fixed pattern finds every name of a legal form that is set up, with what stands
    before it; the tokens are tested on what it found, so no pattern is made for a row."""

    def beginning(x: Column, t: Column) -> Column:
        name = F.substr(x, F.instr(x, t))
        beside = F.length(F.regexp_replace(name, f"{_LEGAL}$", "")) - F.length(t)
        return F.when((F.instr(x, t) > 0) & F.substr(x, F.lit(1), F.instr(x, t) - 1).rlike(f"{_BEFORE}$") & beside.between(0, 12), name)

    found = F.regexp_extract_all(flat, F.lit(_SAID_AT_ONCE if at_once else _SAID), F.lit(1))
    return F.array_distinct(F.flatten(F.transform(found, lambda x: F.array_compact(F.transform(tokens, lambda t: beginning(x, t))))))


def own_establishment(opening: Column, short_name: Column, rules: EventRules = EVENT_RULES) -> Column:
    """whether a section's title and first OPENING_UNITS units tell the set-up of the issuer itself: a name of exactly an issuer's core and a legal form that is
    said to be set up and isn't a merger's counterparty."""
    held = F.struct(norm(opening).alias("s"), issuer_tokens(short_name, rules).alias("tokens"), absorbed(opening, rules).alias("gone"))

    def found(h: Column) -> Column:
        said = set_up_names(h["s"], h["tokens"])
        exact = lambda x: let(stem(x, rules), lambda s: F.array_contains(h["tokens"], s)) & ~meets(clean_subject(x, rules), h["gone"])
        return h["s"].rlike(any_of(rules.openings)) & F.exists(said, exact)

    return let(held, found)


def candidate_problems(candidates: DataFrame, evidence: DataFrame, ranges: DataFrame, negatives: DataFrame | None = None, holders: DataFrame | None = None, holder_ranges: DataFrame | None = None) -> DataFrame:
    """(record_id, problem), a row for each rule that a record breaks.

    Candidates (company_id, candidate_id, page, last_page, type, primary_evidence) and evidence (company_id, candidate_id, evidence_id, page, last_page, text): ids once, both ends in one range of the
    company, a primary evidence that exists, a text. Candidates of a type that a negative disclosure (company_id, type, page, last_page) round their first page
    denies. Shareholders' evidence (company_id, evidence_id, page, last_page) inside its own ranges. Ranges: company_id, start_page, end_page."""

    def outside(df: DataFrame, key: str, spans: DataFrame, name: str) -> DataFrame:
        r = spans.select(F.col("company_id").alias("_c"), "start_page", "end_page")
        inside = (df["company_id"] == r["_c"]) & (df["page"] >= r["start_page"]) & (df["last_page"] >= df["page"]) & (df["last_page"] <= r["end_page"])
        return df.join(r, inside, "left_anti").select(F.col(key).alias("record_id"), F.lit(name).alias("problem"))

    def repeated(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("record_id")).count().where("count > 1").select("record_id", F.lit(name).alias("problem"))

    lost = candidates.join(evidence.select(F.col("evidence_id").alias("primary_evidence")), "primary_evidence", "left_anti")
    parts = [
        repeated(candidates, "candidate_id", "duplicate_id"), repeated(evidence, "evidence_id", "duplicate_evidence_id"), outside(candidates, "candidate_id", ranges, "outside_ranges"), outside(evidence, "evidence_id", ranges, "evidence_outside_ranges"),
        lost.select(F.col("candidate_id").alias("record_id"), F.lit("no_primary_evidence").alias("problem")),
        evidence.where(F.length(F.btrim("text")) == 0).select(F.col("evidence_id").alias("record_id"), F.lit("empty_evidence").alias("problem")),
    ]
    if negatives is not None:
        n = negatives.select(F.col("company_id").alias("_c"), F.col("type").alias("_t"), F.col("page").alias("_a"), F.col("last_page").alias("_z"))
        types = n.select("_c", "_t").distinct()
        denied = candidates.join(types, (F.col("company_id") == F.col("_c")) & (F.col("type") == F.col("_t")), "left_semi")
        spans = n.select("_c", "_a", "_z")
        denied = denied.join(spans, (F.col("company_id") == F.col("_c")) & F.col("page").between(F.col("_a"), F.col("_z")), "left_semi")
        parts.append(denied.select(F.col("candidate_id").alias("record_id"), F.lit("overlaps_negative").alias("problem")))
    if holders is not None:
        parts.append(outside(holders, "evidence_id", holder_ranges, "holder_outside_ranges"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def patch_problems(patches: DataFrame) -> DataFrame:
    """H1, H2: rows of the range patch that lack a field, have an empty or reversed range, or repeat a chapter."""
    rules = F.array_compact(F.array(
        F.when(F.col("company_id").isNull() | F.col("chapter_type").isNull(), "missing_field"), F.when(F.coalesce(F.col("start_page"), F.lit(0)) <= 0, "start_not_positive"), F.when(F.col("end_page") < F.col("start_page"), "end_before_start"),
    ))
    own = patches.select("patch_id", F.explode(rules).alias("problem"))
    dup = patches.groupBy("company_id", "chapter_type").agg(F.min("patch_id").alias("patch_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("patch_id", F.lit("duplicate_chapter").alias("problem"))
    return own.unionByName(dup)
