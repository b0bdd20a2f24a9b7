"""Investors and investment paths (inventory K1-K16), review ledger (H1-H9) and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.text import any_of, let, squash
from dossier.sources.tables import flat_columns

# Words of table headers and of firms that never invest.
NOISE = ["序号", "发行对象名称", "认购对象名称", "股东名称", "投资者名称", "数量（股", "数量(股", "金额（元", "金额(元", "认购数量", "认购金额", "新增股本", "新增股本的", "包括优先", "每股价格", "50元的价格", "合计", "比例", "持股数量", "名称"]
NOT_INVESTORS = ["会计师事务所", "律师事务所", "资产评估事务所", "资产评估有限公司", "市场监督管理局", "工商行政管理局", "证券登记结算", "银行"]
NAME_PREFIXES = ["发行对象名称", "认购对象名称", "股东名称", "投资者名称", "发行对象", "认购对象", "受让方", "投资者", "股东"]
# Words of funds, of investment firms, and endings of legal names.
STRONG = ["股权投资基金", "创业投资基金", "私募投资基金", "私募基金", "产业投资基金", "并购基金", "投资基金", "创业投资"]
MEDIUM = ["股权投资", "创业投资", "创投", "投资管理", "资产管理", "资本管理", "投资合伙"]
LEGAL = ["合伙企业（有限合伙）", "合伙企业(有限合伙)", "有限合伙企业", "股份有限公司", "有限责任公司", "有限公司", "有限合伙", "投资基金", "基金"]
# Endings cut from a name for its key and for its core; cities cut in front of a core.
KEY_ENDINGS = ["股份有限公司", "有限责任公司", "有限公司", "合伙企业（有限合伙）", "合伙企业(有限合伙)", "有限合伙企业", "有限合伙", "投资基金", "基金"]
CORE_ENDINGS = ["股份有限公司", "有限责任公司", "有限公司", "股份公司", "集团公司", "公司", "股份"]
CITIES = ["安徽", "江苏", "浙江", "上海", "北京", "深圳", "广州", "芜湖", "黄山", "昆山", "苏州", "无锡", "常州", "杭州", "南京", "共青城"]
# What opens a list of names, what is cut in front of one of them, and what ends it.
LIST_OPENERS = ["前公司股东", "原公司股东", "公司股东", "原股东", "现有股东", "股东包括", "股东为", "投资者包括", "投资者为", "发行对象包括", "认购对象包括"]
PART_PREFIXES = ["前公司股东", "原公司股东", "公司股东", "原股东", "股东", "投资者", "发行对象", "认购对象"]
PART_TAILS = ["参与本次增资", "参与增资", "参与认购", "认购本次发行", "认购", "增资入股", "受让股权", "受让股份", "参与本次交易", "参与交易", "持有公司股权", "持有公司股份"]
PART_ENDINGS = ["合伙企业（有限合伙）", "合伙企业(有限合伙)", "有限合伙企业", "股份有限公司", "有限责任公司", "有限公司", "有限合伙", "股权投资基金", "创业投资基金", "私募投资基金", "私募基金", "产业投资基金", "并购基金", "投资基金", "基金", "创业投资", "股权投资", "投资管理", "资产管理", "资本管理"]
# Words that make a sentence speak of investors, by kind of transaction; marks before a name; lists inside a sentence.
INCREASE_WORDS = ["认购", "增资", "发行对象", "认购对象", "新增股东", "投资者", "股东"]
TRANSFER_WORDS = ["转让给", "受让", "受让方", "股权转让", "股东"]
ROLE_MARKS = ["发行对象名称", "认购对象名称", "投资者名称", "股东名称", "受让方为", "转让给", "转让予", "发行对象", "认购对象", "新增股东", "投资者", "受让方"]
AFTER_MARK = ["序号", "名称", "对象", "为", "由"]
LIST_SENTENCE = r"[、，,]|^(?:前公司股东|原公司股东|公司股东|现有股东|股东包括|股东为|投资者包括|发行对象包括|认购对象包括)"
WHOLE_LEGAL = ["合伙企业（有限合伙）", "合伙企业(有限合伙)", "有限合伙企业"]
PLAIN_LEGAL = ["股份有限公司", "有限责任公司", "有限公司", "有限合伙", "投资基金", "基金"]
KEYWORD_ENDINGS = ["股权投资基金", "创业投资基金", "私募投资基金", "私募基金", "产业投资基金", "并购基金", "投资基金", "基金", "创业投资", "股权投资", "投资管理", "资产管理", "资本管理"]
# Classes of a name (kind, status, confidence), entry methods and their confidence.
CLASSES = {
    "noise": ("INVALID_TEXT_FRAGMENT", "EXCLUDED_NOISE", 0.99), "strong": ("PRIVATE_EQUITY_OR_VENTURE_ENTITY", "PEVC_CANDIDATE", 0.93), "medium": ("INVESTMENT_ENTITY_UNRESOLVED", "POSSIBLE_PEVC", 0.75),
    "person": ("NATURAL_PERSON", "NOT_PEVC", 0.90), "legal": ("LEGAL_ENTITY_OR_STRATEGIC_INVESTOR", "NOT_PEVC_OR_UNRESOLVED_STRATEGIC", 0.78), "other": ("UNRESOLVED_NAME", "EXCLUDED_LOW_QUALITY", 0.35),
}
ENTRY_METHODS = {"CAPITAL_INCREASE": ("CAPITAL_INCREASE_ENTRY", 0.92), "DIRECTIONAL_FINANCING": ("CAPITAL_INCREASE_ENTRY", 0.92), "EQUITY_TRANSFER": ("TRANSFER_ENTRY", 0.88)}
PATH_TYPES = ["CAPITAL_INCREASE", "DIRECTIONAL_FINANCING", "EQUITY_TRANSFER"]
EXCLUDED = ["EXCLUDED_NOISE", "EXCLUDED_LOW_QUALITY"]
PEVC = ["PEVC_CANDIDATE", "POSSIBLE_PEVC"]
_EDGE = "，。；、:：\\[\\]【】"


def _trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{_EDGE}]+|[{_EDGE}]+$", "")


def investor_name(c: Column) -> Column:
    """K1: without white space and outer marks, each header prefix tested once in order."""
    v = _trimmed(squash(c))
    for p in NAME_PREFIXES:
        v = F.regexp_replace(v, "^" + p, "")
    return _trimmed(v)


def investor_key(c: Column) -> Column:
    return F.regexp_replace(investor_name(c), f"(?:{any_of(KEY_ENDINGS)})$", "")


def _noise(n: Column) -> Column:
    return ~F.length(n).between(2, 60) | n.rlike(any_of(NOISE)) | n.rlike(any_of(NOT_INVESTORS)) | n.rlike(r"^[\d.,，.%％元股万元亿元/（）()]+$") | ~n.rlike("[一-鿿A-Za-z]")


def _legal(n: Column) -> Column:
    return n.rlike(f"(?:{any_of(LEGAL)})$")


def _person(n: Column) -> Column:
    return n.rlike("^[一-鿿·]{2,4}$") & ~_noise(n)


def _fund(n: Column) -> Column:
    return n.rlike(any_of(STRONG) + "|基金$")


def is_noise(c: Column) -> Column:
    """K2."""
    return let(investor_name(c), _noise)


def is_legal(c: Column) -> Column:
    """K3."""
    return let(investor_name(c), _legal)


def is_person(c: Column) -> Column:
    """K3."""
    return let(investor_name(c), _person)


def is_fund(c: Column) -> Column:
    """K3: strong evidence in the name."""
    return let(investor_name(c), _fund)


def high_quality(c: Column) -> Column:
    """K3: a fragment that may stand for an investor."""
    return let(investor_name(c), lambda n: ~_noise(n) & (_legal(n) | _person(n) | n.rlike(any_of(STRONG + MEDIUM))))


def classify(c: Column) -> Column:
    """K6: struct(class, status, confidence), the first that fits."""
    s = lambda k: F.struct(*[F.lit(v).alias(n) for n, v in zip(("class", "status", "confidence"), CLASSES[k], strict=True)])
    return let(
        investor_name(c),
        lambda n: F.when(_noise(n), s("noise")).when(_fund(n), s("strong")).when(n.rlike(any_of(MEDIUM)), s("medium")).when(_person(n), s("person")).when(_legal(n), s("legal")).otherwise(s("other")),
    )


def company_core(c: Column) -> Column:
    """K4."""
    v = F.regexp_replace(investor_name(c), f"^(?:{any_of(CITIES)})", "")
    return F.regexp_replace(v, f"(?:{any_of(CORE_ENDINGS)})$", "")


def is_issuer(name: Column, alias: Column) -> Column:
    """K4: equal, of equal core, or with at most two characters round the alias's core."""
    cores = F.struct(company_core(name).alias("core"), company_core(alias).alias("own"))
    near = let(cores, lambda x: (x["core"] == x["own"]) | ((F.length(x["own"]) >= 3) & x["core"].contains(x["own"]) & (F.length(x["core"]) - F.length(x["own"]) <= 2)))
    return (investor_name(name) == investor_name(alias)) | near


def issuer_aliases(companies: DataFrame, name: str = "company_short_name") -> DataFrame:
    """K4: (company_id, alias): each short name and its core."""
    c = companies.select("company_id", F.explode(F.array(investor_name(F.col(name)), company_core(F.col(name)))).alias("alias"))
    return c.where("alias <> ''").distinct()


def split_names(c: Column) -> Column:
    """K5: the names of a list, each once: its opener goes, each part loses a prefix and what follows a verb, and ends at its first legal form."""
    opener, mark = f"^(?:{any_of(LIST_OPENERS)})", "[、，,；;]|以及|及|和"
    both = let(investor_name(c), lambda v: F.struct(v.rlike(opener).alias("opened"), F.regexp_replace(v, opener, "").alias("rest")))
    parts = let(both, lambda x: F.when(x["opened"] | x["rest"].rlike(mark), F.split(x["rest"], mark)).otherwise(F.array(x["rest"])))
    legal = f"([一-鿿A-Za-z0-9·（）()]{{2,60}}?(?:{any_of(PART_ENDINGS)}))"

    def one(x: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(investor_name(x), f"^(?:{any_of(PART_PREFIXES)})", ""), f"(?:{any_of(PART_TAILS)}).*$", "")
        return let(bare, lambda y: investor_name(F.when(F.regexp_extract(y, legal, 1) != "", F.regexp_extract(y, legal, 1)).otherwise(y)))

    return F.array_distinct(F.filter(F.transform(parts, one), lambda x: x != ""))


def collapse_contained(names: DataFrame, keys=("company_id", "event_id"), name: str = "name", order: str = "seq") -> DataFrame:
    """K8: names equal to or contained in a longer (or equal and earlier) one of the same event go."""
    a = names.withColumn("_n", F.length(name))
    b = a.select(*[F.col(k).alias("_" + k) for k in keys], F.col(name).alias("_name"), F.col(order).alias("_seq"), F.col("_n").alias("_len"))
    on = [a[k] == b["_" + k] for k in keys]
    longer = (b["_len"] > a["_n"]) | ((b["_len"] == a["_n"]) & (b["_seq"] < a[order]))
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return a.join(b, cond & b["_name"].contains(a[name]) & longer, "left_anti").drop("_n")


def evidence_texts(events: DataFrame, evidence: DataFrame, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """K7: each event's evidence texts, in order, a line feed before each."""
    e = evidence.join(events.select(*keys, "candidate_event_id"), "candidate_event_id")
    held = F.array_sort(F.collect_list(F.struct(order, F.coalesce("evidence_text", F.lit("")).alias("t"))))
    return e.groupBy(*keys).agg(F.array_join(F.transform(held, lambda x: F.concat(F.lit("\n"), x["t"])), "").alias("text"))


def legal_candidate(c: Column) -> Column:
    """K8: the name after the last mark of a role: a whole partnership's, else up to the first legal form, else all."""
    rest = F.regexp_replace(F.regexp_replace(investor_name(c), f"(?s)^.*(?:{any_of(ROLE_MARKS)})", ""), f"^(?:{any_of(AFTER_MARK)})+", "")
    whole = lambda v: F.regexp_extract(v, f"([一-鿿A-Za-z0-9·]{{2,60}}(?:{any_of(WHOLE_LEGAL)}))", 1)
    plain = lambda v: F.regexp_extract(v, f"([一-鿿A-Za-z0-9·]{{2,60}}?(?:{any_of(PLAIN_LEGAL)}))", 1)
    return let(rest, lambda v: investor_name(F.when(whole(v) != "", whole(v)).when(plain(v) != "", plain(v)).otherwise(v)))


def evidence_candidates(texts: DataFrame, aliases: DataFrame, keys=("company_id", "event_id", "transaction_id")) -> DataFrame:
    """K8: (keys, seq, name, source) from the sentences of an event's text that speak of investors.

    texts: keys, transaction_type, text. Sources: lists, role phrases, legal names and investment words; issuers, contained and repeated names go."""
    s = texts.select(*keys, "transaction_type", F.posexplode(F.split(F.coalesce("text", F.lit("")), "[\n\r。；;]")).alias("no", "raw")).withColumn("s", investor_name(F.col("raw")))
    words = F.when(F.col("transaction_type").isin("CAPITAL_INCREASE", "DIRECTIONAL_FINANCING"), F.col("s").rlike(any_of(INCREASE_WORDS))).otherwise(F.col("s").rlike(any_of(TRANSFER_WORDS)))
    s = s.where((F.col("s") != "") & (words | F.col("s").rlike(any_of(STRONG + MEDIUM))))
    named = lambda names, source: F.transform(names, lambda x: F.struct(x.alias("name"), F.lit(source).alias("source")))
    found = lambda pattern: F.regexp_extract_all(F.col("s"), F.lit(pattern), F.lit(1))
    lists = F.when(F.col("s").rlike(LIST_SENTENCE), split_names(F.col("s"))).otherwise(F.array().cast("array<string>"))
    legal = found(f"([一-鿿A-Za-z0-9·（）()]{{2,70}}?(?:{any_of(LEGAL)}))")
    words = found(f"([一-鿿A-Za-z0-9·]{{2,30}}?(?:{any_of(KEYWORD_ENDINGS)}))")
    short = lambda x: investor_name(F.regexp_replace(investor_name(x), f"^(?:{any_of(PART_PREFIXES)})", ""))
    every = F.concat(
        named(lists, "EVIDENCE_COMPOUND_LIST"), named(F.array(legal_candidate(F.col("s"))), "EVIDENCE_ROLE_PHRASE"),
        named(F.transform(legal, legal_candidate), "EVIDENCE_LEGAL_ENTITY"), named(F.transform(words, short), "EVIDENCE_INVESTMENT_KEYWORD"),
    )
    c = s.select(*keys, "no", F.posexplode(every).alias("at", "x")).select(*keys, "no", "at", "x.name", "x.source").where((F.col("name") != "") & high_quality(F.col("name")))
    c = c.join(aliases, (c["company_id"] == aliases["company_id"]) & is_issuer(c["name"], aliases["alias"]), "left_anti")
    first = c.groupBy(*keys, "name").agg(F.min(F.struct("no", "at", "source")).alias("m"))
    first = first.select(*keys, "name", "m.source", (F.col("m.no").cast("long") * (1 << 32) + F.col("m.at")).alias("seq"))
    return collapse_contained(first, keys)


def linked_candidates(transactions: DataFrame, parties: DataFrame, keys=("company_id", "event_id")) -> DataFrame:
    """Names of the parties of eligible transactions that may stand for investors, compound names split."""
    t = transactions.where(F.col("transaction_type").isin(PATH_TYPES)).select(*keys, "transaction_id", F.explode("party_ids").alias("party_id"))
    return t.join(parties, [*keys, "party_id"]).select(*keys, "transaction_id", F.explode(split_names(F.col("party_name"))).alias("name")).where(high_quality(F.col("name")))


def judged_candidates(candidates: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, discarded with their reason): the issuer itself, then noise and names of low quality."""
    own = candidates.select("company_id", "name").distinct().join(aliases, "company_id").where(is_issuer(F.col("name"), F.col("alias"))).select("company_id", "name", F.lit(True).alias("own")).distinct()
    c = candidates.join(own, ["company_id", "name"], "left").withColumn("status", classify(F.col("name"))["status"])
    reason = F.when(F.col("own"), "ISSUER_SELF_EXCLUDED").when(F.col("status").isin(EXCLUDED), F.col("status"))
    c = c.withColumn("reason", reason).drop("own", "status")
    return c.where("reason is null").drop("reason"), c.where("reason is not null")


def entities(candidates: DataFrame, order: str = "seq") -> DataFrame:
    """One entity for each (company, identity key); the first name and class win, transactions are collected."""
    c = candidates.withColumn("key", investor_key(F.col("name"))).withColumn("c", classify(F.col("name"))).where(~F.col("c.status").isin(EXCLUDED) & (F.col("key") != ""))
    first = F.min(F.struct(order, "name", "c.class", "c.status", "c.confidence"))
    return c.groupBy("company_id", "key").agg(*[first[x].alias(x) for x in ("name", "class", "status", "confidence")], F.array_sort(F.collect_set("transaction_id")).alias("transaction_ids"))


def missing_investors(transactions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Eligible transactions without an investor."""
    return transactions.where(F.col("transaction_type").isin(PATH_TYPES)).join(candidates.select("transaction_id").distinct(), "transaction_id", "left_anti")


def paths(ents: DataFrame, transactions: DataFrame) -> DataFrame:
    """One path for each (entity, transaction), with entry method and confidence."""
    e = ents.select("company_id", "key", "class", "confidence", F.explode("transaction_ids").alias("transaction_id"))
    pick = lambda i: F.create_map(*[F.lit(x) for k, v in ENTRY_METHODS.items() for x in (k, v[i])])[F.col("transaction_type")]
    t = transactions.select("transaction_id", "transaction_type").where(F.col("transaction_type").isin(PATH_TYPES))
    return e.join(t, "transaction_id").select("company_id", "key", "class", "transaction_id", pick(0).alias("entry_method"), F.least("confidence", pick(1)).alias("confidence"))


def pevc_only(ents: DataFrame, path_rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(investors that are or may be funds, other entities, paths of the former)."""
    own = ents.where(F.col("status").isin(PEVC))
    return own, ents.where(~F.col("status").isin(PEVC)), path_rows.join(own.select("company_id", "key"), ["company_id", "key"], "left_semi")


def path_problems(p: DataFrame, ents: DataFrame, aliases: DataFrame, evidence: DataFrame) -> DataFrame:
    """(company_id, key, problem) for each rule that an entity or path breaks.

    evidence: company_id, key, transaction_id of the paths that have evidence."""
    row = lambda df, problem: df.select("company_id", "key", F.lit(problem).alias("problem")).distinct()
    key = ["company_id", "key"]
    rules = [
        row(ents.groupBy(*key).count().where("count > 1"), "duplicate_entity"),
        row(ents.where(is_noise(F.col("name"))), "entity_is_noise"),
        row(ents.where((F.col("status") == "PEVC_CANDIDATE") & ~is_fund(F.col("name"))), "fund_without_strong_name"),
        row(ents.join(aliases, "company_id").where(is_issuer(F.col("name"), F.col("alias"))), "entity_is_issuer"),
        row(p.groupBy(*key, "transaction_id").count().where("count > 1"), "duplicate_path"),
        row(p.join(ents, key, "left_anti"), "entity_missing"),
        row(p.where(F.col("entry_method").isNull() | ~F.col("entry_method").isin(*[v[0] for v in ENTRY_METHODS.values()])), "method_unknown"),
        row(p.join(evidence, [*key, "transaction_id"], "left_anti"), "evidence_missing"),
    ]
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


# --- review ledger ------------------------------------------------------------------------------------------------------


def survivorship(df: DataFrame, keys: list[str], ranking: list[Column], id_col: str) -> tuple[DataFrame, DataFrame]:
    """H3: (the best row of each group by the ranking, the others with the id that replaces them)."""
    w = W.partitionBy(*keys).orderBy(*ranking, id_col)
    r = df.withColumn("_r", F.row_number().over(w)).withColumn("replaced_by", F.first(id_col).over(w))
    return r.where("_r = 1").drop("_r", "replaced_by"), r.where("_r > 1").drop("_r")


def ranking_inputs(candidates: DataFrame) -> DataFrame:
    """Candidates with what their ranking asks: period (of the first filled of two fields, years and months as hyphens, else the first candidate), title, whether a timeline
    recovery made them and whether they are a limited company's set-up. Columns that a table lacks count as null."""
    have = lambda name, kind: F.col(name) if name in candidates.columns else F.lit(None).cast(kind)
    filled = lambda c: F.when(c != "", c)
    said = F.coalesce(filled(have("event_period", "string")), filled(have("event_date_text", "string")))
    period = F.coalesce(F.regexp_replace(F.translate(said, "年月", "--"), "^-+|-+$", ""), F.get(F.coalesce(have("event_date_candidates", "array<string>"), F.array().cast("array<string>")), F.lit(0)), F.lit(""))
    signals = F.when(F.size(have("matched_signals", "array<string>")) > 0, have("matched_signals", "array<string>")).otherwise(F.coalesce(have("signals", "array<string>"), F.array().cast("array<string>")))
    recovery = F.lower(F.concat_ws(" ", signals)).contains("page_timeline_recovery") | F.lower(F.coalesce(have("source_kind", "string"), F.lit(""))).contains("page_timeline_recovery")
    kinds = F.coalesce(have("event_type_candidates", "array<string>"), F.array().cast("array<string>"))
    setup = F.coalesce(have("event_type_candidate", "string") == "LIMITED_COMPANY_ESTABLISHMENT", F.lit(False)) | F.array_contains(kinds, "LIMITED_COMPANY_ESTABLISHMENT")
    title = F.coalesce(filled(have("event_title", "string")), have("title", "string"), F.lit(""))
    return candidates.select("*", period.alias("rank_period"), title.alias("rank_title"), signals.alias("rank_signals"), recovery.alias("is_recovery"), setup.alias("is_limited_establishment"))


def patch_record(df: DataFrame, action: str) -> DataFrame:
    """H4: the rows with their state before the patch as JSON."""
    return df.select("*", F.lit(action).alias("action"), F.to_json(F.struct("*")).alias("before_value"))


def kept_evidence(evidence: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """H5."""
    return evidence.join(kept.select(key), key, "left_semi")


def expected_counts(df: DataFrame, expected: DataFrame, key: str = "company_id") -> DataFrame:
    """Counts against an expectation table, either side missing included."""
    have = df.groupBy(key).agg(F.count(F.lit(1)).alias("found"))
    j = have.join(expected, key, "full_outer").select(key, F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return j.withColumn("ok", F.col("found") == F.col("expected"))


def assert_metrics(metrics: DataFrame, condition: str) -> None:
    """H7: refuses where a row breaks the condition."""
    bad = metrics.where(f"not ({condition})").limit(5).collect()
    if bad:
        raise ValueError(f"upstream metrics fail {condition}: {bad}")


def apply_decisions(reviews: DataFrame, decisions: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """H8: (reviews with the status of their decision, decisions without a review)."""
    d = decisions.select(key, "decision")
    status = F.when(F.col("decision").isin("ACCEPT", "REVISE"), "CLOSED").when(F.col("decision") == "REJECT", "REJECTED").otherwise("OPEN")
    return reviews.join(d, key, "left").withColumn("review_status", status), d.join(reviews.select(key), key, "left_anti")


def normalized_reviews(**stages: DataFrame) -> DataFrame:
    """H9: review rows of several stages with their stage, PENDING unless they say otherwise."""
    out = None
    for stage, df in sorted(stages.items()):
        have = df if "review_status" in df.columns else df.withColumn("review_status", F.lit(None).cast("string"))
        one = have.select(F.lit(stage).alias("stage"), "company_id", F.coalesce("review_status", F.lit("PENDING")).alias("review_status"))
        out = one if out is None else out.unionByName(one)
    return out


# --- assembly and comparison --------------------------------------------------------------------------------------------


def packages(companies: DataFrame, **tables: DataFrame) -> DataFrame:
    """L1: a row for each company with its rows of every table nested; for companies of bounded size (else write_packages)."""
    out = companies.select("company_id").distinct()
    for name, df in sorted(tables.items()):
        out = out.join(df.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != "company_id"]))).alias(name)), "company_id", "left")
    return out


def combined_tables(columns: dict[str, list[str]], separator: str = ";", **tables: DataFrame) -> dict[str, DataFrame]:
    """L4: each table flat, under the columns listed for it."""
    return {name: flat_columns(df, columns[name], separator) for name, df in sorted(tables.items())}


def write_packages(root: str, **tables: DataFrame) -> None:
    """L1: a folder for each table, partitioned by company, so that no company is gathered into one value."""
    for name, df in sorted(tables.items()):
        df.write.mode("errorifexists").partitionBy("company_id").json(f"{root}/{name}")


def snapshot_status(facts: DataFrame, companies: DataFrame) -> DataFrame:
    """L2: whether equity ratios allow a snapshot: only those linked to a party do."""
    g = facts.where("fact_type = 'EQUITY_RATIO'").groupBy("company_id").agg(F.count(F.lit(1)).alias("ratios"), F.count("party_id").alias("linked"))
    j = companies.select("company_id").distinct().join(g, "company_id", "left")
    return j.select("company_id", F.when(F.col("ratios").isNull(), "NO_RATIOS").when(F.col("linked") == 0, "RATIOS_WITHOUT_PARTY").otherwise("SNAPSHOT").alias("snapshot_status"))


def company_metrics(companies: DataFrame, **tables: DataFrame) -> DataFrame:
    """L3: rows of each table by company, zero where there is none."""
    out = companies.select("company_id").distinct()
    for name, df in sorted(tables.items()):
        out = out.join(df.groupBy("company_id").agg(F.count(F.lit(1)).alias(name)), "company_id", "left")
    return out.na.fill(0, sorted(tables))


def cross_check(auto: DataFrame, gold: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """For each key: in both, only one side, and the fields that differ."""
    a = auto.select(*keys, *[F.col(f).alias("a_" + f) for f in fields], F.lit(1).alias("in_a"))
    g = gold.select(*keys, *[F.col(f).alias("g_" + f) for f in fields], F.lit(1).alias("in_g"))
    j = a.join(g, keys, "full_outer")
    side = F.when(F.col("in_a").isNull(), "GOLD_ONLY").when(F.col("in_g").isNull(), "AUTO_ONLY").otherwise("COMMON")
    diff = F.array_compact(F.array(*[F.when((side == "COMMON") & ~F.col("a_" + f).eqNullSafe(F.col("g_" + f)), F.lit(f)) for f in fields]))
    return j.select(*keys, side.alias("side"), F.array_join(diff, ",").alias("differs"))


def check_contract(df: DataFrame, required=(), minimum=None, pattern=None, const=None) -> DataFrame:
    """One row for each rule and value that breaks it. The ids are the first column."""
    key = df.columns[0]
    rules = [F.when(F.col(c).isNull(), F.lit(f"required:{c}")) for c in required]
    rules += [F.when(F.col(c) < v, F.lit(f"minimum:{c}")) for c, v in (minimum or {}).items()]
    rules += [F.when(~F.col(c).rlike(v), F.lit(f"pattern:{c}")) for c, v in (pattern or {}).items()]
    rules += [F.when(F.col(c) != v, F.lit(f"const:{c}")) for c, v in (const or {}).items()]
    return df.select(F.col(key).alias("id"), F.explode(F.array_compact(F.array(*rules))).alias("rule"))


def duplicates(df: DataFrame, value: str, ids: str) -> DataFrame:
    """Values held by several rows, with their ids in order."""
    return df.groupBy(value).agg(F.array_sort(F.collect_set(ids)).alias("ids")).where(F.size("ids") > 1)


def batch_status(failed: Column, blocked: Column, review: Column) -> Column:
    """BLOCKED before PARTIAL_FAILURE before READY_WITH_REVIEW before READY."""
    return F.when(blocked > 0, "BLOCKED").when(failed > 0, "PARTIAL_FAILURE").when(review > 0, "READY_WITH_REVIEW").otherwise("READY")


def guard_rules(rules, forbidden=("target_pages", "correct_candidate", "expected_event", "known_investor", "answer_mapping", "fixed_page")) -> None:
    """Refuses rule documents with a key that maps answers, at any depth."""
    if isinstance(rules, dict):
        for k, v in rules.items():
            if any(f in str(k) for f in forbidden):
                raise ValueError(f"rule key {k} maps answers")
            guard_rules(v, forbidden)
    elif isinstance(rules, list):
        for v in rules:
            guard_rules(v, forbidden)
