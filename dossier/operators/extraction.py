"""Structured extraction from evidence texts (inventory rows I1-I16)."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dossier.functions.text import SPACE, UNITS, any_of, date_key, fixed, parse_number, squash

# Fact type, pattern with value and unit as its two groups, confidence; in order of precedence.
_MONEY = r"([\d,，.]+)(亿元|万元|元)"
NUMERIC = [
    ("REGISTERED_CAPITAL_BEFORE", r"注册资本(?:由|从)" + _MONEY, 0.94),
    ("REGISTERED_CAPITAL_AFTER", r"注册资本(?:由|从)[\d,，.]+(?:亿元|万元|元)(?:增加至|增至|增加为|变更为|变更至|变更|减少至|减至|减少为|至)" + _MONEY, 0.96),
    ("REGISTERED_CAPITAL", r"注册资本(?:为|：|:)?" + _MONEY, 0.88),
    ("CAPITAL_INCREASE_AMOUNT", r"(?:新增注册资本|增加注册资本|增资额(?:为)?|本次增资(?:金额)?(?:为)?)" + _MONEY, 0.92),
    ("CONSIDERATION", r"(?:转让价款|转让价格|交易对价|支付对价|受让价款|认购价款|出资额(?:为)?)" + _MONEY, 0.88),
    ("SHARE_QUANTITY", r"([\d,，.]+)(亿股|万股|股)", 0.82),
    ("SHARE_PRICE", r"(?:每股|发行价格(?:为)?|转让单价(?:为)?)([\d,，.]+)(元/股|元)", 0.91),
    ("EQUITY_RATIO", r"([\d.]+)(%)", 0.76),
    ("NET_ASSET_VALUE", r"(?:净资产|经审计净资产)(?:为|：|:)?" + _MONEY, 0.86),
    ("APPRAISED_VALUE", r"(?:评估值|评估净资产)(?:为|：|:)?" + _MONEY, 0.84),
]
# Role, pattern whose first group is the name, confidence.
_NAME = "[一-鿿A-Za-z0-9（）()·]"
PARTIES = [
    ("TRANSFEROR", f"({_NAME}{{2,35}}?)(?:将其持有的|将所持|转让其持有的)", 0.86),
    ("TRANSFEREE", f"(?:转让给|受让方为|转让予)({_NAME}{{2,35}}?)(?=，|。|；|持有|支付|受让|$)", 0.88),
    ("TRANSFEREE", f"({_NAME}{{2,35}}?)(?:受让|取得)(?:了)?[^。；]{{0,10}}?(?:公司)?(?:股权|股份)", 0.82),
    ("INVESTOR", f"({_NAME}{{2,35}}?)(?:认购|缴纳出资|增资入股)", 0.84),
    ("ABSORBED_ENTITY", f"(?:吸收合并(?!前|后|的|情况|程序|影响)|被吸收合并方(?:为)?|吸收合并对象为)({_NAME}{{2,30}}?)(?=，|。|；|注册资本|注销|被注销|后|$)", 0.92),
    ("FOUNDER_OR_CONTRIBUTOR", "由([一-鿿A-Za-z0-9（）()·、和及与]{2,80}?)(?:共同)?(?:出资|投资)设立", 0.90),
]
_DAY = r"((?:19|20)\d{2}年\d{1,2}月\d{1,2}日)"
# Role, pattern whose first group is the date.
DATES = [
    ("resolution_date", _DAY + "[^。；]{0,25}?(?:股东会|董事会|股东大会)[^。；]{0,15}?决议"),
    ("resolution_date", _DAY + "[^。；]{0,20}?审议通过"),
    ("agreement_date", _DAY + "[^。；]{0,25}?(?:签署|签订)[^。；]{0,20}?(?:协议|合同)"),
    ("payment_date", _DAY + "[^。；]{0,25}?(?:支付|缴纳|缴付|出资到位)"),
    ("verification_date", _DAY + "[^。；]{0,25}?(?:验资|审验|验资报告)"),
    ("registration_date", _DAY + "[^。；]{0,30}?(?:工商变更|工商登记|营业执照|登记手续)"),
    ("effective_date", _DAY + "[^。；]{0,20}?(?:完成|生效)"),
]
# Event type, its group, its transaction type.
EVENT_TYPES = [
    ("LIMITED_COMPANY_ESTABLISHMENT", "ESTABLISHMENT", "ESTABLISHMENT"),
    ("JOINT_STOCK_COMPANY_ESTABLISHMENT", "ESTABLISHMENT", "JOINT_STOCK_ESTABLISHMENT"),
    ("OVERALL_CHANGE", "REORGANIZATION", "OVERALL_CHANGE"),
    ("CAPITAL_INCREASE", "CAPITAL_CHANGE", "CAPITAL_INCREASE"),
    ("CAPITAL_REDUCTION", "CAPITAL_CHANGE", "CAPITAL_REDUCTION"),
    ("SHARE_CAPITAL_CHANGE", "CAPITAL_CHANGE", "SHARE_CAPITAL_CHANGE"),
    ("EQUITY_TRANSFER", "EQUITY_TRANSFER", "EQUITY_TRANSFER"),
    ("ABSORPTION_MERGER", "REORGANIZATION", "ABSORPTION_MERGER"),
    ("EQUITY_HOLDING_PROXY", "EQUITY_HOLDING_PROXY", "EQUITY_HOLDING_PROXY"),
    ("EQUITY_HOLDING_PROXY_RELEASE", "EQUITY_HOLDING_PROXY", "EQUITY_HOLDING_PROXY_RELEASE"),
    ("CONTROL_CHANGE", "CONTROL_CHANGE", "CONTROL_CHANGE"),
    ("MAJOR_ASSET_RESTRUCTURING", "REORGANIZATION", "MAJOR_ASSET_RESTRUCTURING"),
    ("LISTING_OR_DIRECTIONAL_FINANCING", "FINANCING", "DIRECTIONAL_FINANCING"),
]
# Words that no party name holds.
NOT_A_NAME = ["股权", "股份", "注册资本", "本次", "协议", "工商", "董事会", "股东会", "万元", "万股", "持股", "营业执照", "市场监督管理局", "工商登记", "基本情况", "法定程序", "财务状况", "资产负债", "对发行人", "吸收合并前", "吸收合并后", "换发"]


def event_ids(candidates: DataFrame) -> DataFrame:
    """event_id numbered within the company by page, then candidate id."""
    w = W.partitionBy("company_id").orderBy("pdf_page_start", "candidate_event_id")
    return candidates.withColumn("seq", F.row_number().over(w)).withColumn("event_id", F.format_string("EVT-%s-%05d", "company_id", "seq"))


def with_evidence(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """Candidates with each of their evidence rows."""
    return candidates.join(evidence.drop("company_id"), "candidate_event_id", "left")


def _flat(evidence: DataFrame, keys, order: str) -> DataFrame:
    """Evidence dealt by event with its text squashed once. The patterns are the costly step, so they run after the one shuffle that
    the first-of-an-event window and the per-event aggregates need anyway; its partition count is the session's and isn't merged."""
    n = int(evidence.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return evidence.select(*keys, order, "evidence_text").repartition(n, *keys).select(*keys, order, squash(F.col("evidence_text")).alias("_s"))


def _groups(i: int, pattern: str, *names: str):
    """A function from a match to the pattern's number, the match and its groups, taken from the short match and not from the
    text again; a look-ahead that closes a pattern holds at the end of the match by its `$`. No default arguments: they would be taken
    for the element's index."""
    return lambda m: F.struct(F.lit(i).alias("no"), m.alias("whole"), *[F.regexp_extract(m, pattern, k + 1).alias(n) for k, n in enumerate(names)])


_DIGITS, _RATIO = r"([\d,，.]+)", r"([\d.]+)"


def possessive(pattern: str) -> str:
    """The same matches of a number and its unit, without retries: no unit starts with a character of a number, so a shorter number can't fit where the whole
    one doesn't, and a number that opens a pattern is tried from its first character only."""
    for digits in (_DIGITS, _RATIO):
        once = digits.replace("+)", "++)")
        if pattern.startswith(digits):
            return f"(?<!{digits[1:-2]})" + once + pattern.removeprefix(digits)
        pattern = pattern.replace(digits, once)
    return pattern


def _first_numbers(table, n_keys: int):
    """For mapInArrow over (keys, order, text) sorted by them: (keys, order, at, no, raw_value, raw_unit) of each (type, raw value, unit) that an event's earlier texts and matches
    don't have; `at` counts a text's matches over the patterns in order. One pass: only an event's own triples are held, and no match is sorted. `\\d` and white space are Spark's."""
    patterns, kinds = [possessive(p) for _, p, _ in table], [x[0] for x in table]

    def run(batches):
        space, found = re.compile(f"[{SPACE}]+"), [(no, kinds[no], re.compile(p, re.ASCII)) for no, p in enumerate(patterns)]
        event, seen = None, set()
        for t in batches:
            rows, ats, nos, values, units = [], [], [], [], []
            ids = zip(*[t.column(k).to_pylist() for k in range(n_keys)], strict=True)
            for i, (of, text) in enumerate(zip(ids, t.column(n_keys + 1).to_pylist(), strict=True)):
                if of != event:
                    event, seen = of, set()
                if text is None:
                    continue
                text, at = space.sub("", text), 0
                for no, kind, p in found:
                    for value, unit in p.findall(text):
                        if (kind, value, unit) not in seen:
                            seen.add((kind, value, unit))
                            rows.append(i)
                            ats.append(at)
                            nos.append(no)
                            values.append(value)
                            units.append(unit)
                        at += 1
            keys = t.select(list(range(n_keys + 1))).take(pa.array(rows, pa.int64()))
            more = [pa.array(ats, pa.int32()), pa.array(nos, pa.int32()), pa.array(values, pa.string()), pa.array(units, pa.string())]
            yield pa.RecordBatch.from_arrays([*keys.columns, *more], names=[*keys.schema.names, "at", "no", "raw_value", "raw_unit"])

    return run


def _first_of(keys, *more: str):
    """A window's partitions with an event's last key first: rows are sorted by their first key's leading bytes, which the keys of companies share."""
    return W.partitionBy(*reversed(list(keys)), *more)


def unit_columns(unit: Column) -> tuple[Column, Column, Column]:
    """(currency, base unit, multiplier); an unknown unit is its own base with multiplier 1."""
    pick = lambda i: F.coalesce(*[F.when(unit == u[0], F.lit(u[i])) for u in UNITS])
    return pick(1), F.coalesce(pick(2), unit), F.coalesce(pick(3).cast("decimal(12,2)"), F.lit(1).cast("decimal(12,2)"))


def extract_numeric(evidence: DataFrame, table=NUMERIC, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """One row for each (type, raw value, unit) of an event, the first in evidence and pattern order."""
    types, conf = F.array(*[F.lit(x[0]) for x in table]), F.array(*[F.lit(x[2]) for x in table])
    # dealt by event and sorted by evidence, so that one pass finds, counts and drops what an event had before; the event's last key first, as the keys of companies share their leading bytes
    flat = evidence.select(*keys, order, "evidence_text").repartition(int(evidence.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    flat = flat.sortWithinPartitions(*reversed(list(keys)), order, "evidence_text")
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields[:-1])
    m = flat.mapInArrow(_first_numbers(table, len(keys)), f"{own}, at int, no int, raw_value string, raw_unit string")
    out = m.select(*keys, order, "at", types[F.col("no")].alias("fact_type"), "raw_value", "raw_unit", conf[F.col("no")].alias("confidence"))
    currency, base, times = unit_columns(F.col("raw_unit"))
    value = (parse_number(F.col("raw_value")) * times).cast("decimal(38,6)")
    return out.select(
        *keys, order, "at", "fact_type", "raw_value", "raw_unit", currency.alias("currency"), base.alias("base_unit"), value.alias("normalized_value"), "confidence",
        ((F.col("fact_type") == "EQUITY_RATIO") & (value > 1)).alias("review_required"),
    )


def first_numeric(evidence: DataFrame, kinds: list[str], table=NUMERIC, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """The first finite value of each kind for an event, as first_values() gives of extract_numeric(), straight from the texts: only the kinds' patterns
    run, a row keeps one value of each, and rows are aggregated before the shuffle, which carries no text and needs no sort."""

    def first(pattern: str) -> Column:
        def value(m: Column) -> Column:
            unit = F.regexp_extract(m, pattern, 2)
            return (parse_number(F.regexp_extract(m, pattern, 1)) * unit_columns(unit)[2]).cast("decimal(38,6)")

        return F.get(F.filter(F.transform(F.regexp_extract_all(F.col("_s"), F.lit(pattern), F.lit(0)), value), lambda x: x.isNotNull()), F.lit(0))

    patterns = {k: [possessive(p) for kind, p, _ in table if kind == k] for k in kinds}
    rows = evidence.select(*keys, order, squash(F.col("evidence_text")).alias("_s"))
    rows = rows.select(*keys, order, *[F.coalesce(*[first(p) for p in ps]).alias(k.lower()) for k, ps in patterns.items()])
    return rows.groupBy(*keys).agg(*[F.min(F.when(F.col(k.lower()).isNotNull(), F.struct(order, k.lower())))[k.lower()].alias(k.lower()) for k in kinds])


def party_name(c: Column) -> Column:
    """Without white space, leading connective, trailing verb and outer marks."""
    v = F.regexp_replace(squash(c), "^(?:由|与|和|及|其中|股东|公司|本公司|发行人)", "")
    v = F.regexp_replace(v, "(?:分别|共同|合计|持有|认购|受让|转让)$", "")
    return F.regexp_replace(v, "^[，。；、:：()（）]+|[，。；、:：()（）]+$", "")


def _key(n: Column) -> Column:
    return F.regexp_replace(n, "(?:股份有限公司|有限责任公司|有限公司|有限)$", "")


def party_key(c: Column) -> Column:
    return _key(party_name(c))


def _type(n: Column) -> Column:
    return (
        F.when(n.rlike("^[一-鿿]{2,4}$"), "NATURAL_PERSON")
        .when(n.rlike("有限公司|股份有限公司|有限合伙|合伙企业|投资基金|基金|集团|公司"), "LEGAL_ENTITY_OR_FUND")
        .otherwise("UNRESOLVED")
    )


def party_type(c: Column) -> Column:
    return _type(party_name(c))


def _plausible(n: Column) -> Column:
    return F.length(n).between(2, 45) & ~n.rlike(any_of(NOT_A_NAME)) & n.rlike("[一-鿿A-Za-z]")


def plausible_party(c: Column) -> Column:
    return _plausible(party_name(c))


def _name_matches(text: Column, pattern: str) -> Column:
    """All matches of a party pattern. One that opens with a name would try every start with every length: where only words of name characters follow, its matches lie
    in runs of such characters that hold one of the words, and only those runs are searched; where more follows, only texts with one of the words are."""
    opened = re.fullmatch(re.escape(f"({_NAME}{{2,35}}?)") + r"\(\?:([^()\[\]{}?*+.$^\\]+)\)(.*)", pattern)
    found = lambda s: F.regexp_extract_all(s, F.lit(pattern), F.lit(0))
    if not opened:
        return found(text)
    words, rest = opened.groups()
    if rest or not re.fullmatch(f"(?:{_NAME}|\\|)+", words):
        return F.when(text.rlike(words), found(text)).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(f"(?<!{_NAME}){_NAME}*?(?:{words}){_NAME}*+"), F.lit(0)), found))


def extract_parties(evidence: DataFrame, table=PARTIES, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """One row for each (role, identity key) of an event; founders' lists are split."""
    evidence, text = _flat(evidence, keys, order), F.col("_s")
    parts = []
    for i, (_, pattern, _) in enumerate(table):
        parts.append(F.transform(_name_matches(text, pattern), _groups(i, pattern, "name")))
    roles, conf = F.array(*[F.lit(x[0]) for x in table]), F.array(*[F.lit(x[2]) for x in table])
    m = evidence.select(*keys, order, F.posexplode(F.concat(*parts)).alias("at", "m"))
    m = m.select(*keys, order, "at", roles[F.col("m.no")].alias("party_role"), "m.whole", "m.name", conf[F.col("m.no")].alias("confidence"))
    excluded = ((F.col("party_role") == "TRANSFEREE") & F.col("whole").rlike("营业执照|市场监督管理局|换发|工商登记")) | (
        (F.col("party_role") == "ABSORBED_ENTITY") & F.col("whole").rlike("吸收合并(?:前|后|的影响|程序)")
    )
    names = F.when(F.col("party_role") == "FOUNDER_OR_CONTRIBUTOR", F.split("name", "[、，,；;和及与]")).otherwise(F.array("name"))
    m = m.where(~excluded).select("*", F.posexplode(names).alias("part", "raw")).drop("name")
    cut = F.when(F.col("party_role") == "ABSORBED_ENTITY", F.regexp_replace("raw", "(?:注册资本|基本情况|注销|财务|资产|负债|业务|影响|程序|股东|后).*$", "")).otherwise(F.col("raw"))
    # generators, as the filter would hold the name's expressions once for each of its mentions, in a method too long to be compiled
    m = fixed(fixed(m, party_name=party_name(cut)), _n=party_name(F.col("party_name"))).where(_plausible(F.col("_n")))
    m = fixed(m, identity_key=_key(F.col("_n")), party_type=_type(F.col("_n")))
    w = _first_of(keys, "party_role", "identity_key").orderBy(order, "at", "part")
    return m.withColumn("first", F.row_number().over(w)).where("first = 1").select(*keys, order, "at", "part", "party_role", "party_name", "identity_key", "party_type", "confidence")


def extract_dates(evidence: DataFrame, table=DATES, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """I8: one row for each (role, date) found in an event's evidence."""
    evidence, text = _flat(evidence, keys, order), F.col("_s")
    roles = F.array(*[F.lit(x[0]) for x in table])
    parts = [F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(0)), _groups(i, p, "date")) for i, (_, p) in enumerate(table)]
    m = evidence.select(*keys, order, F.posexplode(F.concat(*parts)).alias("at", "m")).select(*keys, order, "at", roles[F.col("m.no")].alias("date_role"), F.col("m.date").alias("date_text"))
    w = _first_of(keys, "date_role", "date_text").orderBy(order, "at")
    return m.withColumn("first", F.row_number().over(w)).where("first = 1").drop("first").withColumn("date_key", date_key(F.col("date_text")))


def date_facts(candidates: DataFrame, found: DataFrame, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """I8: the dates of an event from three origins: its candidate's roles, the candidate's period, and what extract_dates() found; each (role, date text) once, from
    the first origin that has it.

    candidates: keys, date_roles (map of role to dates), period. Adds source, confidence and source_evidence (null for the first two)."""
    keys = list(keys)
    roles = candidates.select(*keys, F.explode("date_roles").alias("date_role", "days")).select(*keys, "date_role", F.posexplode("days").alias("at", "date_text"))
    none = F.lit(None).cast(found.schema[order].dataType).alias("source_evidence")
    mine = roles.select(*keys, "date_role", "date_text", F.lit(1).alias("origin"), "at", none)
    period = candidates.where(F.coalesce("period", F.lit("")) != "").select(*keys, F.lit("event_period").alias("date_role"), F.col("period").alias("date_text"), F.lit(2).alias("origin"), F.lit(0).alias("at"), none)
    rest = found.select(*keys, "date_role", "date_text", F.lit(3).alias("origin"), "at", F.col(order).alias("source_evidence"))
    every = mine.unionByName(period).unionByName(rest)
    first = F.row_number().over(W.partitionBy(*keys, "date_role", "date_text").orderBy("origin", "source_evidence", "at"))
    every = every.withColumn("first", first).where("first = 1")
    source = F.when(F.col("origin") == 1, "CANDIDATE_DATE_ROLE").when(F.col("origin") == 2, "CANDIDATE_PRIMARY_DATE").otherwise("EVIDENCE_REGEX")
    sure = F.when(F.col("origin") == 1, 0.96).when(F.col("origin") == 2, 0.98).otherwise(0.88)
    return every.select(*keys, "date_role", "date_text", date_key(F.col("date_text")).alias("date_key"), source.alias("source"), "source_evidence", sure.alias("confidence"))


def with_providers(parties: DataFrame, candidates: DataFrame, evidence: DataFrame, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """Parties with the service providers that the event's candidate names, under its first evidence; a name once for each event.

    candidates: keys, providers (array). parties: what extract_parties() gives."""
    keys = list(keys)
    c = candidates.select(*keys, F.posexplode("providers").alias("part", "raw")).withColumn("party_name", party_name(F.col("raw"))).where(plausible_party(F.col("party_name")))
    first = evidence.groupBy(*keys).agg(F.min(order).alias(order))
    c = c.groupBy(*keys, "party_name").agg(F.min("part").alias("part")).join(first, keys, "left")
    more = c.select(*keys, order, F.lit(0).alias("at"), "part", F.lit("SERVICE_PROVIDER").alias("party_role"), "party_name", F.col("party_name").alias("identity_key"), F.lit("PROFESSIONAL_SERVICE_PROVIDER").alias("party_type"), F.lit(0.95).alias("confidence"))
    return parties.unionByName(more)


# Roles from which a transaction takes its date, best first.
DATE_PREFERENCE = ["registration_date", "effective_date", "resolution_date", "agreement_date", "event_period"]


def transaction_date(dates: DataFrame, keys=("company_id", "event_id"), order: str = "evidence_id") -> DataFrame:
    """The first date of the most preferred role."""
    rank = F.array_position(F.array(*[F.lit(x) for x in DATE_PREFERENCE]), F.col("date_role"))
    best = F.min(F.struct(rank.alias("rank"), F.col(order).alias("o"), "at", "date_key", "date_role")).alias("b")
    return dates.where(rank > 0).groupBy(*keys).agg(best).select(*keys, F.col("b.date_key").alias("transaction_date"), F.col("b.date_role").alias("date_basis"))


def ids_by(facts: DataFrame, kind: str, kinds: list[str], value: str, order: list[str], keys=("company_id", "event_id")) -> DataFrame:
    """A column of ordered values for each kind."""
    item = F.struct(*order, F.col(value).alias("_v"))
    out = facts.groupBy(*keys).agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col(kind) == k, item))), lambda x: x["_v"]).alias(k.lower()) for k in kinds])
    return out


def canonical_types(types: Column) -> Column:
    """An overall change covers the joint-stock set-up; a release covers the proxy."""
    t = F.when(F.array_contains(types, "OVERALL_CHANGE"), F.array_remove(types, "JOINT_STOCK_COMPANY_ESTABLISHMENT")).otherwise(types)
    return F.when(F.array_contains(t, "EQUITY_HOLDING_PROXY_RELEASE"), F.array_remove(t, "EQUITY_HOLDING_PROXY")).otherwise(t)


def _mapped(kind: Column, i: int, default: str | None = None) -> Column:
    m = F.create_map(*[F.lit(x) for row in EVENT_TYPES for x in (row[0], row[i])])
    return F.coalesce(m[kind], F.lit(default)) if default else m[kind]


def event_group(kind: Column) -> Column:
    """The group of an event type, OTHER for one unknown."""
    return _mapped(kind, 1, "OTHER")


def transactions(events: DataFrame, types: str = "event_types") -> DataFrame:
    """One row for each canonical type of an event, numbered within the event."""
    t = events.select("*", F.posexplode(canonical_types(F.col(types))).alias("seq", "event_type"))
    return t.withColumn("transaction_type", _mapped(F.col("event_type"), 2)).where("transaction_type is not null").withColumn("event_group", event_group(F.col("event_type")))


def completeness(kind: Column, have: dict[str, Column], confidence: Column | None = None) -> Column:
    """Reasons for review; have: whether the event has a fact type or role, by its name."""
    no = lambda *names: ~F.coalesce(*[have[n] for n in names[:1]], F.lit(False)) if len(names) == 1 else ~(_any([have[n] for n in names]))
    reasons = [
        F.when((kind == "EQUITY_TRANSFER") & no("TRANSFEROR"), "股权转让未抽取到转让方"),
        F.when((kind == "EQUITY_TRANSFER") & no("TRANSFEREE"), "股权转让未抽取到受让方"),
        F.when(kind.isin("CAPITAL_INCREASE", "DIRECTIONAL_FINANCING") & no("CAPITAL_INCREASE_AMOUNT", "REGISTERED_CAPITAL_AFTER", "SHARE_QUANTITY"), "增资或发行未抽取到金额、注册资本或股份数量"),
        F.when((kind == "ABSORPTION_MERGER") & no("ABSORBED_ENTITY"), "吸收合并未抽取到被吸收方"),
        F.when((kind == "OVERALL_CHANGE") & no("REGISTERED_CAPITAL", "SHARE_QUANTITY", "NET_ASSET_VALUE"), "整体变更未抽取到注册资本、折股数或净资产"),
        F.when((kind == "ESTABLISHMENT") & no("REGISTERED_CAPITAL", "FOUNDER_OR_CONTRIBUTOR"), "设立事件未抽取到注册资本或出资人"),
    ]
    if confidence is not None:
        reasons.append(F.when(F.coalesce(confidence, F.lit(0.0)) < 0.75, "源候选置信度低于0.75"))
    return F.array_compact(F.array(*reasons))


def _any(cols: list[Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(c, F.lit(False))
    return out


def orphans(facts: DataFrame, events: DataFrame, keys=("company_id", "event_id")) -> DataFrame:
    """Facts whose event is missing."""
    return facts.join(events.select(*keys).distinct(), list(keys), "left_anti")


# Transaction types of equity, whose parties play the roles below.
EQUITY_TYPES = ["EQUITY_TRANSFER", "EQUITY_HOLDING_PROXY_RELEASE"]
TRANSFER_ROLES = ["TRANSFEROR", "TRANSFEREE"]


def referential_problems(events: DataFrame, transactions: DataFrame, facts: DataFrame, parties: DataFrame, candidates: DataFrame, expected: int | None = None, keys=("company_id", "event_id")) -> DataFrame:
    """(company_id, event_id, problem, detail) for each broken reference: facts, parties and transactions without an event; transfer parties of an
    event without a transfer; an event of both an overall change and a joint-stock set-up; candidates without an event or with pages reversed; and, with
    an expected number of events, a row without ids if it is missed.

    events: keys, candidate_event_id, event_types, pdf_page_start, pdf_page_end. candidates: company_id, candidate_event_id."""
    keys = list(keys)
    row = lambda df, problem, detail=None: df.select(*keys, F.lit(problem).alias("problem"), (F.lit(None) if detail is None else F.col(detail)).cast("string").alias("detail"))
    transfers = transactions.where(F.col("transaction_type").isin(EQUITY_TYPES)).select(*keys)
    both = F.array_contains("event_types", "OVERALL_CHANGE") & F.array_contains("event_types", "JOINT_STOCK_COMPANY_ESTABLISHMENT")
    lost = candidates.join(events.select("candidate_event_id"), "candidate_event_id", "left_anti").withColumn(keys[-1], F.lit(None).cast(events.schema[keys[-1]].dataType))
    parts = [
        row(orphans(facts, events, keys), "fact_without_event", "fact_type"), row(orphans(parties, events, keys), "party_without_event", "party_role"),
        row(orphans(transactions, events, keys), "transaction_without_event", "transaction_type"),
        row(parties.where(F.col("party_role").isin(TRANSFER_ROLES)).join(transfers.distinct(), keys, "left_anti"), "transfer_party_without_transfer", "party_role"),
        row(events.where(both), "overall_change_and_joint_stock"), row(events.where(F.col("pdf_page_end") < F.col("pdf_page_start")), "pages_reversed"), row(lost, "candidate_without_event", "candidate_event_id"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if expected is not None:
        n = events.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != expected)
        out = out.unionByName(n.select(*[F.lit(None).cast(events.schema[k].dataType).alias(k) for k in keys], F.lit("event_count").alias("problem"), F.col("n").cast("string").alias("detail")))
    return out


def review_queue(**tables: DataFrame) -> DataFrame:
    """I16: rows that need review from several tables, with the kind of record they come from."""
    parts = [df.select(F.lit(kind).alias("record_type"), "company_id", "event_id", F.col("reason").alias("review_reason")) for kind, df in sorted(tables.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
