"""Rule documents: the event rules as values, and a reader for documents of the same form."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class EventRules:
    """Terms, patterns and limits by which units of text become event sections. A caller passes its own with `read_event_rules`."""

    priority: list[str] = field(default_factory=lambda: [
        "EQUITY_HOLDING_PROXY_RELEASE", "EQUITY_HOLDING_PROXY", "ABSORPTION_MERGER", "MAJOR_ASSET_RESTRUCTURING", "CONTROL_CHANGE", "OVERALL_CHANGE", "JOINT_STOCK_COMPANY_ESTABLISHMENT",
        "LIMITED_COMPANY_ESTABLISHMENT", "CAPITAL_REDUCTION", "CAPITAL_INCREASE", "EQUITY_TRANSFER", "SHARE_CAPITAL_CHANGE", "LISTING_OR_DIRECTIONAL_FINANCING",
    ])
    terms: dict[str, list[str]] = field(default_factory=lambda: {
        "LIMITED_COMPANY_ESTABLISHMENT": ["有限公司设立情况", "有限公司设立程序", "有限责任公司设立", "公司前身设立", "前身设立", "有限公司设立"],
        "JOINT_STOCK_COMPANY_ESTABLISHMENT": ["股份公司的设立情况", "股份有限公司的设立情况", "股份公司设立情况", "股份有限公司设立", "变更设立为股份有限公司", "发起设立股份有限公司"],
        "OVERALL_CHANGE": ["整体变更为股份有限公司", "整体变更设立为股份公司", "整体变更", "整体改制"],
        "CAPITAL_INCREASE": ["第一次增资", "第二次增资", "第三次增资", "增资至", "增资情况", "增资扩股", "增加注册资本", "新增注册资本", "增发股份", "增资"],
        "CAPITAL_REDUCTION": ["减少注册资本", "减资"],
        "EQUITY_TRANSFER": ["第一次股权转让", "第二次股权转让", "第三次股权转让", "股权转让协议", "股份转让协议", "股权转让", "股份转让", "转让其持有", "受让股权", "受让股份"],
        "SHARE_CAPITAL_CHANGE": ["资本公积转增股本", "第一次资本公积转增股本", "股本增加", "股本变更", "注册资本变更", "转增股本"],
        "ABSORPTION_MERGER": ["吸收合并", "被吸收合并"],
        "EQUITY_HOLDING_PROXY": ["历史沿革中存在股份代持", "历史沿革中存在股权代持", "股权代持", "股份代持", "代持情况"],
        "EQUITY_HOLDING_PROXY_RELEASE": ["股权代持已解除", "代持解除", "解除股权代持", "解除股份代持"],
        "CONTROL_CHANGE": ["报告期内控制权变动情况", "控制权变动", "实际控制人变更", "控股股东变更"],
        "MAJOR_ASSET_RESTRUCTURING": ["报告期内重大资产重组情况", "重大资产重组"],
        "LISTING_OR_DIRECTIONAL_FINANCING": ["报告期内发行融资情况", "股票定向发行", "定向发行", "发行融资", "股票发行"],
    })
    patterns: dict[str, list[str]] = field(default_factory=lambda: {
        "LIMITED_COMPANY_ESTABLISHMENT": [
            r"(?:公司前身|发行人前身|本公司前身|前身)[一-鿿A-Za-z0-9（）()]{2,30}(?:有限责任公司|有限公司|有限)的?设立情况",
            r"(?:(?:19|20)\d{2}年(?:\d{1,2}月)?[,，]?)?[一-鿿A-Za-z0-9（）()]{2,24}(?:有限责任公司|有限公司|有限)(?:成立|设立)",
            r"(?:公司|发行人|本公司)?前身[一-鿿A-Za-z0-9（）()]{2,30}(?:有限责任公司|有限公司|有限)的?设立情况",
            r"(?<!股份)(?:有限责任公司|有限公司)的?设立情况",
        ],
        "JOINT_STOCK_COMPANY_ESTABLISHMENT": ["股份有限公司的?设立情况", "股份公司的?设立情况"],
    })
    suppressed: dict[str, list[str]] = field(default_factory=lambda: {
        "LIMITED_COMPANY_ESTABLISHMENT": ["JOINT_STOCK_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE"], "JOINT_STOCK_COMPANY_ESTABLISHMENT": ["OVERALL_CHANGE"],
        "EQUITY_HOLDING_PROXY": ["EQUITY_HOLDING_PROXY_RELEASE"], "SHARE_CAPITAL_CHANGE": ["OVERALL_CHANGE"],
    })
    venues: list[str] = field(default_factory=lambda: ["全国中小企业股份转让系统", "全国股转系统", "股份转让系统挂牌", "公开转让的公告", "挂牌并公开转让"])
    combined: list[str] = field(default_factory=lambda: ["股权转让和增资", "股权转让及增资", "同时增资", "并增资"])
    heading_suffixes: list[str] = field(default_factory=lambda: ["设立情况", "股权转让", "增资", "减资", "整体变更", "吸收合并情况", "资本公积转增股本", "发行融资情况", "控制权变动情况", "重大资产重组情况"])
    generic_summary: list[str] = field(default_factory=lambda: [
        "公司设立及报告期内的股本和股东变化情况", "发行人设立及报告期内股本演变情况", "报告期内的股本和股东变化情况", "公司设立及报告期内股本、股东变化情况和成立以来重要事件", "发行人报告期内的股本演变情况",
    ])
    background: list[str] = field(default_factory=lambda: ["吸收合并前", "具体内容及履行的法定程序", "对发行人的影响", "评估值调整", "审验情况", "验资情况", "基本情况"])
    negative: list[str] = field(default_factory=lambda: ["未发生.*重大资产重组", "不存在.*重大资产重组", "未发生.*控制权变动", "未发生变动", "不存在.*控制权变动", "不涉及.*重大资产重组"])
    providers: list[str] = field(default_factory=lambda: ["会计师事务所", "资产评估有限公司", "资产评估事务所", "律师事务所", "审计机构", "评估机构", "验资机构"])
    provider_actions: list[str] = field(default_factory=lambda: ["出具", "审验", "评估", "验资", "审计", "复核"])
    provider_support: list[str] = field(default_factory=lambda: ["本次整体变更", "对本次整体变更", "本次增资", "本次股权转让", "本次股份转让", "本次吸收合并", "验资报告", "审验报告", "评估报告"])
    provider_reports: list[str] = field(default_factory=lambda: ["会计师事务所", "验资报告", "验字", "审验", "出具", "验资机构"])
    issuer_deals: list[str] = field(default_factory=lambda: ["召开股东会", "召开董事会", "注册资本由", "新增注册资本由", "股本由", "完成工商变更", "办理完毕工商变更"])
    timeline_rows: list[str] = field(default_factory=lambda: [r"^\d{1,2}(?:19|20)\d{2}年\d{1,2}月\d{1,2}日", r"^\d{1,2}(?:19|20)\d{2}年\d{1,2}月", r"^\d{1,2}(?:19|20)\d{2}年"])
    aggregate: list[str] = field(default_factory=lambda: [
        r"进行了[一二两三四五六七八九十\d]+次股权转让", r"进行了[一二两三四五六七八九十\d]+次股份转让", r"进行了[一二两三四五六七八九十\d]+次增资", r"历经[一二两三四五六七八九十\d]+次股权转让", "自设立至.*进行了.*股权转让", "自设立至.*进行了.*增资",
    ])
    references: list[str] = field(default_factory=lambda: ["参见.*(?:公开转让说明书|招股说明书|本节|本章)", "详见.*(?:公开转让说明书|招股说明书|本节|本章)", "具体见.*(?:公开转让说明书|招股说明书|本节|本章)", '之[“"].*之[“"]'])
    details: list[str] = field(default_factory=lambda: [r"\d+(?:\.\d+)?%", r"\d+(?:,\d{3})*(?:\.\d+)?万元", r"\d+(?:,\d{3})*(?:\.\d+)?万股", "召开股东会", "召开董事会", "签署.*协议", "完成工商变更", "办理完毕工商变更"])
    metadata_dates: list[str] = field(default_factory=lambda: [r"^整体变更设立日期(?:19|20)\d{2}年", r"^股份公司成立日期(?:19|20)\d{2}年", r"^股份有限公司成立日期(?:19|20)\d{2}年"])
    wrappers: list[str] = field(default_factory=lambda: ["发行人报告期内的重大资产重组情况", "报告期内重大资产重组情况", "发行融资情况", "报告期内发行融资情况"])
    date_roles: dict[str, list[str]] = field(default_factory=lambda: {
        "resolution_date": ["股东会", "董事会", "决议", "审议"], "agreement_date": ["签署", "签订", "协议", "合同"], "payment_date": ["缴款", "支付", "到账", "实缴", "出资到位"], "verification_date": ["验资", "审验", "验资报告"],
        "registration_date": ["工商变更", "变更登记", "核准", "市场监督管理局", "营业执照"], "announcement_date": ["公告", "发布"], "effective_date": ["实施完成", "完成本次", "办理完毕"],
    })
    categories: dict[str, list[str]] = field(default_factory=lambda: {
        "EQUITY_STRUCTURE": ["股权结构", "股本结构", "股东及持股情况"], "MAJOR_SHAREHOLDERS": ["持有发行人5%以上", "持股5%以上", "主要股东", "前十名股东"], "PRIVATE_FUND_SHAREHOLDERS": ["私募投资基金", "基金备案", "基金管理人", "备案编码"],
        "NEW_SHAREHOLDERS": ["新增股东", "提交申请前12个月", "申报前十二个月"], "ACTUAL_CONTROLLER": ["控股股东", "实际控制人", "共同实际控制人"], "SHAREHOLDING_TABLE": ["持股数量", "股份数量", "持股比例", "发行前", "发行后"],
    })
    subject_prefixes: list[str] = field(default_factory=lambda: [
        "同意", "审议通过", "经审议通过", "吸收合并后", "本次吸收合并后", "本次分配后", "本次增资后", "本次转让后", "转让后", "变更后", "完成后", "截至报告期末", "截至本招股说明书签署日", "公司前身", "发行人前身", "本公司前身", "前身",
    ])
    subject_suffixes: list[str] = field(default_factory=lambda: ["的", "之"])
    generic_subjects: list[str] = field(default_factory=lambda: ["公司", "发行人", "本公司", "股份公司", "有限公司", "有限责任公司", "股份有限公司"])
    business_suffixes: list[str] = field(default_factory=lambda: ["股份", "科技", "创新", "电机", "测控", "锻造", "新材", "材料", "智能", "电子", "信息", "装备", "机械", "医药", "生物", "能源", "公司"])
    legal_suffixes: list[str] = field(default_factory=lambda: ["有限责任公司", "有限公司", "有限"])
    subsidiaries: list[str] = field(default_factory=lambda: ["控股子公司", "全资子公司", "子公司", "孙公司", "下属公司"])
    relations: list[str] = field(default_factory=lambda: [
        "(?:公司|发行人|本公司)(?:系|是)?由([一-鿿A-Za-z0-9（）()]{2,30}?)(?:整体变更|变更设立)", "([一-鿿A-Za-z0-9（）()]{2,30}?)(?:系发行人前身|为发行人前身|作为发行人前身)",
        "发行人前身([一-鿿A-Za-z0-9（）()]{2,30}?)(?:于|成立|设立|整体变更)", "公司前身([一-鿿A-Za-z0-9（）()]{2,30}?)(?:于|成立|设立|整体变更)",
    ])
    counterparties: list[str] = field(default_factory=lambda: [
        "(?:发行人|公司|本公司)(?:拟)?吸收合并([一-鿿A-Za-z0-9（）()]{2,30}?)(?:，|。|；|后|并|的|情况)", "[一-鿿A-Za-z0-9（）()]{2,30}?(?:有限责任公司|有限公司|有限|股份公司)?吸收合并([一-鿿A-Za-z0-9（）()]{2,30}?)(?:，|。|；|注册资本|后|并|的|情况)",
        "吸收合并对象为([一-鿿A-Za-z0-9（）()]{2,30}?)(?:，|。|；)", "被吸收合并方(?:为)?([一-鿿A-Za-z0-9（）()]{2,30}?)(?:，|。|；)",
    ])
    subjects: list[str] = field(default_factory=lambda: [
        r"(?:^|[，。；])([一-鿿A-Za-z0-9（）()]{2,24}?)(?:(?:19|20)\d{2}年)?年度股东大会", "(?:^|[，。；])([一-鿿A-Za-z0-9（）()]{2,24}?)(?:股东大会|董事会)(?:审议|通过|决议)",
        "(?:^|[，。；])([一-鿿A-Za-z0-9（）()]{2,24}?)总股本(?:变更|增加|减少)", "(?:^|[，。；])([一-鿿A-Za-z0-9（）()]{2,24}?)注册资本(?:变更|增加|减少)",
        "(?:^|[，。；、])([一-鿿A-Za-z0-9（）()]{2,30}?(?:有限责任公司|有限公司|有限))(?:的)?(?:成立|设立情况|设立)",
    ])
    setup_rows: list[str] = field(default_factory=lambda: ["注册资本[^，。；]{0,40}?(?:，|,)?由[^，。；]{1,30}?出资设立", "由[^，。；]{1,30}?共同出资设立", "由[^，。；]{1,30}?投资设立"])
    openings: list[str] = field(default_factory=lambda: ["设立情况", "公司设立", "成立于", "取得营业执照", "工商设立登记", "工商注册登记"])
    equivalent: list[dict] = field(default_factory=lambda: [{"types": ["JOINT_STOCK_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE"], "canonical": "OVERALL_CHANGE", "gap": 3}])
    canonical_terms: dict[str, tuple[str, list[str]]] = field(default_factory=lambda: {
        "JOINT_STOCK_COMPANY_ESTABLISHMENT": ("OVERALL_CHANGE", ["整体变更", "变更为股份有限公司", "变更为股份公司", "净资产折股", "折合股本", "由有限公司变更为股份有限公司"]),
    })
    consequences: list[dict] = field(default_factory=lambda: [
        {"types": ["ABSORPTION_MERGER", "SHARE_CAPITAL_CHANGE"], "markers": ["吸收合并后", "本次吸收合并后"], "gap": 4}, {"types": ["OVERALL_CHANGE", "SHARE_CAPITAL_CHANGE"], "markers": ["整体变更后", "本次整体变更后"], "gap": 3},
        {"types": ["CAPITAL_INCREASE", "SHARE_CAPITAL_CHANGE"], "markers": ["增资后", "本次增资后"], "gap": 3},
    ])
    gaps: dict[str, int] = field(default_factory=lambda: {"period": 12, "untold": 2, "merger": 20, "timeline": 12, "provider": 3})
    title_similarity: float = 0.58


# The roles from which an event takes its date, best first, by type and for all others; types that take a role's earliest date and not its first; types that may lack one.
DATE_CHOICE: dict[str, list[str]] = {
    "LIMITED_COMPANY_ESTABLISHMENT": ["registration_date", "event_period", "resolution_date", "agreement_date", "verification_date", "other_date"],
    "JOINT_STOCK_COMPANY_ESTABLISHMENT": ["registration_date", "effective_date", "event_period", "resolution_date", "verification_date", "other_date"],
    "OVERALL_CHANGE": ["registration_date", "effective_date", "event_period", "resolution_date", "verification_date", "other_date"],
    "CAPITAL_INCREASE": ["event_period", "resolution_date", "agreement_date", "registration_date", "payment_date", "verification_date", "other_date"],
    "CAPITAL_REDUCTION": ["event_period", "resolution_date", "registration_date", "other_date"],
    "EQUITY_TRANSFER": ["event_period", "agreement_date", "resolution_date", "registration_date", "payment_date", "other_date"],
    "SHARE_CAPITAL_CHANGE": ["event_period", "resolution_date", "effective_date", "registration_date", "other_date"],
    "ABSORPTION_MERGER": ["event_period", "resolution_date", "registration_date", "effective_date", "agreement_date", "other_date"],
    "EQUITY_HOLDING_PROXY_RELEASE": ["event_period", "effective_date", "resolution_date", "other_date"],
    "LISTING_OR_DIRECTIONAL_FINANCING": ["event_period", "resolution_date", "announcement_date", "registration_date", "verification_date", "other_date"],
    "CONTROL_CHANGE": ["event_period", "effective_date", "resolution_date", "other_date"],
    "MAJOR_ASSET_RESTRUCTURING": ["event_period", "resolution_date", "registration_date", "other_date"],
}
DATE_ROLES = ["event_period", "resolution_date", "agreement_date", "registration_date", "effective_date", "verification_date", "payment_date", "announcement_date", "other_date"]
EARLIEST_DATE = ["LIMITED_COMPANY_ESTABLISHMENT", "JOINT_STOCK_COMPANY_ESTABLISHMENT", "OVERALL_CHANGE"]
UNDATED = ["EQUITY_HOLDING_PROXY"]
LOW_CONFIDENCE = 0.70


def read_event_rules(spark: SparkSession, path: str) -> EventRules:
    """The rules of a JSON document whose keys are the fields of EventRules; fields that it leaves out keep their values."""
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one document
    given = json.loads(text)
    known = {f.name for f in fields(EventRules)}
    odd = sorted(set(given) - known)
    if odd:
        raise ValueError(f"unknown rules: {odd}")
    return EventRules(**given)


EVENT_RULES = EventRules()


# The overview and the required chapter types with the words of their titles and texts. Further types come from a rule document, by
# `read_chapter_rules`.
CHAPTERS: dict[str, dict] = {
    "issuer_overview": {
        "aliases": ["发行人基本情况", "发行人概况", "公司基本情况", "发行人基本信息", "发行人基本情况概述"],
        "groups": [["发行人", "基本情况"], ["发行人", "概况"], ["公司", "基本情况"]],
        "anchors": ["基本情况", "概况", "基本信息"],
        "context": ["成立时间", "注册资本", "法定代表人", "注册地址"],
        "minimum": 2,
        "exclude": ["募集资金基本情况", "本次发行基本情况"],
        "broad": ["发行人基本情况", "公司基本情况"],
        "narrow": [],
    },
    "equity_history": {
        "aliases": ["公司设立以来股本演变情况", "公司设立及股本变化情况", "发行人历史沿革", "发行人的股本形成及其变化", "发行人的设立及历次股本变化", "发行人的设立及报告期内的股本和股东变化情况", "发行人的设立及股本变化情况", "发行人的设立情况、报告期内的股本和股东变化情况", "发行人的设立情况及股本演变", "发行人的设立情况报告期内的股本和股东变化情况", "发行人股本形成及变化", "发行人股本演变", "发行人设立以来的股本演变", "发行人设立以来股本变化情况", "发行人设立及历次股本变化", "发行人设立及报告期内股本演变情况", "发行人设立及股本演变情况", "设立以来的股本演变"],
        "groups": [["发行人", "设立", "股本"], ["公司", "设立", "股本"], ["股本", "形成", "变化"], ["股本", "演变"], ["历史", "沿革"], ["设立以来", "股本"], ["设立", "历次", "变化"], ["设立", "股本", "变化"], ["设立", "股东", "变化"], ["报告期内", "股本", "演变"]],
        "anchors": ["设立", "历史沿革", "股本", "股权演变", "股本形成", "注册资本"],
        "context": ["有限公司设立", "股份公司设立", "整体变更", "增资", "股权转让", "股份转让", "注册资本", "验资报告", "工商变更", "股本结构"],
        "minimum": 4,
        "exclude": ["专项说明", "代持情况", "募集资金", "发行人股本情况", "发行前后股本结构", "发行方案", "合法合规", "完全披露", "审核问询", "承诺", "本次发行前后的股本情况", "本次发行前后的股本结构", "本次发行前后股本结构", "本次发行后", "核查意见", "法律意见书", "股权代持", "补充法律意见", "重大违法", "问询回复"],
        "broad": ["发行人的设立及股本变化", "设立以来股本演变", "股本形成及变化", "发行人历史沿革", "公司历史沿革", "设立及历次股本变化", "设立及股本演变"],
        "narrow": ["概图", "报告期内", "代持", "核查", "说明", "合法合规"],
    },
    "shareholders": {
        "aliases": ["主要股东情况", "发行人主要股东情况", "发行人的股权结构", "发行人股东及实际控制人情况", "发行人股东情况", "发行人股本情况", "发行人股本结构", "发行前十名股东", "发行前本公司前十名股东", "发行前股东情况", "本次发行前公司前十名股东情况", "本次发行前后的股本情况", "本次发行前后的股本结构情况", "本次发行前后股本结构情况", "本次发行前的前十名股东", "股东基本情况"],
        "groups": [["发行人", "股东", "情况"], ["股东", "实际控制人", "情况"], ["主要", "股东"], ["发行前", "前十名", "股东"], ["本次发行前", "股东"], ["股权", "结构"], ["发行人", "股本", "情况"], ["本次发行前后", "股本", "结构"]],
        "anchors": ["股东", "股权结构", "股本结构", "实际控制人"],
        "context": ["持股数量", "持股比例", "股东名称", "前十名股东", "控股股东", "实际控制人", "发行前股本"],
        "minimum": 3,
        "exclude": ["不适格股东", "关联交易", "减持", "历史沿革", "合法合规", "同业竞争", "承诺", "报告期内的股本和股东变化", "新增股东", "社会公众股东", "股东变化", "股本变化", "股本和股东变化", "股本演变", "股权演变", "自然人股东及其担任", "设立以来", "重大违法", "锁定", "限售"],
        "broad": ["发行人股东及实际控制人情况", "发行人股东情况", "主要股东情况", "本次发行前公司前十名股东情况", "发行人的股权结构"],
        "narrow": ["新增股东", "自然人股东", "合法合规", "重大违法", "限售", "锁定", "减持", "承诺"],
    },
}
EVENT_HEADINGS = ["设立", "成立", "增资", "股权转让", "股份转让", "整体变更", "改制", "减资", "资本公积转增", "股本变更", "注册资本变更"]
REQUIRED_CHAPTERS = ["equity_history", "shareholders"]
# Bonuses and limits of the choice of chapters; rank of a source, best first.
CHOICE = {"sibling": 0.12, "cluster": 0.14, "toc": 0.06, "context": 0.08, "broad": 0.10, "narrow": 0.18, "late": 0.12, "single": 0.08, "section": 0.24, "pages": 45, "sibling_gap": 15, "cluster_gap": 10}
SOURCES = ["ISSUER_MASTER_SECTION", "HEADING_SECTION", "SIBLING_GROUP", "EVENT_CLUSTER", "EVENT_WINDOW"]


# How the issuer's own section is told, and the events and texts by which a range of pages is a history of equity.
MASTER = {"aliases": ["发行人基本情况", "公司基本情况", "发行人情况"], "scan": 24, "context": ["注册资本", "法定代表人", "成立时间", "发行人的设立", "股本", "股东"], "minimum": 2, "ahead": 3, "cap": 120}
WINDOW = {
    "categories": {
        "establishment": ["有限公司设立", "股份公司设立", "公司设立", "发起设立"], "capital_increase": ["增资", "增加注册资本", "新增注册资本"], "equity_transfer": ["股权转让", "股份转让", "受让股权"],
        "overall_change": ["整体变更", "整体改制", "变更为股份有限公司"], "capital_change": ["注册资本变更", "股本变更", "减资", "资本公积转增"],
    },
    "least_categories": 2, "least_dates": 2, "gap": 2, "before": 0, "after": 1, "cap": 20,
    "exclude": ["审核问询函回复", "审核问询回复", "补充法律意见书", "法律意见书", "核查意见", "专项说明"],
    "static": ["发行人股本情况", "本次发行前后的股本结构", "本次发行前后股本结构", "本次发行前后的股本情况", "发行前后股本结构"],
}
NOT_SHAREHOLDERS = ["股本和股东变化", "股东变化", "股本变化", "股本演变", "股权演变", "历史沿革", "设立以来"]


def read_chapter_rules(spark: SparkSession, path: str) -> dict[str, dict]:
    """Chapter types of a JSON document of the form of CHAPTERS; lists that a type leaves out are empty."""
    given = json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))  # one document
    blank = {"aliases": [], "groups": [], "anchors": [], "context": [], "minimum": 1, "exclude": [], "broad": [], "narrow": []}
    odd = sorted({k for v in given.values() for k in v} - set(blank))
    if odd:
        raise ValueError(f"unknown rules: {odd}")
    return {k: blank | v for k, v in given.items()}
