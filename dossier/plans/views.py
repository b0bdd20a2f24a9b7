"""Filing-shaped inputs derived from the driver's tables by one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dossier.sources.stages import Stages, workspace

# A financing paragraph for each line of an order; every seventh does not add up.
EVIDENCE = """
select lpad(cast(o.o_custkey % 500 as string), 6, '0') as company_id, cast(l.l_orderkey as bigint) as event_id, cast(row_number() over (partition by l.l_orderkey order by l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_quantity) as int) as evidence_id,
  concat(cast(year(o.o_orderdate) as string), '年', cast(month(o.o_orderdate) as string), '月', cast(day(o.o_orderdate) as string), '日，公司召开股东会并作出增资决议，注册资本由 ',
    cast(cast(floor(l.l_extendedprice) as bigint) as string), '万元增加至',
    cast(cast(floor(l.l_extendedprice) as bigint) + cast(floor(l.l_quantity) as bigint) + case when l.l_linenumber = 7 then 50 else 0 end as string), '万元，新增注册资本',
    cast(cast(floor(l.l_quantity) as bigint) as string), '万元。第', cast(l.l_suppkey % 97 as string), '号投资有限公司认购，发行数量', cast(cast(floor(l.l_quantity) as bigint) as string), '万股，每股',
    cast(1 + l.l_partkey % 9 as string), '元，认购价款', cast(cast(floor(l.l_quantity) as bigint) * (1 + l.l_partkey % 9) as string), '万元，占比', cast(cast(floor(l.l_quantity) as bigint) * 3 as string),
    '%。', cast(year(l.l_shipdate) as string), '年', cast(month(l.l_shipdate) as string), '月', cast(day(l.l_shipdate) as string), '日完成工商变更登记手续。',
    case when l.l_returnflag = 'R' then '张三将其持有的公司股权转让给测试投资有限公司。' else '' end) as evidence_text
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
"""

# Pages: a source is a company, its documents in id order are its pages.
PAGES = "select source as company_id, cast(row_number() over (partition by source order by doc_id) as int) as pdf_page, doc_id, text from {documents}"

# Dated events of users, as a company's events in page order.
EVENTS = """
select lpad(cast(user_id % 1000 as string), 6, '0') as company_id, event_id, cast(event_id % 400 as int) as page, event_type,
  concat(cast(year(ts) as string), '-', lpad(cast(month(ts) as string), 2, '0'), case when event_id % 3 = 0 then '' else concat('-', lpad(cast(day(ts) as string), 2, '0')) end) as event_date
from {events}
"""


def tables(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables(sql)})


def plain(sql: str) -> str:
    """The text for a database where the tables are views."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's table over one data set, written by the first query of a session that needs it and read by the others."""
    key = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    return Stages(spark, f"{workspace(spark)}/stages-{spark.sparkContext.applicationId}-{key}").ensure(name, build)
