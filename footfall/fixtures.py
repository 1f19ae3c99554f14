"""Hit lines, dimensions and small inputs derived from the given tables.

The texts are plain SQL that Spark and DuckDB both run, so the engine and its
oracle start from the same rows. Each text is a projection (no shuffle), so it
stays as scalable as the table below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import MallBranch, MallRules, TrafficConfig
from footfall.operators.records import evaluate_once

HITS_SQL = """
select event_id, arrival,
  f0 || '|_|u' || cast(u as string)
  || case when e % 223 = 0 then '' else
       '|_|' || replace(substr(cast(ts as string), 1, 19), ' ', 'T') || '+08:00'
       || '|_|http://log.example/t.gif'
       || case when e % 211 = 0 then '' else
            '?V=1'
            || case when e % 61 = 0 then '' else ws end
            || case when e % 8 in (0, 1) then '&PS=www.mall-a.example'
                    when e % 8 = 2 then '&PS=cart.mall-a.example'
                    when e % 8 = 3 then '&PS=www.mall-b.example'
                    when e % 8 = 4 then '&PS=pay.example'
                    when e % 8 = 5 then '&PS=community.example'
                    when e % 8 = 6 then '&PS=blog.example'
                    else '' end
            || '&PU=' || case when e % 97 = 0 then 'bad%zz'
                              when e % 2 = 1 then replace(pu, '%', '%25')
                              else pu end
            || case when e % 31 = 0 then '' else '&CUC=c' || cast(u as string) end
            || case when e % 17 = 0 then ''
                    when e % 4 = 0 then '&RC=0' else '&RC=1' end
            || case when e % 3 = 0 then '&UN=n' || cast(u % 40 as string)
                    when e % 3 = 1 then '&UN=' else '' end
            || '&TT=Big%2520Sale%2520' || cast(u % 6 as string)
            || case when u % 6 = 0 then '&SWSPID=pc_a'
                    when u % 6 = 1 then '&SWSPID=wap_a'
                    when u % 6 = 2 then '&SWSPID=pc_b'
                    when u % 6 = 3 then '&SWSPID=pc_c'
                    when u % 6 = 4 then '&SWSPID=other' else '' end
            || case when et = 'signup' then
                 '&CLE=||show::goodsstore::' || cast(1 + e % 200 as string)
                 || '::' || cast(e % 2 as string)
                 || '::' || case when e % 4 < 2 then 'wap' else 'pc' end || '||'
                 || case when e % 7 = 0
                         then 'x||show::goodsstore::' || cast(1 + e % 150 as string)
                              || '::1::pc||'
                         else '' end
                 else '' end
            || case when e % 41 = 0 then '&AWS=1' else '' end
            || case when e % 53 = 0 then '&RC=9' else '' end
            || case when e % 59 = 0 then '&PX=1=2' else '' end
            || case when e % 61 = 0 then ws else '' end
          end
     end as line
from (
  select e as event_id, e + (e * 7919) % 13 - 6 as arrival, e, u, et, ts,
    case when et = 'error' and e % 3 = 0 then 'BaiduSpider'
         else '10.0.0.' || cast(u % 250 as string) end as f0,
    case when e % 10 = 9 then '' when e % 10 = 8 then '&WS=10000008'
         when e % 10 = 7 then '&WS=10000071' else '&WS=10000001' end as ws,
    replace(replace(replace(replace(
      case when e % 5 = 4 then 'ShopId=' || cast(1 + e % 3 as string)
           else 'http://site.example'
             || case when e % 5 = 0 then '/activity/' || cast(u % 4 as string)
                     when e % 5 = 1 then '/item?plat=' || cast(e % 9 as string)
                     when e % 5 = 2 then '/think/list'
                     else '/b2cPc_url/brand' end
      end, ':', '%3A'), '/', '%2F'), '?', '%3F'), '=', '%3D') as pu
  from (select event_id as e, user_id as u, event_type as et, ts from events) ev
) enc
"""

GOODS_SQL = """
select p_name as goods_name,
       case when p_partkey % 3 = 0 then 'old-' else '' end || cast(p_partkey as string)
         as goods_business_cd,
       cast(p_size % 7 as int) as website_cd
from part
"""

WEBSITE_SQL = """
select cast(r_regionkey as int) as website_cd, r_name as website_name from region
"""

CLICKS_SQL = """
select 'u' || cast(user_id as string) || ' i' || cast(event_id % 17 as string)
       || ' ' || event_type as line, ts
from events
"""

PAIRS_SQL = """
select c_mktsegment as name, cast(c_nationkey as string) as second_name from customer
"""

CAMPAIGNS = (("Big Sale 0", "tt1"), ("Big Sale 1", "tt2"))

CAMPAIGNS_SQL = "select * from (values {}) as c(title, code)".format(
    ", ".join(f"('{title}', '{code}')" for title, code in CAMPAIGNS)
)

# Site numbers and payment tokens of the rule tables.
FIXTURE_CONFIG = TrafficConfig(
    main_site="10000001",
    site_list=("10000071", "10000008"),
    sub_sites=("pc_a", "wap_a", "pc_b", "pc_c"),
    malls=MallRules(
        payment_host="pay.example",
        community_host="community.example",
        branches=(
            MallBranch(
                name="main",
                hosts=("www.mall-a.example", "cart.mall-a.example"),
                payment_tokens=("plat=4", "b2cPc_url", "plat=1", "b2cWap_url", "plat=3"),
                community_token="brand",
                shop_url="shopid=1",
            ),
            MallBranch(
                name="second",
                hosts=("www.mall-b.example",),
                payment_tokens=("plat=5", "tkPc_url", "plat=8", "tkWap_url"),
                community_token="think",
                shop_url="shopid=2",
            ),
        ),
    ),
)


def _from_table(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(sql.replace(f"from {table}", "from {src}"), src=source)


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, arrival, line)`` hit lines, one per event."""
    rows = _from_table(spark, sf_dir, "events", HITS_SQL)
    line = rows.select("event_id", "arrival", F.col("line").alias("text"))
    return evaluate_once(line, F.col("text").alias("line")).drop("text")


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_table(spark, sf_dir, "part", GOODS_SQL)


def website(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_table(spark, sf_dir, "region", WEBSITE_SQL)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(line, ts)`` click lines; ``ts`` is a UTC instant so it can be windowed."""
    return _from_table(spark, sf_dir, "events", CLICKS_SQL).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_table(spark, sf_dir, "customer", PAIRS_SQL)


def campaigns(spark: SparkSession) -> DataFrame:
    return spark.sql(CAMPAIGNS_SQL)
