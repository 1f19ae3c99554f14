"""Predicates on raw lines and on parsed fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.config import MallBranch, MallRules, TrafficConfig
from footfall.functions.goods import has_goods_event
from footfall.operators.records import FIELD_SENTINELS, parse_records, with_fields

# -- raw lines --------------------------------------------------------------


def not_bot(line: Column) -> Column:
    return ~F.contains(F.lower(line), F.lit("spider"))


def raw_main_site(line: Column, site: str) -> Column:
    """The site parameter in the raw text, followed by another parameter."""
    return F.contains(line, F.lit(f"WS={site}&"))


def raw_tokens_absent(line: Column, tokens: Iterable[str] = ("AWS", "CLE")) -> Column:
    test = F.lit(True)
    for token in tokens:
        test = test & ~F.contains(line, F.lit(token))
    return test


def raw_activity(line: Column) -> Column:
    return F.contains(line, F.lit("activity"))


# -- parsed fields ----------------------------------------------------------


def _contains_any(text: Column, tokens: Iterable[str]) -> Column:
    test = F.lit(False)
    for token in tokens:
        test = test | F.contains(text, F.lit(token))
    return test


def in_mall(rules: MallRules, branch: MallBranch) -> Column:
    """One branch holds, on the columns ``ps`` and ``page_url``."""
    host = F.coalesce(F.col("ps"), F.lit(FIELD_SENTINELS["ps"]))
    url = F.col("page_url")
    return (
        host.isin(*branch.hosts)
        | ((host == rules.payment_host) & _contains_any(url, branch.payment_tokens))
        | ((host == rules.community_host) & F.contains(url, F.lit(branch.community_token)))
        | (F.lower(url) == branch.shop_url)
    )


def shop_flow(rules: MallRules) -> Column:
    test = F.lit(False)
    for branch in rules.branches:
        test = test | in_mall(rules, branch)
    return test


def classify_mall(df: DataFrame, rules: MallRules) -> DataFrame:
    """One row for each mall branch that a hit belongs to, in column ``mall``."""
    names = [F.when(in_mall(rules, b), F.lit(b.name)) for b in rules.branches]
    return df.select("*", F.explode(F.array_compact(F.array(*names))).alias("mall"))


def main_site(site: str) -> Column:
    return F.col("ws") == site


def site_list(sites: Iterable[str]) -> Column:
    return F.col("ws").isin(*sites)


def no_click_event() -> Column:
    return F.col("cle").isNull()


def activity_path() -> Column:
    return F.contains(F.col("page_url"), F.lit("/activity/"))


def activity_word() -> Column:
    return F.contains(F.col("page_url"), F.lit("activity"))


def campaign_title(title: str) -> Column:
    return F.col("title") == title


def goods_event() -> Column:
    return F.coalesce(has_goods_event(F.col("cle")), F.lit(False))


# -- the standard chains ----------------------------------------------------


def visible_records(lines: DataFrame) -> DataFrame:
    """Records of lines that are not from bots."""
    return parse_records(lines.filter(not_bot(F.col("line"))))


def main_site_hits(lines: DataFrame, config: TrafficConfig, *names: str) -> DataFrame:
    """Shop-flow page hits of the main site, with the extra fields ``names``.

    Cheap tests come first: raw text, then two short fields, and only then
    the decoded page URL. The metric fields are read from surviving rows.
    """
    site = F.contains(F.col("line"), F.lit(f"WS={config.main_site}"))
    records = with_fields(visible_records(lines.filter(site)), "ws", "cle")
    records = records.filter(main_site(config.main_site) & no_click_event())
    records = with_fields(records, "ps", "page_url").filter(shop_flow(config.malls))
    return with_fields(records, *names) if names else records


def raw_main_site_hits(lines: DataFrame, config: TrafficConfig, *names: str) -> DataFrame:
    """The older chain: site and click event are tested on the raw line."""
    line = F.col("line")
    lines = lines.filter(raw_main_site(line, config.main_site) & ~F.contains(line, F.lit("CLE")))
    records = with_fields(visible_records(lines), "ws", "ps", "page_url")
    records = records.filter(shop_flow(config.malls))
    return with_fields(records, *names) if names else records


def site_list_hits(lines: DataFrame, config: TrafficConfig, *names: str) -> DataFrame:
    """Hits of the listed sites, without the mall rules."""
    records = with_fields(visible_records(lines), "ws", "cle")
    records = records.filter(site_list(config.site_list) & no_click_event())
    return with_fields(records, *names) if names else records


def goods_hits(lines: DataFrame, config: TrafficConfig) -> DataFrame:
    """Main-site hits that carry a goods event."""
    event = F.contains(F.col("line"), F.lit("show::goodsstore::"))
    records = with_fields(visible_records(lines.filter(event)), "ws", "cle")
    records = records.filter(main_site(config.main_site) & goods_event())
    return with_fields(records, "ps", "page_url").filter(shop_flow(config.malls))
