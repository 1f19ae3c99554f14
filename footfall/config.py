"""Site and rule configuration. Rule lists are data; none is inlined in the operators."""

from __future__ import annotations

import json
from dataclasses import dataclass


@dataclass(frozen=True)
class MallBranch:
    """One mall: a hit belongs to it if any of the four tests holds."""

    name: str
    hosts: tuple[str, ...]
    payment_tokens: tuple[str, ...]
    community_token: str
    shop_url: str


@dataclass(frozen=True)
class MallRules:
    payment_host: str
    community_host: str
    branches: tuple[MallBranch, ...]


@dataclass(frozen=True)
class TrafficConfig:
    main_site: str
    malls: MallRules
    site_list: tuple[str, ...] = ()
    sub_sites: tuple[str, ...] = ()

    @classmethod
    def from_json(cls, text: str) -> "TrafficConfig":
        """Read the shape that ``dataclasses.asdict`` writes."""
        raw = json.loads(text)
        malls = raw["malls"]
        branches = tuple(
            MallBranch(
                name=b["name"],
                hosts=tuple(b["hosts"]),
                payment_tokens=tuple(b["payment_tokens"]),
                community_token=b["community_token"],
                shop_url=b["shop_url"],
            )
            for b in malls["branches"]
        )
        return cls(
            main_site=raw["main_site"],
            site_list=tuple(raw.get("site_list", ())),
            sub_sites=tuple(raw.get("sub_sites", ())),
            malls=MallRules(malls["payment_host"], malls["community_host"], branches),
        )
