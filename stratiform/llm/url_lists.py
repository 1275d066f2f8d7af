"""The rules of op5: host and path rules, and filter lines for the URLs that none of them fits."""

from __future__ import annotations

from stratiform.llm.url_rules import host_rule, parse_rules

HOST_RULES = [host_rule(name, verdict) for name, verdict in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))]

FILTERS = parse_rules(
    """
! advertising and tracking
||ads-track.
||adserver.
||doubleclick.
||tracker.
||pixel.^*.gif|
/adserv/
/banner-ads/
/click-tracking/
utm-redirect^
! gambling
||casino*/promo/
||casino*/bonus/
casino.*/promo/
casino.*/bonus/
free-bets.
||poker-online.
/slot-machine/
! medicines and loans
cheap-pills.
||viagra
||pharmacy-discount.
payday-loan
! adult
||porn
||xxx-
/adult-videos/
! downloads
/keygen/
.exe|
/crack-download^
! never these
@@||wikipedia.org^
@@||gambling-help.
@@/responsible-gambling/
"""
)

URL_RULES = [*HOST_RULES, *FILTERS]
