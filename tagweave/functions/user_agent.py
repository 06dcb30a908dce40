"""User-agent text to operating system, device and browser.

Each output column has an ordered list of (pattern, value) rules; the first
pattern found in the text decides. Rules become native CASE expressions, so they
run inside generated code in batch and stream alike. Patterns stay in the subset
Java regular expressions and RE2 share.
"""

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

FALLBACK = "Other"

# Well-known product tokens of user-agent texts, most specific first.
OS_RULES = (
    ("Windows Phone", "Windows Phone"),
    ("Windows", "Windows"),
    ("iPhone|iPad|iPod", "iOS"),
    ("Android", "Android"),
    ("CrOS", "Chrome OS"),
    ("Mac OS X|Macintosh", "Mac OS X"),
    ("Ubuntu", "Ubuntu"),
    ("NetBSD", "NetBSD"),
    ("FreeBSD", "FreeBSD"),
    ("OpenBSD", "OpenBSD"),
    ("Linux", "Linux"),
)
DEVICE_RULES = (
    ("[Bb]ot[/; )]|[Ss]pider|[Cc]rawler", "Spider"),
    ("iPhone", "iPhone"),
    ("iPad", "iPad"),
    ("iPod", "iPod"),
    ("Macintosh", "Mac"),
    ("HUAWEI|Huawei", "Huawei"),
    ("Xiaomi|Redmi", "Xiaomi"),
    ("SAMSUNG|SM-[A-Z0-9]+", "Samsung"),
    ("Android", "Generic Android"),
)
BROWSER_RULES = (
    ("MicroMessenger", "WeChat"),
    ("Edge/|Edg/|EdgA/|EdgiOS/", "Edge"),
    ("OPR/|Opera", "Opera"),
    ("UCBrowser", "UC Browser"),
    ("FxiOS/|Firefox/", "Firefox"),
    ("CriOS/", "Chrome Mobile iOS"),
    ("Chromium/", "Chromium"),
    ("Android.*Chrome/", "Chrome Mobile"),
    ("Chrome/", "Chrome"),
    ("MSIE |Trident/", "IE"),
    ("(iPhone|iPad|iPod).*Safari/", "Mobile Safari"),
    ("Android.*Safari/", "Android"),
    ("Safari/", "Safari"),
    ("curl/", "curl"),
)


@dataclass(frozen=True)
class AgentRules:
    os: tuple = OS_RULES
    device: tuple = DEVICE_RULES
    browser: tuple = BROWSER_RULES
    fallback: str = FALLBACK


DEFAULT_RULES = AgentRules()


def first_match(text: Column, rules, fallback: str) -> Column:
    branches = [F.when(text.rlike(pattern), F.lit(value)) for pattern, value in rules]
    return F.coalesce(*branches, F.lit(fallback))


def agent_columns(agent: Column, rules: AgentRules = DEFAULT_RULES) -> list[Column]:
    """os, device and browser of one user-agent column."""
    return [
        first_match(agent, rules.os, rules.fallback).alias("os"),
        first_match(agent, rules.device, rules.fallback).alias("device"),
        first_match(agent, rules.browser, rules.fallback).alias("browser"),
    ]
