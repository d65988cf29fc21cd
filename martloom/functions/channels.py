"""Which channel brought an order: one rule set per report, folded into a single CASE expression."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import utm


@dataclass(frozen=True)
class PaidRule:
    label: str
    sources: tuple[str, ...]
    mediums: tuple[str, ...]


@dataclass(frozen=True)
class RuleSet:
    paid: tuple[PaidRule, ...]
    referrers: tuple[tuple[str, str], ...]  # (text in the referrer, label)
    use_landing: bool = True  # read missing tags from the landing URL
    organic_uses_landing: bool = False  # do the untagged branches look at those as well?
    tells_unknown: bool = False  # no referrer, tag or landing page at all -> unknown


# ---- fixed values: labels, sources and mediums the reports are defined by ----
EMAIL = ("klaviyo", "email_klaviyo")

ROI_PAID = (
    PaidRule("google_paid", ("google",), ("cpc", "paid", "paidsearch", "ppc", "dg")),
    PaidRule("meta_paid", ("facebook", "instagram", "meta"), ("cpc", "paid")),
    PaidRule("yahoo_paid", ("yahoo",), ("cpc", "paid")),
    PaidRule("microsoft_paid", ("bing", "microsoft"), ("cpc", "paid")),
)
CUSTOMER_PAID = (
    PaidRule("google_paid", ("google",), ("cpc", "paid", "paidsearch", "ppc", "dg", "pmx")),
    PaidRule("meta_paid", ("facebook", "fb", "instagram", "ig", "meta", "ig.me"), ("cpc", "paid", "social", "organic_social")),
    PaidRule("yahoo_paid", ("yahoo",), ("cpc", "paid", "dsa")),
    PaidRule("microsoft_paid", ("bing", "microsoft"), ("cpc", "paid")),
)
BASIC_PAID = (
    PaidRule("google_paid", ("google",), ("cpc", "paid", "paidsearch", "ppc")),
    PaidRule("meta_paid", ("facebook", "instagram"), ("cpc", "paid")),
    PaidRule("yahoo_paid", ("yahoo",), ("cpc", "paid")),
    PaidRule("microsoft_paid", ("bing", "microsoft"), ("cpc", "paid")),
)
INSTAGRAM = ("instagram.com", "instagram_organic")
GOOGLE = ("google.com", "seo_google")
YAHOO = ("yahoo.co.jp", "seo_yahoo")
BING = ("bing.com", "seo_bing")
YOUTUBE = ("youtube.com", "social_youtube")
# ---- end of fixed values ----

RULE_SETS = {
    "roi": RuleSet(ROI_PAID, (INSTAGRAM, GOOGLE, YAHOO, YOUTUBE), organic_uses_landing=True),
    "profile": RuleSet(CUSTOMER_PAID, (INSTAGRAM, GOOGLE, YAHOO, BING, YOUTUBE)),
    "attribution": RuleSet(CUSTOMER_PAID, (INSTAGRAM, GOOGLE, YAHOO, BING, YOUTUBE), tells_unknown=True),
    "basic": RuleSet(BASIC_PAID, (INSTAGRAM, GOOGLE, YAHOO), use_landing=False),
}


def with_channel(df: DataFrame, variant: str, name: str = "channel") -> DataFrame:
    """Add the channel label from utm_source, utm_medium, landing_site and referring_site.

    The tags are read from the landing page once, in a projection of their own: inside the CASE every
    branch would run the pattern again.
    """
    rules = RULE_SETS[variant]
    pick = utm.resolved if rules.use_landing else F.col
    tagged = df.withColumns({"_source": pick("utm_source"), "_medium": pick("utm_medium")})
    return tagged.withColumn(name, _label(rules)).drop("_source", "_medium")


def _label(rules: RuleSet) -> Column:
    source, medium, referrer = F.col("_source"), F.col("_medium"), F.col("referring_site")
    prefix = "_" if rules.organic_uses_landing else "utm_"
    untagged_source, untagged_medium = F.col(f"{prefix}source").isNull(), F.col(f"{prefix}medium").isNull()

    cases = [(source == EMAIL[0], EMAIL[1])]
    cases += [(source.isin(*r.sources) & medium.isin(*r.mediums), r.label) for r in rules.paid]
    cases += [(referrer.contains(text) & untagged_medium, label) for text, label in rules.referrers]
    no_trace = referrer.isNull() & untagged_source
    if rules.tells_unknown:
        cases.append((no_trace & F.col("landing_site").isNull(), "unknown"))
    cases.append((no_trace, "direct"))

    first, *rest = cases
    chain = reduce(lambda c, case: c.when(case[0], F.lit(case[1])), rest, F.when(first[0], F.lit(first[1])))
    return chain.otherwise(F.lit("other"))
