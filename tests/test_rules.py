"""Every precondition is broken by some feed, and named by the feed that breaks it."""

from routeledger.catalog import rules
from routeledger.plans import feed_metrics as fm

DATA = "/root/testdata/sf0.001"


def test_every_rule_is_reached(spark):
    got = rules.feed_rules(spark, DATA).select("reason").distinct().collect()
    assert {r.reason for r in got} == set(fm.RULES)


def test_a_feed_is_refused_for_the_rule_it_breaks(spark):
    got = {r.feed_id: r for r in rules.feed_rules_verdict(spark, DATA).collect()}
    assert got["G0"].is_valid and len(got) == 40
    assert {k: got[f"G{k}"].reason for k in range(1, 38)} == dict(enumerate(fm.RULES, 1))
    assert got["G38"].reason.startswith("trips:") and got["G39"].reason == "calendar:invalid_date"
