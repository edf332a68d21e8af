"""Plans: what must not be in them."""

import __spark_entry__ as entry
from lodeweave.plans import training
from lodeweave.tables import table

SMALL = "/root/testdata/sf0.001"


def _plan(spark, name):
    return entry.queries()[name](spark, SMALL)._jdf.queryExecution().toString()


def test_no_cartesian_products_and_pruned_scans(spark):
    for name in ("p2_found", "p4_found", "p5_found", "p6_found", "reaction_deltas", "trade_interval_stats", "entity_overlap_links", "longest_prefix_match", "identifier_conflicts"):
        plan = _plan(spark, name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    plan = _plan(spark, "p6_found").split("== Physical Plan ==")[1]
    assert "transaction_hash" not in plan and "proxy_wallet" not in plan
    facts = training.roster_facts(table(spark, SMALL, "entity_relationships"))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(predicate), EqualTo(predicate,rostered_by)" in facts and "evidence" not in facts.split("ReadSchema")[-1]
