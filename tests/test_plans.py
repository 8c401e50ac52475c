"""Plans: what reaches the scan, what is broadcast, and what is never there."""

import re

import __spark_entry__ as registry
from eventlake.operators import security
from eventlake.plans import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_the_columns_they_need(spark):
    text = plan(registry.queries()["topic_offsets"](spark, SMALL))
    assert set(re.findall(r"ReadSchema: (\S+)", text)) == {"struct<event_id:bigint,user_id:bigint>"}


def test_incidents_have_one_plan_for_every_size(spark):
    events = fx.security(spark, SMALL)
    shapes = set()
    for rows in (events, events.limit(50)):
        text = plan(security.bruteforce_incidents(rows, blocks=20))
        shapes.add((len(re.findall(r"[-+] Window \[", text)), "CartesianProduct" in text))
    assert len(shapes) == 1 and not shapes.pop()[1]


def test_json_is_parsed_for_the_needed_fields(spark):
    for name, absent in (("usage_rollup", "username"), ("billing_cost", "usage_type")):
        text = registry.queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        schemas = re.findall(r"from_json\(((?:StructField\([^)]*\),? ?)+)", text)
        assert schemas and not any(f"StructField({absent}," in schema for schema in schemas)


def test_states_gather_no_lists(spark):
    for name in ("pipeline_state", "pipeline_summary", "pipeline_recent", "status_search"):
        assert "collect_list" not in plan(registry.queries()[name](spark, SMALL))


def test_usage_totals_combine_before_the_shuffle(spark):
    text = plan(registry.queries()["usage_rollup"](spark, SMALL))
    assert "partial_sum" in text and "partial_count" in text
