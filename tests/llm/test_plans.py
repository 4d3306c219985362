import re

import pytest

from riskloom.llm.queries import queries

SF = "/root/testdata/sf0.001"
NATIVE = [
    "op1_line_dedup",
    "op6_benchmark_decontamination",
    "op8_source_mixing",
    "op9_quality_rules",
    "op10_chat_format",
]


def plan_of(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "Cartesian" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op3_license_scan", "op4_toxicity", "op5_language_id", "op9_quality_rules"])
def test_scans_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(spark, name)


def test_mixing_moves_the_documents_once(spark):
    plan = plan_of(spark, "op8_source_mixing")
    by_bucket = re.findall(r"Exchange hashpartitioning\(no_source#\d+, source#\d+, bucket#\d+", plan)
    assert len(by_bucket) <= 3  # documents, bucket sums, and the offsets they give
