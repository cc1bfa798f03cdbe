"""Smaller API contracts: missing input, CLI flags, span sources, schemas."""

from __future__ import annotations

import pytest
from conftest import SAMPLE

from streakline import schemas
from streakline.__main__ import main as cli
from streakline.functions import parse_lines
from streakline.operators import span_table, split_valid, type_ordered, type_spans, type_summary
from streakline.sources import read_log_lines


def test_missing_input_fails_before_any_job(spark, tmp_dir):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_log_lines(spark, f"{tmp_dir}/nope.txt")


def test_cli_requires_only_the_flags_a_stage_uses(capsys):
    with pytest.raises(SystemExit):
        cli(["--stage", "save", "--stage_dir", "x"])
    assert "missing --output" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        cli(["--input", "x"])
    assert "missing --output --bad" in capsys.readouterr().err


def test_spans_from_ordered_rows_equal_spans_from_good_rows(spark):
    good, _ = split_valid(parse_lines(read_log_lines(spark, SAMPLE)))
    ordered = type_ordered(good, rows_per_bucket=4)
    assert sorted(type_spans(ordered).collect()) == sorted(type_spans(good).collect())
    assert sorted(type_summary(span_table(ordered)).collect()) == sorted(type_summary(span_table(good)).collect())


def _shape(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def test_report_schemas(spark):
    """Column names and types (nullability aside) equal the declared schemas."""
    good, bad = split_valid(parse_lines(read_log_lines(spark, SAMPLE, order="scan")))
    assert _shape(type_spans(good).schema) == _shape(schemas.SPANS)
    assert _shape(type_summary(span_table(good)).schema) == _shape(schemas.SUMMARY)
    assert _shape(bad.schema) == _shape(schemas.BAD)
    assert _shape(good.schema) == _shape(schemas.GOOD)
    assert _shape(type_ordered(good).schema) == _shape(schemas.ORDERED)


def test_spread_keeps_the_parse_filter_after_its_shuffle(spark):
    """A one-split input is spread over the cores; the validity filter must run after that shuffle."""
    from streakline.sources import spread

    lines = spark.createDataFrame([(f"2017-10-05 00:01:0{i % 10}@/m/slab/a/256/{i}/x", i) for i in range(50)],
                                  "value string, arrival_id long").coalesce(1)
    good, _ = split_valid(parse_lines(spread(lines, 4)))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobinPartitioning(4)" in plan
    # the filter sits above the observed shuffle, not inside the single pre-shuffle task
    assert plan.index("Filter") < plan.index("CollectMetrics") < plan.index("RoundRobinPartitioning")
    assert good.count() == 50
