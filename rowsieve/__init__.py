"""Rule-driven data quality dataflows on Spark."""

from rowsieve.operators.aggregate import grouped_stats, merge_stats, partial_stats, row_count
from rowsieve.operators.enrich import add_processing_time, align
from rowsieve.operators.governance import (
    Mask,
    RowFilter,
    create_policy_functions,
    governed,
    publish_governed_view,
    publish_governed_views,
    publish_session_view,
    set_principal,
    use_namespace,
)
from rowsieve.operators.metrics import expectation_metrics, observe_rules, rejects_by_code
from rowsieve.operators.rules import Rule, RuleError, compile_rules, register_rule
from rowsieve.operators.split import Split, annotate, rejected_rows, split, valid_rows
from rowsieve.plans.contract import ContractError, Dataflow, load_contract, parse_contract
from rowsieve.plans.dataflow import RunReport, run
from rowsieve.plans.layers import Layer, quality_layers, refresh

__all__ = [
    "ContractError",
    "Dataflow",
    "Layer",
    "Mask",
    "RowFilter",
    "Rule",
    "RuleError",
    "RunReport",
    "Split",
    "add_processing_time",
    "align",
    "annotate",
    "compile_rules",
    "create_policy_functions",
    "expectation_metrics",
    "governed",
    "grouped_stats",
    "load_contract",
    "merge_stats",
    "observe_rules",
    "parse_contract",
    "partial_stats",
    "publish_governed_view",
    "publish_governed_views",
    "publish_session_view",
    "quality_layers",
    "refresh",
    "register_rule",
    "rejected_rows",
    "rejects_by_code",
    "row_count",
    "run",
    "set_principal",
    "split",
    "use_namespace",
    "valid_rows",
]
