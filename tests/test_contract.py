import copy
import json

import pytest

from rowsieve.plans.contract import ContractError, load_contract, parse_contract, substitute

PARCELS = {
    "name": "parcel-intake",
    "sources": [
        {"name": "scans", "path": "/depot/{env_catalog}/scans/2024/*", "format": "JSON"},
        {"name": "prices", "path": "/depot/prices", "format": "csv"},
    ],
    "transformations": [
        {"name": "seen", "type": "add_timestamp", "params": {"column": "seen_at", "as": "timestamp"}},
        {
            "name": "weighed",
            "type": "validate_fields",
            "params": {
                "input": "seen",
                "validations": [
                    {"field": "barcode", "validations": ["notNull"], "null_policy": "fail"},
                    {"field": "grams", "sql_expressions": [{"error_code": "heavy", "expression": "grams <= 30000"}]},
                ],
            },
        },
    ],
    "sinks": [
        {"name": "shelf_ok", "paths": ["/depot/{env_catalog}/shelf", "/mirror/shelf"], "format": "PARQUET"},
        {"name": "counter_ko", "paths": ["/depot/{env_catalog}/counter"], "format": "DELTA", "saveMode": "OVERWRITE"},
        {"name": "ledger", "input": "seen", "paths": ["/depot/ledger"], "cluster_by": "barcode"},
    ],
}


def contract(**changes):
    return {**copy.deepcopy(PARCELS), **changes}


def test_a_whole_contract(tmp_path):
    file = tmp_path / "flow.json"
    file.write_text(json.dumps(PARCELS))
    flow = load_contract(file, {"env_catalog": "north"})
    assert flow.name == "parcel-intake"
    assert [(s.path, s.fmt) for s in flow.sources] == [("/depot/north/scans/2024/*", "json"), ("/depot/prices", "csv")]
    assert [s.outputs for s in flow.steps] == [("seen",), ("weighed_ok", "weighed_ko")]
    assert [(s.input, s.fmt, s.mode, s.paths, s.cluster_by) for s in flow.sinks] == [
        ("weighed_ok", "parquet", "append", ("/depot/north/shelf", "/mirror/shelf"), ()),
        ("weighed_ko", "delta", "overwrite", ("/depot/north/counter",), ()),
        ("seen", "parquet", "append", ("/depot/ledger",), ("barcode",)),
    ]
    assert {flow.origin(s.input) for s in flow.sinks} == {"scans"}


def test_a_contract_in_the_shared_store(spark, tmp_path):
    file = tmp_path / "flow.json"
    file.write_text(json.dumps(PARCELS, indent=1))
    assert load_contract(f"file:{file}", {"env_catalog": "x"}, spark=spark) == load_contract(file, {"env_catalog": "x"})
    with pytest.raises(FileNotFoundError):
        load_contract(f"{file}.not", spark=spark)


def test_contract_with_a_repeated_rule_parses():
    repeated = contract()
    repeated["transformations"][1]["params"]["validations"] *= 2
    assert len(parse_contract(repeated, {"env_catalog": "x"}).steps) == 2


def stamped(sink_input):
    """A sink by the name of a step's output."""
    return [{"name": "late", "input": sink_input, "paths": ["/depot/late"], "mode": "append"}]


def test_sink_inputs_by_name():
    again = {"name": "twice_seen", "type": "add_timestamp", "params": {"input": "weighed_ko"}}
    steps = [*PARCELS["transformations"], again]
    flow = parse_contract(contract(transformations=steps, sinks=stamped("twice_seen")), {"env_catalog": "x"})
    assert flow.sinks[0].input == "twice_seen" and flow.origin("twice_seen") == "scans"


def test_sink_input_nobody_makes():
    with pytest.raises(ContractError, match="twice_seen"):
        parse_contract(contract(sinks=stamped("twice_seen")), {"env_catalog": "x"})
    aliased = parse_contract(
        contract(sinks=stamped("twice_seen")), {"env_catalog": "x"}, aliases={"twice_seen": "weighed_ok"}
    )
    assert aliased.sinks[0].input == "weighed_ok"


def test_unreadable_contracts(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_contract(tmp_path / "missing.json")
    file = tmp_path / "bad.json"
    file.write_text("{")
    with pytest.raises(json.JSONDecodeError):
        load_contract(file)
    file.write_text("[]")
    with pytest.raises(ContractError):
        load_contract(file)


@pytest.mark.parametrize("key", ["name", "sources", "transformations", "sinks"])
def test_required_keys(key):
    broken = contract()
    del broken[key]
    with pytest.raises(ContractError, match=key):
        parse_contract(broken, {"env_catalog": "x"})


def step(**changes):
    return [PARCELS["transformations"][0], {**copy.deepcopy(PARCELS["transformations"][1]), **changes}]


def sink(**changes):
    return [{**PARCELS["sinks"][0], **changes}]


@pytest.mark.parametrize(
    "changes, message",
    [
        ({"sources": []}, "at least one source"),
        ({"sources": {}}, "must be a list"),
        ({"sources": [{"path": "/x"}]}, "needs a name"),
        ({"sources": [{"name": "a"}]}, "needs a path"),
        ({"sources": [{"name": "a", "path": "/{nobody}/x"}]}, "nobody"),
        ({"sources": PARCELS["sources"] * 2}, "same name"),
        ({"transformations": step(type="explode")}, "explode"),
        ({"transformations": step(params={"input": "nobody"})}, "nobody"),
        ({"transformations": step(params={"validations": {}})}, "must be a list"),
        ({"transformations": step() * 2}, "redefines"),
        ({"sinks": sink(name=None)}, "needs a name"),
        ({"sinks": sink(paths=[])}, "paths"),
        ({"sinks": sink(mode="MERGE")}, "merge"),
        ({"sinks": sink(name="shelf")}, "no input"),
        ({"sinks": sink() + sink(name="again_ok")}, "share the place"),
        ({"sinks": sink(paths=["/depot/x/scans/2024"])}, "share the place"),
        ({"sinks": sink(paths=["/depot/x/scans"])}, "share the place"),
        ({"sinks": sink(paths=["/depot/x/scans/2024/ok/"])}, "share the place"),
        (
            {"summaries": [{"name": "g", "input": "shelf_ok", "by": "a", "value": "b", "path": "/depot/x/shelf/g"}]},
            "share the place",
        ),
        ({"summaries": [{"name": "g"}]}, "needs name"),
        ({"summaries": [{"name": "g", "input": "x", "by": "a", "value": "b"}]}, "name of a sink"),
        ({"summaries": [{"name": "g", "input": "shelf_ok", "by": "a", "value": "b"}]}, "path or a table"),
    ],
)
def test_bad_shapes(changes, message):
    with pytest.raises(ContractError, match=message):
        parse_contract(contract(**changes), {"env_catalog": "x"})


def test_substitution_touches_strings_only():
    value = {"a": ["{x}", 1, None, True], "b": "{x}/{y}", "rule": r"name RLIKE '^\\d{2}$'"}
    assert substitute(value, {"x": '"quoted"'}) == {
        "a": ['"quoted"', 1, None, True],
        "b": '"quoted"/{y}',
        "rule": r"name RLIKE '^\\d{2}$'",
    }


def test_without_a_validate_step():
    only = PARCELS["transformations"][:1]
    flow = parse_contract(contract(transformations=only, sinks=PARCELS["sinks"][:1]), {"env_catalog": "x"})
    assert flow.sinks[0].input == "seen"
    flow = parse_contract(contract(transformations=only, sinks=PARCELS["sinks"][:2]), {"env_catalog": "x"})
    assert [s.input for s in flow.sinks] == ["validate_ok", "validate_ko"]
    assert flow.steps[-1].params == {"validations": []} and flow.origin("validate_ko") == "scans"


def test_neighbours_with_a_common_prefix_are_fine():
    flow = parse_contract(contract(sinks=sink(paths=["/depot/x/scans/20245"])), {"env_catalog": "x"})
    assert flow.sinks[0].paths == ("/depot/x/scans/20245",)


def test_names_of_measures():
    summary = {"name": "g", "input": "shelf_ok", "by": "depot", "value": "grams", "path": "/g"}
    named = {**summary, "name": "h", "path": "/h", "count_as": "parcels", "mean_as": "mean_grams"}
    flow = parse_contract(contract(summaries=[summary, named]), {"env_catalog": "x"})
    assert [(s.count_as, s.mean_as) for s in flow.summaries] == [("total_rows", "average_grams"), ("parcels", "mean_grams")]
