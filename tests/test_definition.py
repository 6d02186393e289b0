import json

import pytest

from spectrine.errors import DefinitionError
from spectrine.plans.definition import Plan, class_names, compile_plan, load, parity

KS = {"class": "lib.operators.splitters.KennardStoneSplitter", "params": {"test_size": 0.3}}
SNV = {"class": "lib.operators.transforms.SNV"}
SG = {"class": "lib.operators.transforms.nirs.SavitzkyGolay"}
PLS = {"class": "sklearn.cross_decomposition.PLSRegression"}
SWEEP = {"model": PLS, "_range_": [2, 11, 2], "param": "n_components"}


def test_json_yaml_list_and_path_agree(tmp_path):
    steps = [KS, SNV, SG, SWEEP]
    text = json.dumps({"name": "x", "steps": steps, "random_state": 42})
    path = tmp_path / "p.json"
    path.write_text(text)
    yaml = "name: x\nrandom_state: 42\npipeline:\n" + "".join(f"  - {json.dumps(s)}\n" for s in steps)
    (tmp_path / "p.yml").write_text(yaml)
    want = Plan(0.3, (("StandardNormalVariate", ()), ("SavitzkyGolay", (11, 3, 0, "interp", 0.0))), (2, 4, 6, 8, 10))
    for source in (text, path, str(path), yaml, str(tmp_path / "p.yml"), steps, {"pipeline": steps}):
        assert compile_plan(source) == want
    assert load(text).as_dict() == load(yaml).as_dict() == {"name": "x", "description": "", "pipeline": steps, "random_state": 42}


def test_comments_names_and_random_state():
    d = load([{"_comment": "first"}, {**SNV, "_comment": "x"}, {"model": {**PLS, "_comment": "y"}}])
    assert d.pipeline == [SNV, {"model": PLS}] and d.name == "pipeline" and "random_state" not in d.as_dict()
    assert class_names(d) == [SNV["class"], PLS["class"]]
    assert load({"pipeline": [], "random_state": True}).random_state is None


@pytest.mark.parametrize(
    "source",
    [
        [{"class": "lib.operators.transforms.Unknown"}, {"model": PLS}],
        [{"model": PLS}, {"model": PLS}],
        [SNV],
        [SNV, {"model": SNV}],
        [{**SG, "params": {"delta": 2}}, {"model": PLS}],
        [{**SG, "params": {"mode": "odd"}}, {"model": PLS}],
        [{**SG, "params": {"mode": 7}}, {"model": PLS}],
        [{**SG, "params": {"window_length": 11.5}}, {"model": PLS}],
        [{**SG, "params": {"window_length": 10}}, {"model": PLS}],
        [{"model": PLS, "_range_": [5, 2, 1], "param": "n_components"}],
        [{"model": PLS, "_range_": [0, 2, 1], "param": "n_components"}],
        [{"model": PLS, "_range_": [1, 2, 1], "param": "other"}],
        [{"model": {**PLS, "params": {"n_components": 0}}}],
        [{"model": {**PLS, "params": {"n_components": "2.5"}}}],
        ["step", {"model": PLS}],
        {"name": "no steps"},
        {"pipeline": {}},
        {"pipeline": [], "random_state": "7"},
        "not: [valid",
        "/no/such/file.txt",
    ],
)
def test_refusals(source):
    with pytest.raises(DefinitionError):
        compile_plan(source)


def test_missing_file_is_named():
    with pytest.raises(FileNotFoundError):
        load("/no/such/file.yaml")


def test_parameters():
    plan = compile_plan([{**SG, "params": {"window": "7", "window_length": None, "polyorder": 2, "mode": "NEAREST", "cval": 1}}, {"model": {**PLS, "params": {"n_components": 3}}}])
    assert plan.preprocessing == (("SavitzkyGolay", (7, 2, 0, "nearest", 1.0)),) and plan.n_components == (3,) and plan.test_size is None
    assert compile_plan([{"model": PLS}]).n_components == (2,)


def test_parity_of_two_definitions():
    steps = [KS, SNV, SWEEP]
    assert all(parity(steps, json.dumps(steps)).values())
    assert parity(steps, [SNV, SWEEP]) == {"classes": False, "random_state": True, "name": True, "plan": False}


def test_class_names_below_one_root(monkeypatch):
    from spectrine.plans import definition as D

    names = [f"lib.{n}" for n in D.BELOW_ROOT] + list(D.WHOLE)
    assert len(names) == 9 and all(D.operator_of(n) for n in names)
    for bad in ("lib.operators.SNV", "a.b.operators.transforms.SNV", "operators.transforms.SNV", "", None, "x.sklearn.cross_decomposition.PLSRegression", "li b.operators.transforms.SNV"):
        assert D.operator_of(bad) is None
    monkeypatch.setattr(D, "ROOTS", {"lib"})
    assert all(D.operator_of(n) for n in names) and D.operator_of("other.operators.transforms.SNV") is None
