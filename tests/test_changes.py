"""JSON trees and typed changes of trials against plain versions."""

import json
import random

import pytest
from lodestar.operators import json_trees, trial_changes, versions
from pyspark.sql import functions as F


def tree(x, keys=(), at=()):
    """Leaves of a parsed JSON value in document order."""
    if isinstance(x, dict) and x:
        for i, (k, v) in enumerate(x.items()):
            yield from tree(v, (*keys, k), (*at, i))
    elif isinstance(x, list) and x:
        for i, v in enumerate(x):
            yield from tree(v, (*keys, None), (*at, i))
    else:
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(x), "number")
        yield keys, at, kind, None if x is None else x if isinstance(x, str) else json.dumps(x, separators=(",", ":"))


def some_json(r, depth=0):
    kind = r.randint(0, 7 if depth < 4 else 4)
    if kind > 5:
        return [some_json(r, depth + 1) for _ in range(r.randint(0, 3))]
    if kind == 5:
        return {k: some_json(r, depth + 1) for k in r.sample(["z", "a", "m", "b c", "é", "q.r", "0"], r.randint(0, 4))}
    return r.choice([None, True, False, r.randint(-9, 9), r.choice(["", "x", "5", "null", '{"a": 1}', 'say "hi"', "é\n"])])


def test_leaves_come_in_document_order(spark):
    r = random.Random(1)
    values = [{k: some_json(r) for k in r.sample("zyxabc", r.randint(0, 5))} for _ in range(60)] + [[1, "a"], "plain", 7, None, {}, [], [[["deep"]]]]
    rows = [(i, json.dumps(v, ensure_ascii=i % 2 == 0)) for i, v in enumerate(values)] + [(900, None), (901, "{broken"), (902, "")]
    df = spark.createDataFrame(rows, "doc long, body string").withColumn("kind", F.lit(1)).withColumn("raw", F.lit(1))
    got = json_trees.leaves(df, "doc", "body").collect()
    by = {}
    for x in got:
        by.setdefault(x["id"], []).append((tuple(x["keys"]), tuple(x["position"]), x["kind"], x["value"]))
    for i, v in enumerate(values):
        assert sorted(by.get(i, []), key=lambda x: x[1]) == list(tree(v)), v
    assert not {900, 901, 902} & set(by)


def plain_text(data):
    """Strings of the sections as they are walked."""

    def walk(d):
        for v in d.values():
            if isinstance(v, str):
                yield v
            elif isinstance(v, dict):
                yield from walk(v)
            elif isinstance(v, list):
                for item in v:
                    if isinstance(item, dict):
                        yield from walk(item)
                    elif isinstance(item, str):
                        yield item

    for s in json_trees.SECTIONS:
        part = data.get(s)
        for x in [part] if isinstance(part, dict) else part if isinstance(part, list) else []:
            if isinstance(x, dict):
                yield from walk(x)


def test_section_texts_equal_a_walk(spark):
    r = random.Random(2)
    values = [{k: some_json(r) for k in r.sample([*json_trees.SECTIONS, "other"], 6)} for _ in range(80)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "doc long, body string")
    got = {x["id"]: x["text"] for x in json_trees.section_texts(df, "doc", "body").collect()}
    want = {i: " ".join(t) for i, v in enumerate(values) if (t := list(plain_text(v)))}
    assert got == want


@pytest.mark.parametrize(
    ("old", "new", "want"),
    [
        ('{"a":{"x":1,"y":[1,{"p":2,"q":3}]}}', '{"a":{"y":[1,{"q":3,"p":2}],"x":1}}', []),
        ('{"a":[1,2]}', '{"a":[2,1]}', [("a", "modified", "[1,2]", "[2,1]")]),
        ('{"a":"5"}', '{"a":5}', [("a", "modified", "5", "5")]),
        ('{"a":null,"b":1}', '{"a":null}', [("b", "removed", "1", None)]),
        ('{"a":{"x":null}}', '{"a":{}}', [("a", "modified", '{"x":null}', "{}")]),
        (None, '{"a":null}', [("a", "added", None, None)]),
        ("broken", "[1]", []),
        ("{}", "{}", []),
    ],
)
def test_json_diff_compares_whole_values(spark, old, new, want):
    row = spark.createDataFrame([(old, new)], "o string, n string").select(versions.json_diff(F.col("o"), F.col("n")).alias("d")).first()["d"]
    assert [tuple(x) for x in row] == want


def test_plan_and_arms(spark):
    rows = [
        ('{"alpha":0.05,"note":"a"}', '{"alpha":0.025,"note":"a"}', True, "H", ["alpha"]),
        ('{"alpha":0.05,"note":"a"}', '{"alpha":0.05,"note":"b"}', False, "M", []),
        ('{"alpha":0.05}', '{"one_sided":true}', False, "M", []),
        ('{"alpha":0.05}', '{"alpha":0.05}', None, None, None),
        ('{"alpha":0.05}', "[1]", None, None, None),
    ]
    df = spark.createDataFrame([(a, b) for a, b, *_ in rows], "o string, n string")
    got = [x["p"] for x in df.select(versions.plan_change(F.col("o"), F.col("n")).alias("p")).collect()]
    assert [tuple(p) if p else (None, None, None) for p in got] == [tuple(x[2:]) for x in rows]
    arms = spark.createDataFrame([('{"a":1}', '{"a":1,"b":2}'), ('{"a":1}', '{"a":2}'), ('{"a":1}', None)], "o string, n string")
    got = [x["p"] and tuple(x["p"]) for x in arms.select(versions.arms_change(F.col("o"), F.col("n")).alias("p")).collect()]
    assert got == [(True, "H", 1), (False, "M", 0), None]


def version(**changes):
    base = {"brief_title": "T", "phase": "P2", "status": "S", "lead_sponsor_name": "L", "collaborators": ["x", "y"], "allocation": "R", "masking": "M", "interventions": [("a", "DRUG"), ("b", "DEVICE")], "primary_outcomes": [("OS", "1y"), (None, "2y"), ("PFS", None)], "enrollment": 100, "alpha_level": 0.05, "power": 0.8, "study_start_date": None, "primary_completion_date": None, "locations": ["p", "q"]}
    return tuple((base | changes).values())


CASES = [
    ({}, []),
    ({"brief_title": None}, [("brief_title", "MODIFIED", "T", None, "LOW", "Brief title changed")]),
    ({"collaborators": ["y", "z", "z", None]}, [("sponsor_info.collaborators", "MODIFIED", "x, y", "y, z", "MEDIUM", "Collaborators added: z"), ("sponsor_info.collaborators", "MODIFIED", "x, y", "y, z", "MEDIUM", "Collaborators removed: x")]),
    ({"interventions": [("b", "DRUG"), ("c", "DRUG"), ("b", "OTHER")]}, [("interventions", "ADDED", None, "c", "MEDIUM", "New intervention added: c"), ("interventions", "REMOVED", "a", None, "MEDIUM", "Intervention removed: a"), ("interventions.b.type", "MODIFIED", "DEVICE", "OTHER", "MEDIUM", "Intervention type changed for b")]),
    ({"primary_outcomes": None}, [("primary_endpoint_text", "MODIFIED", "OS (1y); PFS", "", "HIGH", "Primary endpoint changed")]),
    ({"enrollment": 109}, []),
    ({"enrollment": 110}, [("enrollment_info.count", "MODIFIED", "100", "110", "MEDIUM", "Sample size changed by 10.0%")]),
    ({"enrollment": 0}, [("enrollment_info.count", "MODIFIED", "100", "0", "MEDIUM", "Sample size information changed")]),
    ({"power": None}, []),
    ({"power": 0.9, "alpha_level": None}, [("statistical_analysis.alpha_level", "MODIFIED", "0.05", None, "HIGH", "Alpha level changed"), ("statistical_analysis.power", "MODIFIED", "0.8", "0.9", "HIGH", "Statistical power changed by 12.5%")]),
    ({"locations": None}, [("locations", "REMOVED", "p", None, "LOW", "Location removed: p"), ("locations", "REMOVED", "q", None, "LOW", "Location removed: q")]),
]


def test_nine_groups(spark):
    kind = f"id int, o {trial_changes.FIELDS}, n {trial_changes.FIELDS}"
    df = spark.createDataFrame([(i, version(), version(**c)) for i, (c, _) in enumerate(CASES)], kind)
    found = df.select("id", trial_changes.detect_changes(F.col("o"), F.col("n")).alias("c")).withColumn("text", trial_changes.change_text(F.col("c"))).withColumn("big", trial_changes.significant(F.col("c")))
    got = {r["id"]: r for r in found.collect()}
    for i, (_, want) in enumerate(CASES):
        assert [tuple(c) for c in got[i]["c"]] == want
        assert got[i]["big"] == any(c[4] != "LOW" for c in want)
    assert got[0]["text"] == "No changes detected"
    assert got[6]["text"] == "Detected 1 changes:\n\nMEDIUM significance (1):\n  • enrollment_info.count: Sample size changed by 10.0%"
