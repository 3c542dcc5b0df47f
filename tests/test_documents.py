"""One large document that many tasks read."""

import json
import random

import pytest
from helpers import RECORD, conf
from pyspark.sql import functions as F

from dailyfacts.operators.columns import explode_records
from dailyfacts.plans import cases
from dailyfacts.schemas import CASES
from dailyfacts.sources import read_case_documents, read_case_records, read_model
from dailyfacts.sources.documents import BrokenDocument

#: Splits of some hundred bytes.
TINY = {"spark.sql.files.openCostInBytes": "1", "spark.sql.files.maxPartitionBytes": "700"}
#: Texts with what records are cut at.
TRAPS = ["a } b", '}, {"x": "', '{"records": [', 'q"}', '\\"}{', "]}", "\\", "{[", "}" * 30]


def record(i, odd, rng):
    one = {
        **RECORD, "day": i % 28, "cases": str(i), "deaths": 1.5e7 if i % 5 == 0 else i,
        "countriesAndTerritories": f"Land {i}", "geoId": 'G"x\\' if i % 3 == 0 else "é", "continentExp": None,
    }
    if odd and i % 4 == 0:
        one["countriesAndTerritories"] = rng.choice(TRAPS)
    if odd and i % 6 == 0:
        one["popData2018"] = {"a": [{"b": 1}, {"c": "}"}]}
    return one


def put(tmp_path, text, name="d.json"):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def texts(records):
    return sorted(r[0] for r in records.select(F.to_json("record")).collect())


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize(("indent", "end"), [(None, ""), (2, "\n")])
def test_rows_are_those_of_the_whole_document(spark, tmp_path, odd, indent, end):
    rng = random.Random(1)
    path = put(tmp_path, json.dumps({"records": [record(i, odd, rng) for i in range(60)]}, indent=indent) + end)
    with conf(spark, TINY):
        split = read_case_records(spark, path)
        assert split.rdd.getNumPartitions() > 10
        assert texts(split) == texts(explode_records(read_case_documents(spark, path)))


def test_several_documents_of_both_kinds(spark, tmp_path):
    rng = random.Random(2)
    for name, odd in (("a.json", False), ("b.json", True), ("c.json", False)):
        put(tmp_path, json.dumps({"records": [record(i, odd, rng) for i in range(9)]}), name)
    put(tmp_path, '{"records": []}\n', "e.json")
    assert texts(read_case_records(spark, str(tmp_path))) == texts(
        explode_records(read_case_documents(spark, str(tmp_path)))
    )


@pytest.mark.parametrize("odd", [False, True])
def test_broken_documents_fail(spark, tmp_path, odd):
    rng = random.Random(3)
    whole = json.dumps({"records": [record(i, odd, rng) for i in range(20)]})
    broken = {
        "cut brace": whole[:-1], "cut bracket": whole[:-2], "cut record": whole[:-60], "cut early": whole[:300],
        "more": whole + "}", "text behind": whole + "x", "no begin": whole[1:], "twice": whole + whole,
        "other key": whole.replace("records", "other", 1), "no comma": whole.replace("}, {", "} {", 1),
        "no value": whole.replace('"day": 1,', '"day": ,', 1), "no quote": whole.replace('"cases"', '"cases', 1),
        "second key": whole.replace('{"records"', '{"m": {"a": 1}, "records"', 1),
    }
    for name, text in broken.items():
        folder = tmp_path / name.replace(" ", "_")
        folder.mkdir()
        with pytest.raises(Exception) as caught:
            read_case_records(spark, put(folder, text)).collect()
        assert isinstance(caught.value, BrokenDocument) or any(
            s in str(caught.value) for s in ("is no document of records", "MALFORMED")
        ), name


def test_case_job_from_a_split_document(spark, tmp_path):
    folder = tmp_path / "covid19"
    folder.mkdir()
    put(folder, json.dumps({"records": [RECORD, RECORD, {**RECORD, "cases": "many"}]}), "download.json")
    report = cases.load_cases(spark, str(tmp_path), str(tmp_path), split=True)
    assert report.rows_read == 3 and report.rejects["cases"] == 1
    assert read_model(spark, f"{tmp_path}/{cases.OUTPUT}", CASES).count() == 2
    put(folder, '{"records": []}', "download.json")
    with pytest.raises(ValueError, match="holds no record"):
        cases.load_cases(spark, str(tmp_path), str(tmp_path), split=True)


def test_no_python_in_the_plan(spark, tmp_path):
    rng = random.Random(4)
    path = put(tmp_path, json.dumps({"records": [record(i, True, rng) for i in range(9)]}))
    plan = read_case_records(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
