"""Documents cut at braces against the reader of whole documents."""

import json
import os
import random
import subprocess
import sys
from collections import Counter

import pytest
from pyspark import cloudpickle

from wardbook.plans.export_queries import _document_lines
from wardbook.sources import exports as ex
from wardbook.sources import splitting


def record(i, **more):
    return {"dataElement": f"e{i}", "period": "202401", "orgUnit": f"u{i % 7}", "value": str(i), "storedBy": "Ann", **more}


def envelope(records, **more):
    return {"responseType": "DataValueSet", "version": "2", "dataValues": records, **more}


BRACES = ['},{', '},{"dataElement":', "{", "}]}", 'a "quoted" {word}', "back\\slash{", '\\"{', "{{}}", "[{", "]", 'x{"', ""]
LAYOUTS = {
    "plain": [envelope([record(i) for i in range(60)])],
    "braces in strings": [envelope([record(i, value=BRACES[i % len(BRACES)]) for i in range(60)])],
    "objects in records": [envelope([record(i, extra={"a": [{"b": i}, {}], "value": "no"}) for i in range(40)])],
    "objects around": [{
        "system": {"created": "x"}, "lists": [{"value": "no"}, {"period": "no"}], **envelope([record(i) for i in range(40)]),
        "pager": {"value": "9"}, "after": [{"dataElement": "no"}],
    }],
    "the array first": [{"dataValues": [record(i) for i in range(30)], "after": [{"dataElement": "no"}], "version": "{"}],
    "empty records": [envelope([{}, record(1), {}, {}, record(2, value="{}")])],
    "other fields first": [envelope([{"comment": "c{", **record(i)} for i in range(20)])],
    "no records": [envelope([])],
    "one record": [envelope([record(1)])],
    "no array": [{"version": "2"}],
    "values of other types": [envelope([record(1, value=5), record(2, value=None), record(3, followup=True)])],
}


def found(documents):
    return Counter(tuple(r) for r in ex.flatten_data_values(documents).collect())


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    yield
    for name, value in zip(names, before):
        spark.conf.set(name, value)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_equals_the_document_reader(spark, small_splits, tmp_path, layout, indent):
    path = tmp_path / "data_values.json"
    path.write_text("".join(json.dumps(d, indent=indent, ensure_ascii=False) for d in LAYOUTS[layout]))
    whole = ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT, multi_line=True)
    assert found(ex.read_split_data_values(spark, str(path))) == found(whole)


def test_folder_of_files_and_many_documents_in_a_file(spark, small_splits, tmp_path):
    folder = tmp_path / "data_values.json"
    folder.mkdir()
    everything = [d for layout in LAYOUTS.values() for d in layout]
    for i, d in enumerate(everything):
        (folder / f"{i}.json").write_text(json.dumps(d) + "\n")
    (folder / "all.json").write_text("\n".join(json.dumps(d) for d in everything) + "\n")
    whole = ex.read_documents(spark, str(folder), ex.DATA_VALUES_DOCUMENT)
    assert found(ex.read_split_data_values(spark, str(folder))) == found(whole)


def test_random_documents(spark, small_splits, tmp_path):
    draw = random.Random(3)
    for turn in range(4):
        text = lambda: "".join(draw.choices('{}[]",:\\ né\n"', k=draw.randint(0, 12)))
        records = [
            dict(draw.sample(list(record(i, value=text(), storedBy=text(), odd=draw.choice([text(), {"x": [text()]}, [{}], 3])).items()), k=5))
            for i in range(80)
        ]
        path = tmp_path / f"{turn}.json"
        path.write_text(json.dumps(envelope(records, notes=[{"value": text()}]), indent=draw.choice([None, 1])))
        whole = ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT, multi_line=True)
        assert found(ex.read_split_data_values(spark, str(path))) == found(whole)


def test_one_plain_document_is_read_by_many_tasks_without_a_shuffle(spark, small_splits, tmp_path):
    path = tmp_path / "data_values.json"
    path.write_text(json.dumps(envelope([record(i) for i in range(500)])))
    documents = ex.read_split_data_values(spark, str(path))
    assert documents.rdd.getNumPartitions() > 8
    assert "Exchange" not in documents._jdf.queryExecution().executedPlan().toString()
    assert splitting._is_plain(splitting._pieces(spark, str(path)), "dataValues", ["dataElement"])


def test_pieces_are_read_and_moved_once(spark, small_splits, tmp_path):
    path = tmp_path / "data_values.json"
    path.write_text(json.dumps(envelope([record(i, value=BRACES[i % len(BRACES)]) for i in range(500)])))
    documents = ex.read_split_data_values(spark, str(path))
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" text") == 0 and plan.count("piece#") > 0
    assert plan.count("Relation [file") == 4  # the pieces, and the counts of the records by block and document
    assert plan.count("Window [") <= 8


def test_records_longer_than_a_block(spark, small_splits, tmp_path):
    long = '},{"dataElement":{"]}{' * 150
    records = [record(i, value=long[: i % 4 * 1100]) for i in range(30)]
    path = tmp_path / "data_values.json"
    path.write_text(json.dumps(envelope(records, notes=[{"value": long}], after={"a": [{"b": long}]}), indent=1))
    whole = ex.read_documents(spark, str(path), ex.DATA_VALUES_DOCUMENT, multi_line=True)
    assert found(ex.read_split_data_values(spark, str(path))) == found(whole)


def test_records_of_whole_files_are_not_moved(spark, tmp_path):
    folder = tmp_path / "data_values.json"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.json").write_text(json.dumps(envelope([record(j, value=BRACES[j % len(BRACES)]) for j in range(50)]), indent=2))
    documents = ex.read_split_data_values(spark, str(folder))
    plan = documents._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan and "Aggregate [" not in plan and "Join " not in plan
    assert found(documents) == found(ex.read_documents(spark, str(folder), ex.DATA_VALUES_DOCUMENT, multi_line=True))


@pytest.mark.parametrize("size", ["700", "90", "128m"])
def test_objects_after_the_array_and_nulls_in_it(spark, small_splits, tmp_path, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    records = [record(i, value=BRACES[i % len(BRACES)]) for i in range(12)]
    around = {"system": {"x": {"y": 1, "dataValues": [record(99)]}}, "lists": [[record(98)], {"value": "}"}], "dataValues ": [record(97)]}
    documents = [
        {**envelope(records), **around}, {"version": "2"}, {**around, "dataValues": records},
        {"dataValues": [], "system": {"dataValues": [{"dataElement": "no"}]}}, {"a\\\"dataValues": [record(96)]},
    ]
    folder = tmp_path / "data_values.json"
    folder.mkdir()
    (folder / "all.json").write_text("\n".join(json.dumps(d) for d in documents) + "\n")
    whole = found(ex.read_documents(spark, str(folder), ex.DATA_VALUES_DOCUMENT))
    assert found(ex.read_split_data_values(spark, str(folder))) == whole
    (folder / "null.json").write_text(json.dumps({"dataValues": [None, record(50, value="{"), None, record(51)], "after": [{}]}))
    more = [json.dumps({"dataValues": [record(50, value="{"), record(51)]})]
    (tmp_path / "more.json").write_text("\n".join(more))
    expected = whole + found(ex.read_documents(spark, str(tmp_path / "more.json"), ex.DATA_VALUES_DOCUMENT))
    assert found(ex.read_split_data_values(spark, str(folder))) == expected


def test_blocks_of_whole_and_cut_files_of_many_documents(spark, small_splits, tmp_path):
    draw = random.Random(5)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    folder = tmp_path / "data_values.json"
    folder.mkdir()
    for i in range(12):
        documents = [
            envelope([record(j, value=draw.choice(BRACES), extra=draw.choice([{}, [], [[{"a": "]"}]], "{"])) for j in range(draw.choice([0, 0, 1, 5]))],
                     after=draw.choice([None, {"b": {"c": []}}, [{"d": "}"}]]))
            for _ in range(draw.choice([1, 2, 20]))
        ]
        if i % 4 == 0:
            documents = [{"version": str(i)}]
        (folder / f"{i}.json").write_text("\n".join(json.dumps(d) for d in documents) + "\n")
    whole = ex.read_documents(spark, str(folder), ex.DATA_VALUES_DOCUMENT)
    assert found(ex.read_split_data_values(spark, str(folder))) == found(whole)


def test_executors_need_not_have_the_package(tmp_path):
    walk = cloudpickle.dumps(splitting._found_rows(b"dataValues", {}))
    code = "import pickle, sys; assert not [*pickle.load(sys.stdin.buffer)([])]; assert 'wardbook' not in sys.modules"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], input=walk, cwd=tmp_path, env=env, check=True)


def test_documents_are_written_by_record(spark, tmp_path):
    rows = [(d, json.dumps(record(i, value="{"))) for d in (1, 2, None) for i in range(20 if d else 1)]
    lines = _document_lines(spark.createDataFrame(rows, "document long, record string"))
    assert "collect_list" not in lines._jdf.queryExecution().optimizedPlan().toString()
    assert lines.count() == len(rows)
    lines.write.partitionBy("document").text(str(tmp_path / "out"))
    for d, n in ((1, 20), (2, 20), ("__HIVE_DEFAULT_PARTITION__", 1)):
        [file] = (tmp_path / "out" / f"document={d}").glob("part-*.txt")
        text = file.read_text()
        assert text.startswith('{\n  "version": "2",\n  "dataValues": [\n    {"') and text.endswith("}\n  ]\n}\n")
        assert sorted(r["dataElement"] for r in json.loads(text)["dataValues"]) == sorted(f"e{i}" for i in range(n))


def test_a_document_that_breaks_off_gives_its_whole_records(spark, tmp_path):
    path = tmp_path / "data_values.json"
    path.write_text(json.dumps(envelope([record(i) for i in range(10)]))[:-40])
    rows = ex.flatten_data_values(ex.read_split_data_values(spark, str(path))).collect()
    assert sorted(r["data_element_uid"] for r in rows if r["data_element_uid"]) == [f"e{i}" for i in range(9)]
    assert len(rows) == 10


def test_lines_and_documents_exclude_each_other(spark, tmp_path):
    with pytest.raises(ValueError):
        ex.load_exports(spark, str(tmp_path), data_values_as_lines=True, split_data_values=True)
