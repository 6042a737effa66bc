import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from turnmill.functions.samples import with_prompt
from turnmill.sources import files, writers

QA = [
    {"question": "茶怎么泡？", "answer": "水开后等两分钟。", "category": "厨房"},
    {"question": "桥为什么不倒？", "answer": "拱把重量\n传到两岸。", "category": "建筑"},
    {"question": "q3", "answer": None, "n": 1.5},
]


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def loaded(df):
    return [json.loads(r.sample) for r in df.orderBy("pos").collect()]


def test_jsonl(spark, tmp_path):
    lines = [json.dumps(x, ensure_ascii=False) for x in QA]
    path = put(tmp_path, "a.jsonl", "\n".join([lines[0], "", " 　", *lines[1:]]) + "\n")
    df = files.load(spark, path)
    assert loaded(df) == QA
    assert [r.pos for r in df.orderBy("pos").collect()] == [0, 1, 2]
    bad = put(tmp_path, "bad.jsonl", '{"a":1}\n{"a":\n')
    with pytest.raises(PySparkException):
        files.load(spark, bad).collect()


@pytest.mark.parametrize("indent", [None, 1, 2, 4])
def test_json_layouts(spark, tmp_path, indent):
    nested = [*QA, {"z": {"y": [1, {"x": "\n  },\n  {"}]}, "a": []}]
    text = json.dumps(nested, ensure_ascii=False, indent=indent)
    assert loaded(files.load(spark, put(tmp_path, f"l{indent}.json", text))) == nested
    wrapped = json.dumps({"data": nested, "v": 1}, ensure_ascii=False, indent=indent)
    assert loaded(files.load(spark, put(tmp_path, f"w{indent}.json", wrapped))) == nested
    single = json.dumps(QA[0], indent=indent)
    for fmt in ("json", "gala", "browsecomp"):
        assert loaded(files.load(spark, put(tmp_path, f"s{indent}.json", single), fmt)) == [QA[0]]


def test_indented_array_is_cut_into_many_tasks(spark, tmp_path):
    rows = [{"i": i, "text": "word " * 40, "inner": {"a": [i]}} for i in range(3000)]
    path = put(tmp_path, "big.json", json.dumps(rows, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = files.load(spark, path)
        assert df.select(F.spark_partition_id().alias("p")).distinct().count() > 3
        assert loaded(df) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv(spark, tmp_path):
    text = 'id,name,flag,score,note\n1,"a ""b""\nc",True,1.5,NA\n2,NaN,False,2,x\n3,plain,,NA,null\n'
    df = files.read_csv(spark, put(tmp_path, "a.csv", text))
    assert [f.dataType.simpleString() for f in df.select("id", "name", "flag", "score", "note").schema] == [
        "bigint", "string", "boolean", "double", "string",
    ]
    got = [tuple(r) for r in df.orderBy("pos").select("id", "name", "flag", "score", "note").collect()]
    assert got == [
        (1, 'a "b"\nc', True, 1.5, None),
        (2, None, False, 2.0, "x"),
        (3, "plain", None, None, None),
    ]
    keys = json.loads(files.load(spark, str(tmp_path / "a.csv")).orderBy("pos").first().sample)
    assert list(keys) == ["id", "name", "flag", "score", "note"] and keys["note"] is None


def test_detection(spark, tmp_path):
    assert files.detect_format(spark, "x/Y.JSONL") == "jsonl"
    assert files.detect_format(spark, "x/y.Csv") == "csv"
    for text, want in [
        ('{"a":1}\n{"a":2}\n', "jsonl"), ('[{"a":1}]', "json"), ('{\n"a":1}', "json"),
        ("a,b\n1,2\n", "csv"), ("", "csv"),
    ]:
        assert files.detect_format(spark, put(tmp_path, f"f{abs(hash(text))}", text)) == want
    assert files.detect_format(spark, str(tmp_path / "absent")) == "json"
    with pytest.raises(ValueError):
        files.load(spark, put(tmp_path, "f.xml", "x"), "xml")


def test_load_many_and_merge(spark, tmp_path):
    one = put(tmp_path, "one.jsonl", '{"a":1}\n{"_source":"old","b":[2, 1]}\n{}\n')
    two = put(tmp_path, "two.json", json.dumps({"data": [{"c": 3}]}))
    df = files.load_many(spark, [one, two])
    assert loaded(df) == [
        {"a": 1, "_source": one}, {"b": [2, 1], "_source": one}, {"_source": one},
        {"c": 3, "_source": two},
    ]
    assert [r._source for r in df.orderBy("pos").collect()] == [one, one, one, two]
    with pytest.raises(ValueError):
        files.load_many(spark, [one, two], ["jsonl"])
    merged = loaded(files.merge(spark, [two, one]))
    assert merged == [{"data": [{"c": 3}]}, {"a": 1}, {"_source": "old", "b": [2, 1]}, {}]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "é\n\"x\", 'y' ", [1, 2], None), (2, " padded ", [], "v")],
        "id BIGINT, text STRING, list ARRAY<INT>, gone STRING",
    )
    writers.write_jsonl(df, str(tmp_path / "a.jsonl"))
    assert sorted(loaded(files.load(spark, str(tmp_path / "a.jsonl"))), key=str) == [
        {"id": 1, "text": "é\n\"x\", 'y' ", "list": [1, 2], "gone": None},
        {"id": 2, "text": " padded ", "list": [], "gone": "v"},
    ]
    writers.write_csv(df, str(tmp_path / "a.csv"))
    back = files.read_csv(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert [(r.id, r.text, r.list, r.gone) for r in back] == [
        (1, "é\n\"x\", 'y' ", "[1,2]", None),
        (2, " padded ", "[]", "v"),
    ]
    raw = files.load(spark, str(tmp_path / "a.jsonl")).select("sample")
    writers.write_jsonl(raw, str(tmp_path / "raw.jsonl"))
    assert files.load(spark, str(tmp_path / "raw.jsonl")).count() == 2


def test_prompts_from_a_loaded_file(spark, tmp_path):
    path = put(tmp_path, "qa.json", json.dumps(QA, ensure_ascii=False, indent=2))
    got = with_prompt(files.load(spark, path)).orderBy("pos").collect()
    assert [r.prompt for r in got] == [
        f"问题：{x['question']}\n请提供详细的回答。" for x in QA
    ]


def test_json_lines_folder_named_json_is_read_back(spark, tmp_path):
    rows = spark.range(50).selectExpr("id", "concat('text ', id) AS text")
    path = str(tmp_path / "rows.json")
    writers.write_json(rows, path)
    assert files.load(spark, path).count() == 50


@pytest.mark.parametrize("tail", [" x", '{"b":2}', "]", "}", ',"b":2', ",1"])
def test_text_after_a_value_is_an_error(spark, tmp_path, tail):
    for name in ("a.jsonl", "a.json"):
        path = put(tmp_path, name, '{"a":1}' + tail)
        with pytest.raises(PySparkException):
            files.load(spark, path).collect()


def test_positions_follow_files_not_their_sizes(spark, tmp_path):
    """Spark packs large files first; positions go by name."""
    folder = tmp_path / "rows.jsonl"
    folder.mkdir()
    at = 0
    for i, n in enumerate((3, 400, 50, 900)):
        lines = [json.dumps({"n": k, "pad": "x" * 50}) for k in range(at, at + n)]
        (folder / f"part-{i}.txt").write_text("\n".join(lines) + "\n")
        at += n
    rows = files.load(spark, str(folder)).collect()
    assert sorted((r.pos, json.loads(r.sample)["n"]) for r in rows) == [(k, k) for k in range(at)]
