"""Documents and tables cut at every position give the same rows as read whole."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from turnmill.sources import blocks, files


@pytest.fixture
def block_size(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def loaded(spark, path, **options):
    rows = files.load(spark, path, "json", **options).orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(len(rows)))
    return [json.loads(r.sample) for r in rows]


HARD = [
    {"a": 'x",]}[{\\', "b": [1, [2, {"c": ","}], []], "é": "日本,语"},
    {},
    {"q": "\\\\\\\"", "n": None, "deep": {"data": [1, 2], "e": {}}},
    {"a": "}],[{", "b": '\\"', "c": "\\"},
]


def batch(rows, kinds, names):
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def json_parts(groups):
    """The numbered parts of a document whose pieces lie in these blocks, put together."""
    kinds, names = [pa.string(), pa.int64(), pa.binary()], ["f", "b", "value"]
    rows = [("f", b, v) for b, group in enumerate(groups) for v in group]
    found = [r for x in blocks._json_summary([batch(rows, kinds, names)]) for r in x.to_pylist()]
    kind = next((r["opens"] for r in found if r["opens"]), None)
    inside, depth, states = 0, 0, {}
    for r in found:
        states[r["_block"]] = (inside, depth, kind, r is found[-1])
        inside, depth = (inside + r["parity"]) % 2, depth + r["gain_in" if inside else "gain_out"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    rows = [("f", b, *states[b], v) for _, b, v in rows]
    # In two batches, so that a batch may end in a block.
    batches = [batch(rows[:3], kinds, list("abcdefg")), batch(rows[3:], kinds, list("abcdefg"))]
    parts, first, out = {}, 0, {}
    for x in blocks._json_parts(iter(batches)):
        for r in x.to_pylist():
            parts.setdefault(r["_block"], []).append(r)
    for _, own in sorted(parts.items()):
        for r in own:
            number = first + r["i"]
            assert (number in out) == r["head"]
            level, text = out.get(number, (r["level"], b""))
            out[number] = level, text + r["value"]
        first += sum(not r["tail"] for r in own)
    assert sorted(out) == list(range(len(out)))
    return [out[i] for i in range(len(out))]


SHAPES = {
    "list": (json.dumps(HARD), HARD),
    "list_tight": (json.dumps(HARD, separators=(",", ":"), ensure_ascii=False) + "\n", HARD),
    "wrapper": (json.dumps({"v": [1, {"x": ","}], "data": HARD, "w": "data"}), HARD),
    "wrapper_first": (json.dumps({"data": HARD, "w": {"data": [3, 4]}}, separators=(",", ":")), HARD),
    "wrapper_only": ("\ufeff \n" + json.dumps({"data": HARD}, ensure_ascii=False), HARD),
    "single": (json.dumps({"x": HARD, "y": "a,b", "z": {"k": [1, 2]}}), [{"x": HARD, "y": "a,b", "z": {"k": [1, 2]}}]),
    "empty": (" [ ] ", []),
    "empty_data": ('{"a":1,"data":[ ],"b":[2,3]}', []),
    "no_list": ('{"data":{"x":1,"y":2}}', []),
    "one": ('[{"a":1}]', [{"a": 1}]),
}


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_json_parts_at_every_cut(name):
    """A block ends after any piece, after every piece, and at random."""
    found = SHAPES[name][0].encode().split(b",")
    whole = json_parts([found])
    assert b",".join(x for _, x in whole) == b",".join(found)
    rng = random.Random(1)
    for i in range(1, len(found)):
        assert json_parts([found[:i], found[i:]]) == whole
    assert json_parts([[x] for x in found]) == whole
    for _ in range(40):
        ends = sorted(rng.sample(range(len(found) + 1), rng.randrange(1, min(5, len(found) + 1))))
        groups = [found[x:y] for x, y in zip([0, *ends], [*ends, len(found)]) if y > x]
        assert json_parts(groups) == whole


@pytest.mark.parametrize(
    "size, names", [(60, ["list", "wrapper", "wrapper_first", "single"]), (100_000, sorted(SHAPES))]
)
def test_json_in_blocks(spark, tmp_path, block_size, size, names):
    block_size(size)
    for name in names:
        text, want = SHAPES[name]
        assert loaded(spark, put(tmp_path, f"{name}{size}.json", text)) == want, name


def test_random_documents(spark, tmp_path, block_size):
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 2:
            return "".join(rng.choice('ab",\\[]{}:é\n') for _ in range(rng.randrange(8)))
        if kind < 4:
            return rng.choice([1, -2, True, None])
        if kind == 4:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {f"k{i}" if rng.random() < 0.8 else f'",{i}': value(depth - 1) for i in range(rng.randrange(4))}

    for i in range(2):
        rows = [{"i": n, "v": value(3)} for n in range(rng.randrange(1, 12))]
        doc = rows if i % 2 else {"a": value(2), "data": rows, "b": value(2)}
        block_size(rng.choice([29, 61]))
        assert loaded(spark, put(tmp_path, f"r{i}.json", json.dumps(doc, separators=rng.choice([None, (",", ":")])))) == rows


@pytest.mark.parametrize(
    "text",
    ["[1,2", "[1,,2]", "[1,2] x", '{"a":1,"a":2}', '{"data":[1],"data":[2]}'],
)
def test_bad_documents_are_errors(spark, tmp_path, block_size, text):
    block_size(6)
    with pytest.raises(PySparkException):
        loaded(spark, put(tmp_path, "bad.json", text))


def test_many_documents_in_a_folder(spark, tmp_path, block_size):
    folder = tmp_path / "docs.json"
    folder.mkdir()
    for i, doc in enumerate([HARD[:2], {"data": HARD[2:]}, {"single": 1}, [], HARD]):
        put(folder, f"{i}.json", json.dumps(doc))
    block_size(40)
    assert loaded(spark, str(folder)) == [*HARD, {"single": 1}, *HARD]
    merged = files.merge(spark, [str(folder)]).orderBy("pos").collect()
    assert [json.loads(r.sample) for r in merged] == [*HARD[:2], {"data": HARD[2:]}, {"single": 1}, *HARD]


def test_too_many_blocks_to_send(spark, tmp_path, block_size, monkeypatch):
    monkeypatch.setattr(blocks, "BROADCAST_BLOCKS", 0)
    block_size(60)
    assert loaded(spark, put(tmp_path, "a.json", json.dumps(HARD))) == HARD


def test_compact_document_is_read_by_many_tasks(spark, tmp_path, block_size):
    rows = [{"i": i, "text": "word, " * 30} for i in range(4000)]
    path = put(tmp_path, "big.json", json.dumps({"data": rows}))
    block_size(100_001)
    parts = blocks.pieces(spark, path, ",").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 5 and loaded(spark, path) == rows


def table(rng, rows):
    cells = ["", "a", "1", "x,y", 'say "hi"', "two\nlines", '\n"\n', "é\r\nü", ",", '""', "plain text", " pad "]
    return [[str(i), *[rng.choice(cells) for _ in range(3)]] for i in range(rows)]


@pytest.mark.parametrize("size, end", [(41, "\n"), (59, "\r\n"), (100_000, "\n")])
def test_csv_cut_everywhere(spark, tmp_path, block_size, size, end):
    rows = table(random.Random(size), 25)
    text = io.StringIO()
    csv.writer(text, lineterminator=end).writerows([["id", "b", "a b", "c.d"], *rows])
    block_size(size)
    df = files.read_csv(spark, put(tmp_path, f"t{size}.csv", text.getvalue()))
    got = [tuple(r) for r in df.orderBy("pos").drop("pos").collect()]
    assert got == [(int(i), *[x or None for x in rest]) for i, *rest in rows]
    assert [r.pos for r in df.orderBy("pos").collect()] == list(range(25))


def test_csv_shapes(spark, tmp_path, block_size):
    block_size(15)
    odd = 'a,b\n\n5" disk,x"y\n"open ""q""" ,1\n\n"z",\n"last",3'
    got = files.read_csv(spark, put(tmp_path, "odd.csv", odd)).orderBy("pos").drop("pos").collect()
    assert [tuple(r) for r in got][:1] == [('5" disk', 'x"y')] and len(got) == 4 and tuple(got[3]) == ("last", "3")
    assert files.read_csv(spark, put(tmp_path, "h.csv", "a,b\n")).count() == 0
    folder = tmp_path / "many.csv"
    folder.mkdir()
    put(folder, "1.csv", "a,b\n1,\"x\ny\"\n")
    put(folder, "2.csv", "a,b\n2,z\n3,\"\n\"\n")
    rows = files.read_csv(spark, str(folder)).orderBy("pos").collect()
    assert [(r.a, r.b) for r in rows] == [(1, "x\ny"), (2, "z"), (3, "\n")]


def test_line_states():
    for line, out, inside in [
        (b"a,b", False, True), (b'"a', True, False), (b'a"b', False, False), (b'x,"', True, False),
        (b'"a""', True, False), (b'""', False, True), (b'"",""', False, True), (b'",",', False, True),
    ]:
        assert (blocks.ends_inside(line, False), blocks.ends_inside(line, True)) == (out, inside), line


def test_csv_states_at_every_cut():
    """Two blocks at every line: the state that the first leaves is the one that holds."""
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows(table(random.Random(8), 30))
    lines = text.getvalue().encode().split(b"\n")
    state, states = False, []
    for line in lines:
        states.append(state)
        state = blocks.ends_inside(line, state)
    kinds, names = [pa.string(), pa.int64(), pa.binary()], ["f", "b", "value"]
    for i in range(1, len(lines)):
        rows = [("f", 0, x) for x in lines[:i]] + [("f", 1, x) for x in lines[i:]]
        found = [r for x in blocks._csv_summary([batch(rows, kinds, names)]) for r in x.to_pylist()]
        assert found[0]["out"] == states[i] and found[1]["in" if states[i] else "out"] == state
