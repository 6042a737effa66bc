import json

from pyspark.sql import functions as F

from turnmill.functions import samples as S
from turnmill.operators.formats import to_format
from turnmill.operators.quality import drop_exact_duplicates, keep_valid

ANSWER = "请提供详细的回答。"


def test_prompts(samples):
    cases = {
        '{"question":"q","answer":"a"}': f"问题：q\n{ANSWER}",
        '{"prompt":"p","instruction":"i"}': "指令：i\n请按照指令执行并提供详细的回答。",
        '{"prompt":"as is"}': "as is",
        '{"text":null}': "请基于以下内容进行扩展和详细说明：\nNone",
        '{"text":true}': "请基于以下内容进行扩展和详细说明：\nTrue",
        '{"text":"true"}': "请基于以下内容进行扩展和详细说明：\ntrue",
        '{"text":[1,"b",null,2.50]}': "请基于以下内容进行扩展和详细说明：\n[1, 'b', None, 2.5]",
        '{"text":1.50}': "请基于以下内容进行扩展和详细说明：\n1.5",
        '{"context":"c","question":"q"}': f"基于以下背景信息：c\n问题：q\n{ANSWER}",
        '{"context":"c"}': "基于以下背景信息进行分析和说明：\nc",
        '{"query":"x","task":7}': "请对以下内容进行详细分析和说明：\n7",
        '{"content":"first","input":"second"}': "请对以下内容进行详细分析和说明：\nfirst",
    }
    for odd in ('{"question":"q"}', '{"z":1,"a":{"y":[1,2],"b":"é\\n"}}', "{}"):
        whole = json.dumps(json.loads(odd), ensure_ascii=False, indent=2)
        cases[odd] = f"请基于以下信息进行分析和详细说明：\n{whole}"
    texts = list(cases)
    got = S.with_prompt(samples(texts)).orderBy("pos").collect()
    assert [r.prompt for r in got] == [cases[t] for t in texts]


def test_typed_prompt(spark):
    df = spark.createDataFrame([("q", "a", None)], "question STRING, answer STRING, text STRING")
    assert df.select(S.prompt_column(df.columns)).first()[0] == f"问题：q\n{ANSWER}"
    df = df.select("text")
    assert df.select(S.prompt_column(df.columns)).first()[0].endswith("：\nNone")


def test_continuation_needs_history(spark):
    df = spark.range(50).select(
        S.next_prompt(42, F.col("id"), F.lit(2), F.lit(0)).alias("none"),
        S.next_prompt(42, F.col("id"), F.lit(2), F.lit(1)).alias("some"),
    )
    rows = df.collect()
    assert {r.none for r in rows} == {""}
    assert {r.some for r in rows} == set(S.CONTINUATIONS)


def python_text(sample):
    """Independent model of the text of a sample."""
    if "conversations" in sample:
        said = [c[k] for c in sample["conversations"] for k in ("instruction", "output") if k in c]
        return " ".join(said)
    for pair in (("instruction", "output"), ("question", "answer"), ("prompt", "response")):
        if set(pair) <= set(sample):
            return " ".join(str(sample[k]) for k in pair)
    return " ".join(v for v in sample.values() if isinstance(v, str) and len(v) > 10)


def test_text_and_validity(samples):
    cases = [
        ('{"zeta":"first long text","alpha":"second long text"}', True),
        ('{"a":"0123456789","b":"0123456789x"}', True),
        ('{"a":"0123456789"}', False),
        ('{"conversations":[],"instruction":"i","output":"o"}', False),
        ('{"conversations":[{"instruction":"i","output":"o"},{"output":"p"}]}', False),
        ('{"conversations":[{"instruction":"i","output":"o"},{"instruction":"j","output":"p"}]}', True),
        ('{"conversations":[{"instruction":"i","output":" \\u3000"}]}', False),
        ('{"instruction":"i","output":"o"}', True),
        ('{"instruction":" ","output":"o"}', False),
        ('{"question":"why","answer":null}', False),
        ('{"question":"why so","answer":true}', True),
        ('{"prompt":"p","response":12345678}', True),
        ('{"n":12345678901234,"s":"\\u00a0\\u00a0 padded text \\u3000"}', True),
    ]
    df = samples([c for c, _ in cases])
    texts = [r.text for r in S.with_text(df).orderBy("pos").collect()]
    assert texts == [python_text(json.loads(c)) for c, _ in cases]
    flags = [r.valid for r in S.with_validity(df).orderBy("pos").collect()]
    assert flags == [ok for _, ok in cases]
    assert keep_valid(df).count() == sum(flags)


def test_non_objects_are_invalid(samples):
    df = S.with_validity(samples(["[1,2]", '"text that is long enough"', "5"]))
    assert not any(r.valid for r in df.collect())


def test_layouts_from_raw_samples(samples):
    df = samples(
        [
            '{"conversations":[{"instruction":"i1","output":"o1"},{"output":"o2"}],"id":"x"}',
            '{"conversations":[],"instruction":"i","output":"o","input":"in"}',
            '{"original_data":{"question":"q","answer":"a"}}',
            '{"original_data":{"question":"q"}}',
            '{"question":"q","answer":"a"}',
        ]
    )
    alpaca = to_format(df, "alpaca", "sample", "pos").orderBy("pos").collect()
    assert [tuple(r) for r in alpaca] == [
        (0, "i1", "", "o1"),
        (1, "i", "in", "o"),
        (2, "q", "", "a"),
    ]
    chat = to_format(df, "sharegpt", "sample", "pos").orderBy("pos").collect()
    assert [(c["from"], c["value"]) for c in chat[0].conversations] == [
        ("human", "i1"),
        ("gpt", "o1"),
        ("human", ""),
        ("gpt", "o2"),
    ]
    assert [r.id for r in chat] == ["x", "", ""]
    glm = to_format(df, "chatglm", "sample", "pos").orderBy("pos").collect()
    assert [(r.prompt, r.response, r.history) for r in glm][1] == ("i", "o", [])
    assert to_format(df, "other") is df


def test_exact_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (0, "b")], "pos BIGINT, text STRING")
    assert {r.pos for r in drop_exact_duplicates(df).collect()} == {0, 2}
