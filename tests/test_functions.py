import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from catloom.functions import identity as I
from catloom.functions import text as X
from catloom.functions import times as M
from catloom.functions import variants as V
from catloom.session import configure


def values(spark, fn, texts):
    configure(spark)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("t")).alias("v")).collect())]


def expected_lenient(text):
    """The standard library's own reading of ISO text."""
    if not text:
        return None
    try:
        moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    micros = (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return int(micros / 1000) if micros < 0 else micros // 1000


def test_lenient_times_read_as_the_standard_library_does(spark):
    rng = random.Random(7)
    texts = [None, "", "x", "2024", "2024-02-30", "2024-01-15T", "0000-01-01", "2024-W53", "2020-W53-7", "20240115",
             "2024-01-15T24:00", "2024-01-15T10:00:60", "2024-01-15T10:00+24:00", "2024-01-15T10:0000", "1969-12-31T23:59:59.9999Z"]
    for _ in range(300):
        day = date(1950, 1, 1) + timedelta(days=rng.randrange(40000))
        y, w, d = day.isocalendar()
        head = rng.choice([day.isoformat(), day.strftime("%Y%m%d"), f"{y}-W{w:02d}-{d}", f"{y}W{w:02d}{d}", f"{y}-W{w:02d}"])
        h, m, s = rng.randrange(24), rng.randrange(60), rng.randrange(60)
        clock = rng.choice([f"{h:02d}", f"{h:02d}:{m:02d}", f"{h:02d}:{m:02d}:{s:02d}", f"{h:02d}{m:02d}{s:02d}",
                            f"{h:02d}:{m:02d}:{s:02d}.{rng.randrange(10**6):06d}", f"{h:02d}:{m:02d}:{s:02d},5", f"{h:02d}:{m:02d}:{s:02d}.1234567"])
        zone = rng.choice(["", "Z", "+02:00", "-0530", "+01", "+00:00:30"])
        texts.append(rng.choice([head, head + rng.choice("T _") + clock + zone]))
    assert values(spark, M.iso_millis, texts) == [expected_lenient(t) for t in texts]


def test_strict_times_take_four_layouts(spark):
    def expected(text):
        for layout in ("%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S"):
            try:
                moment = datetime.strptime(text, layout)
            except (ValueError, TypeError):
                continue
            moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
            return (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(milliseconds=1)
        return None

    texts = ["2024-03-04T11:22:33.456Z", "2024-03-04T11:22:33Z", "2024-03-04T11:22:33+02:00", "2024-03-04T11:22:33+0230",
             "2024-03-04T11:22:33.1", "2024-3-4T1:2:3", "2024-03-04", "2024-03-04 11:22:33", "1709551353", "", None,
             "2024-02-30T00:00:00", "2024-03-04T11:22:33+01:0203"]
    assert values(spark, M.iso_millis_strict, texts) == [expected(t) for t in texts]


@pytest.mark.parametrize("fn, cases", [
    (X.unquote_ident, {'"a"': "a", "`a`": "a", '"a`': '"a`', '"': '"', '""': "", "a": "a", "": "", '""a""': '"a"', '"a\nb"': "a\nb"}),
    (X.vendor_name, {"dbSnowflake": "snowflake", "DBDB": "db", "postgres": "postgres", "": ""}),
    (X.last_segment, {"a/b/3": "3", "3": "3", "a/": ""}),
    (I.root_key, {"0": "root", "": "root", "7": "7", "root": "root"}),
    (I.engine_name, {"bigquery-cloud-sdk": "bigquery", "redshift": "redshift"}),
    (X.strip_html, {"<p>a &amp;lt; b</p>": "a &lt; b", "a &lt;b&gt;": "a <b>", "&nosuch; &#65;": "&nosuch; A", "": ""}),
])
def test_text_functions(spark, fn, cases):
    assert values(spark, fn, list(cases)) == list(cases.values())


def test_truncation_keeps_the_limit(spark):
    a, b = values(spark, X.truncate_name, ["x" * 10000, "x" * 10001])
    assert a == "x" * 10000 and b == "x" * 9999 + "…"


def test_dotted_names(spark):
    got = values(spark, X.dotted_name, ["a.b.c.d", "a.b", "a", "", 'x."y.z"'])
    assert [tuple(r) for r in got] == [("a", "b", "c.d"), ("", "a", "b"), ("", "", "a"), ("", "", ""), ("x", '"y', 'z"')]


def test_values_that_count_as_nothing(spark):
    def given(c):
        return V.given(V.parse(c), "$.a", "$.b")

    texts = ['{"a":0,"b":"x"}', '{"a":"0","b":"x"}', '{"a":[],"b":{}}', '{"a":false}', '{"a":"false"}', '{"a":"","b":null}',
             '{"a":"[]"}', '{"a":5}', "7", '{"a":0.0,"b":1.5}']
    assert values(spark, given, texts) == ["x", "0", None, None, "false", None, "[]", "5", None, "1.5"]


def test_numbers_as_times(spark):
    def ms(c):
        return M.variant_millis(V.at(V.parse(c), "$.a", "variant"))

    texts = ['{"a":1709551353456}', '{"a":12.9}', '{"a":-12.9}', '{"a":true}', '{"a":null}', "{}", '{"a":"2024-01-01"}', '{"a":[1]}']
    assert values(spark, ms, texts) == [1709551353456, 12, -12, 1, None, None, 1704067200000, None]


def test_a_repeated_json_key_keeps_its_last_value(spark):
    assert values(spark, lambda c: V.at(V.parse(c), "$.a"), ['{"a":1,"a":2}']) == ["2"]


def test_references_equal_the_standard_library(spark):
    """Random references, whole and broken, against the decoder of the standard library."""
    import html
    import random
    from html.entities import html5

    draw = random.Random(3)
    names = sorted(html5)
    parts = [
        lambda: "&" + draw.choice(names),
        lambda: "&" + draw.choice(names).rstrip(";") + draw.choice(["", ";", "x", "1;", " ", "=", "é;"]),
        lambda: "&" + draw.choice(names)[: draw.randint(1, 6)],
        lambda: f"&#{draw.choice([draw.randrange(300), draw.randrange(0x120000), 65279, 65534, 0x1FFFE, 10**20])}" + draw.choice(["", ";"]),
        lambda: f"&#{draw.choice('xX')}{draw.choice([draw.randrange(300), draw.randrange(0x120000), 0xFEFF, 0xD800, 16**9]):0{draw.randint(1, 9)}x}" + draw.choice(["", ";", "g"]),
        lambda: draw.choice(["&", "&&", "&#", "&#x", "&;", "&#;", "a b", "\U0001f600", "&\U0001f600amp;", "&amp;lt;", "\n", "&" + "n" * 40 + ";", "$1\\"]),
    ]
    texts = ["".join(draw.choice(parts)() for _ in range(draw.randint(1, 6))) for _ in range(4000)] + ["&" + n for n in names] + [f"&#{n};" for n in range(260)]
    frame = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").coalesce(4)
    decoded = frame.select("text", X.decode_references(F.col("text")).alias("got"))
    for row in decoded.collect():
        assert row.got == (None if row.text is None else html.unescape(row.text)), row.text
    plan = frame.select(X.strip_html(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "from_json" not in plan
