import datetime
import random
import re

from pyspark.sql import functions as F

from conftest import line
from loglark.functions import parsing

BASE = 'h.example - - [01/Jul/1995:00:00:01 -0400] "GET /x HTTP/1.0" 200 6245'

CASES = [
    (BASE, 6245),
    (BASE.replace("6245", "-"), 0),
    (BASE.replace("6245", "2147483647"), 2147483647),
    (BASE.replace("6245", "2147483648"), None),
    (BASE.replace("6245", "00000000000012"), 12),
    (BASE.replace("6245", "-5"), None),
    (BASE + " ", None),
    (BASE + "\r", None),
    (BASE + "\u0085", None),
    (BASE + "\n", None),
    ("x" + BASE + "\n" + BASE, None),
    (BASE.replace(" HTTP/1.0", ""), None),
    (BASE.replace("GET", "get"), None),
    (BASE.replace("6245", "١٢"), None),
    (BASE.replace(" - - ", "\t-\t- "), 6245),
    (BASE.replace("h.example", "a,bé\u0001c"), 6245),
    (BASE.replace("01/Jul/1995:00", "99/Xyz/0000:99").replace("200", "999"), 6245),
    ("", None),
    ("a\tb\tc\td\te\tf\t1\t2", None),
    (None, None),
]


def test_verdicts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, value string")
    rows = parsing.parse_logs(df).orderBy("i").collect()
    for row, (text, size) in zip(rows, CASES, strict=True):
        assert row.is_valid == (size is not None), text
        assert row.bytes == size, text
        if size is None:
            assert row.host is None and row.status_code is None
    kept = parsing.valid_logs(df, keep=("i",)).orderBy("i").collect()
    assert [r.i for r in kept] == [r.i for r in rows if r.is_valid]
    fields = list(parsing.FIELDS)
    assert [r[1:] for r in kept] == [tuple(r[f] for f in fields) for r in rows if r.is_valid]
    assert kept[0][1:] == ("h.example", "01/Jul/1995", 0, "GET", "/x", "HTTP/1.0", 200, 6245)
    bad = parsing.malformed_logs(df).orderBy("i")
    assert bad.columns == df.columns
    assert [r.i for r in bad.collect()] == [r.i for r in rows if not r.is_valid]


def test_sql_function_agrees(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, value string")
    parsing.register_sql_functions(spark)
    got = df.selectExpr("i", "parse_log(value) AS p").where("p IS NOT NULL").select("i", "p.*")
    want = parsing.valid_logs(df, keep=("i",))
    assert sorted(got.collect()) == sorted(want.collect())


PYTHON_PATTERN = re.compile(parsing.LOG_PATTERN.replace(r"\z", r"\Z"), re.ASCII)
TOKENS = [*' -[]":/\t\r\n+,.0129', "h1", "[01/Jul/1995:00:00:01 -0400]", "GET", "HTTP/1.0", "200", "é"]
PARTS = [
    ["h1", "a,b", "h 1", "", "é"],
    [" - - ", "\t-\t-  ", " -  ", " x y ", "--"],
    ["[01/Jul/1995:00:00:01 -0400]", "[32/___/0000:77:88:99 +9999]", "[1/Jul/1995:00:00:01 -0400]"],
    [" ", "  ", "\x0b", ""],
    ['"GET /a HTTP/1.0"', '"GET  /"\tHTTP/1.1.9"', '"GET HTTP/1.0"', '"get /a HTTP/1.0"', '"A b HTTP/"'],
    [" 200 5", " 200 -", " 200  2147483647", " 200 2147483648", " 20 5", " 200 5 ", " 200 5\n", " 200 5\r"],
]


def test_against_plain_matching(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices(TOKENS, k=rng.randint(0, 14))) for _ in range(300)]
    texts += ["".join(map(rng.choice, PARTS)) for _ in range(9000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, value string")
    got = {r.i: r for r in parsing.parse_logs(df).collect()}
    valid = 0
    for i, text in enumerate(texts):
        m = PYTHON_PATTERN.match(text)
        ok = bool(m) and (m[8] == "-" or int(m[8]) <= 2**31 - 1)
        assert got[i].is_valid == ok, repr(text)
        if ok:
            valid += 1
            want = (*m.groups()[:2], int(m[3]), *m.groups()[3:6], int(m[7]), 0 if m[8] == "-" else int(m[8]))
            assert tuple(got[i][f] for f in parsing.FIELDS) == want
    assert 100 < valid < 1500


def test_log_dates(spark):
    cases = {
        "01/Jul/1995": datetime.date(1995, 7, 1),
        "01/JUL/1995": datetime.date(1995, 7, 1),
        "32/Jul/1995": datetime.date(1995, 8, 1),
        "00/Jul/1995": datetime.date(1995, 6, 30),
        "31/Feb/1996": datetime.date(1996, 3, 2),
        "01/Xyz/1995": None,
        "1/Jul/1995": None,
        "": None,
        "01/Jul/1995 x": None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = df.select("t", parsing.to_log_date(F.col("t"))).collect()
    assert {r[0]: r[1] for r in got} == cases


def test_quality_measured_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, c[0]) for i, c in enumerate(CASES)], "batch_no int, value string")
    parsed = parsing.parse_logs(df)
    observed, seen = parsing.observe_quality(parsed)
    observed.write.parquet(str(tmp_path / "out"))
    per_batch = parsing.count_quality(parsed).collect()
    assert seen.get["total_records"] == len(CASES) == sum(r.total_records for r in per_batch)
    assert seen.get["valid_records"] == sum(r.valid_records for r in per_batch)
    assert all(r.valid_records + r.malformed_records == r.total_records for r in per_batch)
    totals, sample = parsing.parse_summary(df, sample=2)
    assert totals.first().malformed_records == seen.get["malformed_records"]
    assert sample.count() == 2 and sample.columns == ["log_date", "log_hour", "status_code", "bytes"]


def test_event_time_is_wall_clock_in_any_zone(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Kathmandu")
    texts = [line(time="28/Feb/1995:23:59:59"), line(time="32/Jul/1995:00:00:00"), line(time="01/Jul/1995:24:00:00")]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    t = parsing.event_time(F.col("value"))
    rows = df.select(parsing.clock_date(t), parsing.clock_hour(t)).collect()
    assert [tuple(r) for r in rows] == [("28/Feb/1995", 23), (None, None), (None, None)]
