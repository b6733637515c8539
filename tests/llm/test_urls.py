import datetime as dt
import re

from llm_cases import plan
from registry.compare import connect

from caskline.llm.queries import QUERIES, SQL
from caskline.llm.urls import filter_as_of, validity_intervals

ENTRY = "key string, since date, verdict string, rank int"
day = dt.date.fromisoformat


def entries(spark, rows):
    return spark.createDataFrame([(k, None if s is None else day(s), v, 1) for k, s, v in rows], ENTRY)


def test_intervals(spark):
    rows = [("h:a", "2020-01-05", "block"), ("h:a", "2020-01-05", "allow"), ("h:a", "2020-02-01", "remove"), ("h:a", "2020-03-01", "allow"),
            (None, "2020-01-01", "block"), ("h:b", None, "block"), ("h:b", "2020-01-01", "odd"), ("h:a", "2020-01-05", "block")]
    got = {tuple(r) for r in validity_intervals(entries(spark, rows)).collect()}
    assert got == {("h:a", "block", day("2020-01-05"), day("2020-02-01")), ("h:a", "allow", day("2020-03-01"), None)}


def test_as_of(spark):
    lists = entries(spark, [("h:x.com", "2020-01-10", "block"), ("h:x.com", "2020-02-10", "remove"), ("d:org", "2020-01-01", "block"),
                            ("p:w.org/ok", "2020-01-01", "allow"), ("d:a.org", "2020-06-01", "allow")])
    cases = [
        ("http://x.com/p", "2020-01-09", None, True),
        ("http://x.com/p", "2020-01-10", "block", False),
        ("HTTP://u@X.com:80", "2020-02-09", "block", False),
        ("http://x.com/p", "2020-02-10", None, True),
        ("http://w.org/no", "2020-02-10", "block", False),
        ("http://w.org/ok/1", "2020-02-10", "allow", True),
        ("http://b.a.org/", "2020-02-10", "block", False),
        ("http://b.a.org/", "2020-07-10", "allow", True),
        ("http://b.a.org/", None, None, True),
        (None, "2020-01-09", None, True),
        ("no url", "2020-01-09", None, True),
        ("", "2020-01-09", None, True),
    ]
    rows = [(k, u, None if d is None else day(d), "x", 5) for k, (u, d, _, _) in enumerate(cases)] * 2
    captures = spark.createDataFrame(rows, "id int, url string, fetched date, _url string, key int")
    found = filter_as_of(captures, lists)
    assert not re.search("Python|Pandas|Arrow", plan(found))
    got = found.collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r.verdict, r.kept) == cases[r.id][2:]
    assert filter_as_of(captures.limit(0), lists).count() == 0
    assert filter_as_of(captures, lists.limit(0)).where("kept").count() == 2 * len(cases)


def test_equals_sql(spark, sf_dir):
    con = connect(sf_dir)
    for key in ("op5_url_lists", "op4_warc"):
        rows = sorted(map(str, con.execute(f"SELECT * FROM ({SQL[key]}) ORDER BY ALL").fetchall()))
        df = QUERIES[key](spark, sf_dir)
        columns = [c[0] for c in con.execute(f"SELECT * FROM ({SQL[key]}) LIMIT 0").description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == rows
