import random

from habiflow.llm.warc import canonical_url, resolve_revisits

SCHEMA = "record_id long, kind string, url string, at long, headers map<string,string>, body string, extra int"


def test_op10_as_of_validators_and_headers(spark):
    rows = [(1, "response", "http://www.A.com:80/x/", 1, {"etag": "e1", "server": "s", "date": "d1"}, "one", 0),
            (2, "response", "https://a.com/x", 5, {"etag": "e2"}, "two", 0),
            (3, "revisit", "http://a.com/x#top", 3, {"etag": "W/e1", "date": "d3", "server": "no"}, None, 0),
            (4, "revisit", "http://a.com/x", 9, {"etag": "e1"}, None, 0),
            (5, "revisit", "http://b.com/", 9, {"etag": "e1"}, None, 0),
            (6, "response", None, 1, {"last-modified": "m"}, "null url", 0),
            (7, "revisit", None, 2, {"last-modified": "m"}, None, 0),
            (8, "revisit", "http://a.com/x", 9, None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["record_id"]: (r["response_id"], r["headers"], r["body"]) for r in resolve_revisits(df).collect()}
    assert got[3] == (1, {"etag": "W/e1", "date": "d3", "server": "s"}, "one")
    assert got[7][0] == 6 and got[7][2] == "null url"
    assert all(got[k] == (None, None, None) for k in (4, 5, 8))
    assert resolve_revisits(df.limit(0)).count() == 0


def test_op10_one_url_in_many_slices_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        kind = rng.choice(["response", "revisit"])
        url = rng.choice(["http://hot.com/a"] * 8 + ["http://b.com/", None])
        at = rng.choice([None, *range(200), *[77] * 30])
        rows.append((i, kind, url, at, {"etag": rng.choice("xy")}, f"body {i}" if kind == "response" else None, 0))
    rows += [r for r in rows if r[0] % 50 == 0]  # repeated rows
    rows += [(None, "response", "http://hot.com/a", 150, {"etag": "x"}, "no id", 0)]
    want = []
    for rid, kind, url, at, headers, _, _ in rows:
        if kind != "revisit":
            continue
        before = [] if at is None else [(r[3], r[0], r) for r in rows if r[1] == "response" and r[0] is not None
                                        and r[2] == url and r[3] is not None and r[3] < at]
        of = max(before, key=lambda t: t[:2])[2] if before else None
        ok = of is not None and of[4]["etag"] == headers["etag"]
        want.append((rid, of[0] if ok else -1, of[5] if ok else ""))
    df = spark.createDataFrame(rows, SCHEMA)
    for slices in (1, 16):
        got = [(r["record_id"], -1 if r["response_id"] is None else r["response_id"], r["body"] or "")
               for r in resolve_revisits(df, slices).collect()]
        assert sorted(got) == sorted(want)


def test_op10_canonical_url(spark):
    df = spark.createDataFrame([(" HTTPS://WWW.A.com:443/B/?q=1#x",), ("a.com",), (None,)], "u string")
    assert [r[0] for r in df.select(canonical_url(df["u"])).collect()] == ["a.com/B/?q=1", "a.com", ""]
