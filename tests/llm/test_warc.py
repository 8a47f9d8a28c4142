"""Revisit resolution against brute force."""

import random

from planscore.llm import warc_revisits as R

SCHEMA = ("record_id long, record_type string, url string, date long, "
          "headers map<string,string>, pid int, later int, canonical string")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)


def test_canonical_url(spark):
    pairs = [("HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#f", "example.com/a?a=1&b=2"),
             ("https://example.com:443", "example.com"), ("https://www2.e.org/A//", "e.org/A"),
             ("https://e.org/?", "e.org"), ("not a url", "not a url"), ("", ""), (None, None),
             ("http://e.org:8080/x", "e.org:8080/x")]
    df = spark.createDataFrame([(u, ) for u, _ in pairs], "u string")
    assert [r[0] for r in df.select(R.canonical_url(R.F.col("u"))).collect()] == [
        c for _, c in pairs]


def brute(rows):
    out = {}
    for i, kind, url, date, h in rows:
        h = {k.lower(): v for k, v in (h or {}).items()}
        if kind != "revisit":
            out[i] = (kind, i if kind == "response" else None, h)
            continue
        earlier = [(d, j, g) for j, k, u, d, g in rows if k == "response" and url is not None
                   and u == url and date is not None and d is not None and d < date]
        if not earlier:
            out[i] = ("no_earlier_response", None, h)
            continue
        _, j, g = max(earlier, key=lambda x: x[:2])
        g = {k.lower(): v for k, v in (g or {}).items()}
        etag, day = h.get("etag"), h.get("last-modified")
        if etag is None and day is None:
            out[i] = ("no_validator", None, h)
        elif (etag.removeprefix("W/") == (g.get("etag") or "").removeprefix("W/")
              if etag is not None else day == g.get("last-modified")):
            out[i] = ("resolved", j, g | {k: v for k, v in h.items() if k in R.PERMITTED})
        else:
            out[i] = ("validator_mismatch", None, h)
    return out


def test_as_of_join_matches_brute_force(spark):
    r = random.Random(6)
    rows = []
    for i in range(700):
        url = "http://hot/" if r.random() < 0.4 else r.choice(["http://a/", "http://b/", None])
        h = {"Content-Length": str(i), "Vary": "x"}
        if r.random() < 0.8:
            h["ETag"] = r.choice(['"1"', 'W/"1"', '"2"'])
        if r.random() < 0.5:
            h["Last-Modified"] = r.choice("pq")
        rows.append((i, "response" if r.random() < 0.2 else r.choice(
            ["revisit"] * 9 + ["request"]), url and url.rstrip("/"),
            r.randint(0, 150) if r.random() > 0.02 else None, h if r.random() > 0.05 else None))
    got = R.resolve_revisits(frame(spark, rows).repartition(9)).collect()
    assert len(got) == len(rows)
    want = brute([(i, k, u, d, h) for i, k, u, d, h in rows])
    for x in got:
        assert (x.status, x.source_id, x.headers) == want[x.record_id], x


def test_payload_repeats_and_empty_table(spark):
    rows = [(1, "response", "http://a/", 1, {"etag": '"t"'}),
            (2, "revisit", "http://a", 2, {"etag": '"t"'}),
            (2, "revisit", "http://a", 2, {"etag": '"t"'}),
            (3, None, None, None, None)]
    df = frame(spark, rows)
    out = R.resolve_revisits(df)
    assert out.count() == 4
    bodies = df.withColumn("body", R.F.lit("text"))
    got = R.with_payload(out, bodies, "body").collect()
    assert sorted((r.record_id, r.body) for r in got if r.record_id < 3) == [
        (1, "text"), (2, "text"), (2, "text")]
    assert R.resolve_revisits(df.limit(0)).count() == 0


def test_header_names_that_differ_in_case_only(spark):
    rows = [(1, "response", "http://a/", 1, {"ETag": "x", "etag": "y", "Set-Cookie": "a",
                                             "set-cookie": None, "SET-COOKIE": "b"}),
            (2, "revisit", "http://a/", 2, {"ETAG": "x, y"}),
            (3, "revisit", "http://a/", 3, {"ETag": "x", "eTag": "z"}),
            (4, "response", "http://b/", 1, {"A": None, "a": None}), (5, "response", "http://c/", 1,
                                                                      None)]
    df = frame(spark, rows)
    got = {r.record_id: r for r in R.resolve_revisits(df).collect()}
    assert got[1].headers == {"etag": "x, y", "set-cookie": "b, a"}
    assert got[2].status == "resolved" and got[2].source_id == 1
    assert got[3].status == "validator_mismatch"
    assert got[4].headers == {"a": None} and got[5].headers == {}
