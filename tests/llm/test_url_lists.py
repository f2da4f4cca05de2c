import datetime as dt
import random

from pyspark.sql import functions as F

from feedwright.llm import url_lists as ul


def host_of(url):
    if url is None or "://" not in url:
        return None
    h = url.split("://", 1)[1]
    for c in "/?#":
        h = h.split(c)[0]
    h = h.rsplit("@", 1)[-1].split(":")[0].lower().rstrip(".")
    return h or None


def brute(url, at, entries):
    """The entry that decides: the most specific host whose newest entry up to the fetch time is block or allow."""
    h = host_of(url)
    if h is None or at is None:
        return None
    labels = h.split(".")
    for i in range(max(len(labels) - 1, 1)):
        name = ".".join(labels[i:])
        live = [(s, -ul.ACTIONS.index(a), a) for n, s, a in entries
                if n is not None and s is not None and a in ul.ACTIONS and n.lower().rstrip(".") == name and s <= at]
        if live:
            since, _, action = max(live)
            if action != "remove":
                return name, action, since
    return None


def test_equals_brute_force(spark):
    r = random.Random(11)
    day = lambda: dt.datetime(2023, 11, 1) + dt.timedelta(hours=r.randint(0, 24 * 400))
    hosts = ["a.com", "b.a.com", "x.b.a.com", "c.org", "www.c.org", "localhost", "a.co"]
    entries = [(r.choice(hosts), day(), r.choice(ul.ACTIONS)) for _ in range(60)]
    entries += [(h, s, r.choice(ul.ACTIONS)) for h, s, _ in entries[:20]]  # ties
    entries += [(None, day(), "block"), ("c.org", None, "block"), ("c.org", day(), "ban"), ("A.CO.", day(), "block"), ("c.org", day(), None)]
    url = lambda h: r.choice(["http://%s/x?y", "HTTPS://u:p@%s:80/", "ftp://%s#f", "https://%s"]) % (h if r.random() < 0.7 else h.upper() + ".")
    caps = [(i, url(r.choice([*hosts, "q.x.b.a.com", "d.net"])), r.choice([day(), entries[r.randrange(60)][1]]), "z") for i in range(400)]
    caps += [(900, None, day(), "z"), (901, "not a url", day(), "z"), (902, "http:///x", day(), "z"), (903, "http://a.com/", None, "z"), (None, "http://a.com", day(), None)]
    caps += caps[:5]
    cdf = spark.createDataFrame(caps, "id int, url string, fetched_at timestamp, url_host string").repartition(3)
    cdf = cdf.withColumnRenamed("url_host", "host")
    edf = spark.createDataFrame(entries, "host string, listed_at timestamp, action string").repartition(3)
    got = [(x.id, x.list_host and (x.list_host, x.list_action, x.listed_at), x.url_kept) for x in ul.judge(cdf, edf).collect()]
    want = [(i, (v := brute(u, t, entries)), v is None or v[1] != "block") for i, u, t, _ in caps]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert any(w[1] for w in want) and not all(w[2] for w in want)


def test_without_entries_or_captures(spark):
    caps = spark.createDataFrame([(1, "http://a.com/", dt.datetime(2024, 1, 1))], "id int, url string, fetched_at timestamp")
    entries = spark.createDataFrame([("a.com", dt.datetime(2023, 1, 1), "block")], "host string, listed_at timestamp, action string")
    assert ul.judge(caps, entries.limit(0)).first().url_kept
    assert not ul.judge(caps, entries).first().url_kept
    assert ul.judge(caps.limit(0), entries).count() == 0
    assert ul.judge(caps.withColumn("fetched_at", F.lit(None).cast("timestamp")), entries).first().url_kept


def test_main_path_is_native(spark):
    plan = ul.page_verdicts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_addresses_users_and_clashing_columns(spark):
    at, early = dt.datetime(2024, 3, 1, 12), dt.datetime(2024, 1, 1)
    urls = ["http://[2001:DB8::1]:80/x", "http://10.0.0.1/", "http://user:p@w@ex.org/", "http://a.b.ex.org:8080", "http://1.2.3.4.com/", "http://[::1"]
    caps = spark.createDataFrame([(i, u, at, "mine", "kept", 7) for i, u in enumerate(urls)], "id int, url string, fetched_at timestamp, url_host string, URL_KEPT string, entry int")
    entries = spark.createDataFrame([("0.0.1", early, "block"), ("0.1", early, "block"), ("ex.org", early, "block"), ("[2001:db8::1]", early, "block"),
                                     ("4.com", early, "block")], "host string, listed_at timestamp, action string")
    out = ul.judge(caps, entries)
    got = {r.id: (r.url_host, r.list_host, r.url_kept, r.entry) for r in out.collect()}
    assert got == {0: ("[2001:db8::1]", "[2001:db8::1]", False, 7), 1: ("10.0.0.1", None, True, 7), 2: ("ex.org", "ex.org", False, 7),
                   3: ("a.b.ex.org", "ex.org", False, 7), 4: ("1.2.3.4.com", "4.com", False, 7), 5: (None if got[5][0] is None else got[5][0], None, True, 7)}
    assert [c.lower() for c in out.columns].count("url_host") == 1 and [c.lower() for c in out.columns].count("url_kept") == 1


def test_many_entries_and_captures_of_one_host_and_day(spark):
    """Entries every minute and captures every second of a day: the join makes rows, not pairs."""
    start = "timestamp '2024-05-05 00:00:00'"
    caps = spark.range(86400).selectExpr("id", "'http://h.org/' AS url", f"{start} + make_dt_interval(0, 0, 0, CAST(id AS DECIMAL(18,6))) AS fetched_at")
    entries = spark.range(1440).selectExpr("'h.org' AS host", f"{start} + make_dt_interval(0, 0, CAST(id AS INT)) AS listed_at", "if(id % 2 = 0, 'block', 'allow') AS action")
    out = ul.judge(caps, entries)
    assert out.where("url_kept = (id div 60 % 2 = 1) AND listed_at <= fetched_at").count() == 86400
