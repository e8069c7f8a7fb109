"""Robots rules against the standard library's parser."""

import random
from urllib.robotparser import RobotFileParser

from support import rows
from weblattice.operators.robots import robots_allowed, robots_rules, with_robots

AGENT = "WebLatticeBot/1.0"


def random_body(pick):
    lines = []
    for _ in range(pick.randint(0, 14)):
        lines.append(pick.choice([
            "", " ", "# note", "User-agent: *", "user-agent:  LatticeBot # us", "User-agent: otherbot", "User-agent: bot",
            "Disallow: /a", "Disallow: /a/b", "Allow: /a/b", "Allow: /", "Disallow: /", "Disallow:", "Disallow: /%61/c",
            "Allow: /x?q=1", "Disallow: /x?", "Disallow: /*.gif$", "Disallow: /ü", "Crawl-delay: 3", "Request-rate: 1/5",
            "Sitemap: http://h/s.xml", "no colon", "DISALLOW : /d e", "Disallow: *",
        ]))
    return pick.choice(["\n", "\r\n", "\r"]).join(lines)


PATHS = ["", "/", "/a", "/a/b", "/a/c", "/%61/b?x", "/x?q=1", "/x", "/i.gif", "/%C3%BC1", "/ü2", "/d%20e", "/d e", "/*", "/%2Ax", "/z?"]


def test_equal_to_stdlib(spark):
    pick = random.Random(23)
    bodies = {f"http://h{i}": random_body(pick) for i in range(150)}
    robots = spark.createDataFrame([(h, 200, b) for h, b in bodies.items()], "host_key string, status_code int, body string")
    urls = spark.createDataFrame([(h + p,) for h in bodies for p in PATHS], "url string")
    got = {r["url"]: r["allowed"] for r in with_robots(urls, robots_rules(robots, AGENT)).collect()}
    wrong = []
    for host, body in bodies.items():
        if not body:
            wrong += [(host, p) for p in PATHS if not got[host + p]]  # no body: all is allowed
            continue
        parser = RobotFileParser()
        parser.parse(body.splitlines())
        wrong += [(body, p) for p in PATHS if parser.can_fetch(AGENT, host + p) != got[host + p]]
    assert not wrong, wrong[:5]


def test_hand_cases(spark):
    robots = spark.createDataFrame([
        ("http://first", 200, "User-agent: *\nDisallow: /a\nAllow: /a/b"),
        ("http://gone", 404, "User-agent: *\nDisallow: /"),
        ("http://empty", 200, ""),
        ("http://named", 200, "User-agent: *\nDisallow: /\n\nUser-agent: latticebot\nDisallow: /x"),
    ], "host_key string, status_code int, body string")
    rules = robots_rules(robots, AGENT)
    assert rows(rules) == [
        ("http://first", "*", 1, False, "/a"), ("http://first", "*", 2, True, "/a/b"), ("http://named", "latticebot", 1, False, "/x"),
    ]
    urls = ["http://first/a/b", "http://first/c", "http://gone/a", "http://empty/a", "http://named/y", "http://named/x1", "http://unknown/"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert rows(robots_allowed(frame, rules)) == sorted((u,) for u in urls if u not in ("http://first/a/b", "http://named/x1"))
