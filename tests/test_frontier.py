"""The page chain: headers, links, frontier, next requests, and work units."""

from __future__ import annotations

import json
from collections import defaultdict

import pytest

from tickforge.operators import frontier, pairs

PAGES = "fsym string, tsym string, page_no int, status int, body string"
COMMON = dict(base_url="https://h/data", app_name="a", exchange="E")


def page(times, time_from="first", volume=1.0):
    head = {} if time_from is None else {"TimeFrom": min(times) if time_from == "first" else time_from}
    return json.dumps({"Data": [{"time": t, "volumefrom": volume} for t in times], **head})


def headers(spark, data):
    return frontier.page_headers(spark.createDataFrame(data, PAGES))


def links(spark, data):
    return {(r["fsym"], r["page_no"]): (r["link"], r["shared_bars"], r["missing_bars"])
            for r in frontier.page_links(headers(spark, data), 60).collect()}


def test_links(spark):
    data = [("A", "U", 0, 200, page([600, 660])), ("A", "U", 1, 200, page([480, 540])),  # ends a bar before
            ("A", "U", 2, 200, page([360, 420, 480])),  # shares the bar at TimeFrom
            ("A", "U", 3, 200, page([120, 180])),  # 240 and 300 are missing
            ("A", "U", 4, 200, page([0, 60, 120, 180, 240])),  # three bars come twice
            ("A", "U", 6, 200, page([0])), ("A", "U", 7, 500, "oops"), ("A", "U", 8, 200, page([0])),
            ("A", "U", 9, 200, '{"Data":[]}'), ("A", "U", 10, 200, page([0])), (None, "U", 0, 200, page([0])), (None, "U", 1, 200, page([0]))]
    assert links(spark, data) == {
        ("A", 0): ("first", None, None), ("A", 1): ("joined", 0, 0), ("A", 2): ("joined", 1, 0), ("A", 3): ("gap", 0, 2),
        ("A", 4): ("overlap", 3, 0), ("A", 6): ("missing_page", None, None), ("A", 7): ("failed", None, None),
        ("A", 8): ("failed", None, None), ("A", 9): ("empty", None, None), ("A", 10): ("empty", None, None),
        (None, 0): ("first", None, None), (None, 1): ("joined", 1, 0)}


def test_frontier_states(spark):
    good = page([100, 160])
    data = [("open", "U", 0, 200, page([300])), ("open", "U", 1, 200, page([200])),
            ("done", "U", 0, 200, good), ("done", "U", 1, 200, page([40], volume=0.0)), ("done", "U", 2, 200, good),
            ("failed", "U", 0, 200, good), ("failed", "U", 1, 503, "x"), ("failed", "U", 2, 200, page([5])),
            ("lost", "U", 0, 200, good), ("lost", "U", 1, 200, page([60])), ("lost", "U", 4, 200, page([5], volume=0.0)),
            ("headless", "U", 1, 200, good), ("dead", "U", 0, 500, "x"), ("empty", "U", 0, 200, '{"Data":[],"TimeFrom":9}'),
            # landed again: the good response counts; TimeFrom missing: the first bar's time
            ("twice", "U", 0, 500, "x"), ("twice", "U", 0, 200, page([90, 30], time_from=None)), (None, None, 0, 200, good)]
    got = {r["fsym"]: (r["state"], r["next_page"], r["to_ts"]) for r in frontier.frontier(headers(spark, data)).collect()}
    assert got == {"open": ("open", 2, 200), "done": ("done", 1, 100), "failed": ("failed", 1, 100), "lost": ("open", 2, 60),
                   "headless": ("open", 0, None), "dead": ("failed", 0, None), "empty": ("done", 0, None), "twice": ("open", 1, 30),
                   None: ("open", 1, 100)}


def test_requests_resume_a_back_fill_to_its_end(spark):
    """Answering every next request ends with all bars landed and nothing left to ask."""
    bars = {"A": list(range(0, 60 * 50, 60)), "B": list(range(0, 60 * 7, 60))}
    landed, asked = [], 0
    wanted = spark.createDataFrame([("A", "U"), ("B", "U")], "fsym string, tsym string")
    for step in range(12):
        h = headers(spark, landed)
        todo = frontier.next_requests(h, "minute", as_of="1970-01-04 12:00:00", pairs=wanted, **COMMON).collect()
        if not todo:
            break
        for r in todo:
            asked += 1
            assert r["url"] == f"https://h/data/histominute?fsym={r['fsym']}&tsym=U&limit=2000&toTs={r['to_ts']}&e=E&extraParams=a"
            if step == 1 and r["fsym"] == "A":
                landed.append((r["fsym"], "U", r["next_page"], 500, "try again"))
                continue
            old = [t for t in bars[r["fsym"]] if t <= r["to_ts"] and (r["next_page"] == 0 or t < r["to_ts"])][-20:]
            landed.append((r["fsym"], "U", r["next_page"], 200, page(old) if old else page([r["to_ts"] - 60], volume=0.0)))
    assert not todo and asked < 12
    found = defaultdict(set)
    for f, _, _, status, body in landed:
        if status == 200:
            found[f] |= {b["time"] for b in json.loads(body)["Data"] if b["volumefrom"]}
    assert {f: sorted(v) for f, v in found.items()} == bars


def test_nothing_landed_and_bad_pages(spark):
    assert frontier.frontier(headers(spark, [])).count() == 0 and frontier.page_links(headers(spark, []), 60).count() == 0
    with pytest.raises(Exception, match="without Data"):
        headers(spark, [("A", "U", 0, 200, "{}")])


def test_work_units(spark):
    rows = [("H", f"H{i:03d}", t) for i in range(90) for t in ("USD", "BTC")] + [("_", "1X", "USD"), (None, None, "USD"), ("_", "1X", "USD")]
    df = spark.createDataFrame(rows, "fsym_char1 string, fsym string, tsym string")
    got = defaultdict(list)
    for r in pairs.work_units(df, 25, rows_per_range=20).collect():
        got[r["fsym_char1"], r["unit"]].append((r["fsym"], r["tsym"]))
    hot = sorted((f, t) for b, f, t in rows if b == "H")
    assert {u: sorted(v) for (b, u), v in got.items() if b == "H"} == {i // 25 + 1: hot[i:i + 25] for i in range(0, 180, 25)}
    assert got["_", 1] == [("1X", "USD")] * 2 and got[None, 1] == [(None, "USD")]
    assert pairs.work_units(df.limit(0), 5).count() == 0
    with pytest.raises(ValueError):
        pairs.work_units(df, 0)
