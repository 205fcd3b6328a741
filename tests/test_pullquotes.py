"""Blocks of pull quotes, their plan and what is brought back from the next page, against plain loops over pages."""

import random
import re
from collections import defaultdict

import pytest

from lectern.operators import boxes, pullquotes as Q, sequence
from lectern.plans import layouts
from lectern.plans.derived import quoted

SF = "/root/testdata/sf0.001"


def is_text(s):
    return "Lato" in s.font and 13 <= s.size <= 18.5 and s.color in Q.STYLE["colors"] and s.text not in Q.STYLE["not"]


def by_page(spans):
    out = defaultdict(list)
    for s in spans:
        out[s.file, s.page].append(s)
    return {k: sorted(v, key=lambda s: s.line_no) for k, v in out.items()}


def blocks_by_hand(page):
    used, out = set(), []
    for o in (s for s in page if s.text == Q.OPEN):
        offers = [c for c in page if c.text == Q.CLOSE and c.line_no > o.line_no and c.line_no not in used and -10 <= c.y - o.y <= 220]
        if not offers:
            continue
        c = min(offers, key=lambda c: (abs(c.y - o.y), c.line_no))
        used.add(c.line_no)
        body = sorted((s for s in page if is_text(s) and o.y - 2 <= s.y <= max(c.y, o.y) + 60 and s.x >= o.x + 4), key=lambda s: (s.y, s.x, s.line_no))
        for i in range(1, len(body)):
            if body[i].y - body[i - 1].y > 42:
                body = body[:i]
                break
        if body:
            out.append((o, c, body))
    return out


def plan_by_hand(page):
    moves, tight = {}, {}
    for o, c, body in blocks_by_hand(page):
        rows = []
        for s in body:
            if rows and s.y - rows[-1][0].y <= 1:
                rows[-1].append(s)
            else:
                rows.append([s])
        steps = [b[0].y - a[0].y for a, b in zip(rows, rows[1:])]
        steps = [g for g in steps if 12 <= g <= 30]
        lead = max(16.5, min(24.0, min(steps) if steps else rows[0][0].size * 1.22))
        others = [s.y for s in page if s.text not in ("", Q.OPEN, Q.CLOSE) and s.color != "C767171" and 60 <= s.y <= 760]
        top, last = body[0].y, max(s.y for s in body)
        above, below = max((y for y in others if y < top), default=None), min((y for y in others if y > last), default=None)
        foot, shift = top + lead * len(rows), 0.0
        if below is not None and below - foot < 18:
            shift -= min(18 - (below - foot), max(0.0, (top - above if above is not None else 999.0 + 18) - 18))
        if above is not None and top + shift - above < 18:
            shift += min(18 - (top + shift - above), max(0.0, (below - foot - shift if below is not None else 999.0 + 18 - shift) - 18))
        placed = {}
        for i, row in enumerate(rows):
            left, right = min(s.x for s in row), max(s.x + s.w for s in row)
            for s in row:
                placed[s.line_no] = (s.x + 297.5 - (left + right) / 2, top + shift + lead * i, s)
        left, right = min(x for x, _, _ in placed.values()), max(x + s.w for x, _, s in placed.values())
        placed[o.line_no] = (left - 18, top + shift, o)
        placed[c.line_no] = (right + 4, top + shift + lead * (len(rows) - 1), c)
        for n, (x, y, s) in placed.items():
            moves[o.line_no, n] = (round(x, 3), round(y, 3), abs(s.x - x) > 0.01 or abs(s.y - y) > 0.01)
        up, down = above is not None and top + shift - above, below is not None and below - foot - shift
        if up is not False and up < 18 or down is not False and down < 18:
            tight[o.line_no] = (len(rows), round(shift, 3), round(up, 3) if up is not False and up < 18 else None, round(down, 3) if down is not False and down < 18 else None)
    return moves, tight


@pytest.fixture(scope="module")
def pages(spark):
    return by_page(quoted(spark, SF).collect())


def close_to(a, b):
    return all(x == y or x is not None and y is not None and abs(x - y) < 0.002 for x, y in zip(a, b, strict=True))


def test_plan_by_hand(spark, pages):
    got = {(r.open, r.line_no): (r.new_x, r.new_y, r.moved) for r in layouts.c16_planned_quotes(spark, SF).collect()}
    tight = {r.open: (r.rows, r.shift, r.tight_above, r.tight_below) for r in layouts.c16_tight_quotes(spark, SF).collect()}
    want, want_tight = {}, {}
    for page in pages.values():
        moves, few = plan_by_hand(page)
        want |= moves
        want_tight |= few
    assert got.keys() == want.keys() and len(want) > 1000 and all(close_to(got[k], want[k]) for k in want)
    assert tight.keys() == want_tight.keys() and want_tight and all(close_to(tight[k], want_tight[k]) for k in tight)


def test_rounds_match_as_a_fold(spark, monkeypatch):
    rng = random.Random(1)
    rows = [("f", rng.randrange(3), i, 10.0, float(rng.randrange(300)), rng.choice([Q.OPEN, Q.CLOSE])) for i in range(90)]
    df = spark.createDataFrame(rows, "file string, page long, line_no long, x double, y double, text string")
    fold = sorted(map(tuple, Q.matched_marks(df).collect()))
    monkeypatch.setattr(Q, "FOLD_PAIRS", 0)
    assert fold == sorted(map(tuple, Q.matched_marks(df).collect())) and len(fold) > 10
    used, want = set(), []
    for _, p, n, _, y, t in rows:
        if t == Q.OPEN:
            offers = [(abs(r[4] - y), r[2]) for r in rows if r[1] == p and r[5] == Q.CLOSE and r[2] > n and r[2] not in used and -10 <= r[4] - y <= 220]
            if offers:
                used.add(min(offers)[1])
                want.append((n, min(offers)[1]))
    assert sorted((r[2], r[5]) for r in fold) == sorted(want)
    assert Q.matched_marks(df.limit(0)).count() == 0


def test_brought_back_by_hand(spark, pages):
    lines, quotes = Q.brought_back(quoted(spark, SF))
    got, moved = defaultdict(dict), {r.open: (r.moved, round(r.shift, 3)) for r in quotes.collect()}
    for r in lines.collect():
        got[r.open][r.line_no] = (r.new_page, r.new_x, r.new_y, r.sort_key)
    want, taken, found = {}, set(), {}
    for (file, p), page in sorted(pages.items()):
        opened = [s for s in page if s.text == Q.OPEN]
        after = pages.get((file, p + 1), [])
        for o in opened:
            nxt = min((s.line_no for s in opened if s.line_no > o.line_no), default=10**12)
            if any(s.text == Q.CLOSE and o.line_no < s.line_no < nxt and -10 <= s.y - o.y <= 220 for s in page):
                continue
            ends = [s for s in after if s.text == Q.CLOSE and s.y <= 150]
            if not ends:
                continue
            c = min(ends, key=lambda s: (s.y, s.line_no))
            if c.line_no in taken:
                continue
            taken.add(c.line_no)
            order = lambda s: (s.y, s.x, s.line_no)
            here = sorted((s for s in page if is_text(s) and s.line_no > o.line_no and s.x >= o.x + 4 and o.y - 2 <= s.y <= 760), key=order)
            there = sorted((s for s in after if is_text(s) and 60 <= s.y <= c.y + 2), key=order)
            if not here or not there:
                continue
            steps = sorted(b.y - a.y for part in (here, there) for a, b in zip(part, part[1:]) if 6 <= b.y - a.y <= 32)
            m = len(steps)
            gap = 18.0 if not m else (steps[(m - 1) // 2] + steps[m // 2]) / 2
            body = here + there
            top = min(s.y for s in here)
            over = [s.y for s in page if s.text not in ("", Q.OPEN, Q.CLOSE) and s.color != "C767171" and s.y < o.y and s not in here]
            shift = min(0.0, 760 - (top + gap * len(body)))
            if -shift > ((top - max(over) - 18) if over else 999.0) + 0.1:
                continue
            last = max(s.line_no for s in here)
            n = len(body)
            rows = {s.line_no: (p, 297.5 - s.w / 2, top + shift + gap * i, float(s.line_no) if s in here else last + (i + 1) / (n + 2)) for i, s in enumerate(body)}
            rows[o.line_no] = (p, min(297.5 - s.w / 2 for s in body) - 18, top + shift, float(o.line_no))
            rows[c.line_no] = (p, max(297.5 + s.w / 2 for s in body) + 4, top + shift + gap * (n - 1), last + (n + 1) / (n + 2))
            want[o.line_no] = rows
            found[o.line_no] = (len(there) + 1, round(shift, 3))
    assert got.keys() == want.keys() and len(want) > 3
    for o, rows in want.items():
        assert got[o].keys() == rows.keys() and all(close_to(got[o][n], rows[n]) for n in rows)
        assert close_to(moved[o], found[o])
        keys = sorted(k for _, _, _, k in rows.values())
        assert len(set(keys)) == len(keys)


def test_boxes(spark):
    rng = random.Random(2)
    rows = [("f" if i % 3 else "g", i, rng.choice([None, *[rng.uniform(-50, 300)] * 9]), rng.uniform(-50, 300), rng.choice([0.0, None, rng.uniform(0, 400), rng.uniform(0, 30)]), rng.uniform(0, 60), "x") for i in range(120)]
    df = spark.createDataFrame(rows, "file string, n long, x double, y double, w double, h double, r string")
    good = [r for r in rows if None not in r[2:6] and r[4] > 0 and r[5] > 0]
    want = {(a[1], b[1]) for a in good for b in good if a[0] == b[0] and a[1] < b[1] and a[2] < b[2] + b[4] and b[2] < a[2] + a[4] and a[3] < b[3] + b[5] and b[3] < a[3] + a[5]}
    for side in (17.0, 64.0, 1000.0):
        got = [(r.a, r.b) for r in boxes.overlaps(df, ["file"], "n", side).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    points = spark.createDataFrame([("f", i, rng.uniform(-60, 320), rng.uniform(-60, 320)) for i in range(60)] + [("f", 99, None, 1.0)], "file string, i long, x double, y double")
    held = {(p.i, r[1]) for p in points.collect() for r in rows if p.x is not None and None not in r[2:6] and r[0] == p.file and r[2] <= p.x <= r[2] + r[4] and r[3] <= p.y <= r[3] + r[5]}
    assert {(r.i, r.box.n) for r in boxes.inside(points, df, ["file"]).collect()} == held and held
    assert boxes.overlaps(df.limit(0), ["file"], "n").count() == 0


def test_a_plan_moves_its_spans_once_for_each_step(spark):
    """Neighbouring steps over blocks share a shuffle: marks by page, lines by block."""
    pairs = spark.createDataFrame([("f", 1, 1, 0.0, 0.0, 2, 1.0, 1.0)], "file string, page long, open long, open_x double, open_y double, close long, close_x double, close_y double")
    rows = spark.createDataFrame([("f", 1, 1, float(i // 2), i) for i in range(6)], "file string, page long, open long, y double, line_no long")
    keys = ["file", "page", "open"]
    grouped = sequence.anchored_groups(sequence.chained_groups(rows, keys, ["y", "line_no"], "y", 5.0, "_g"), keys, ["y", "line_no"], "y", 0.5, "row", placed=True)
    for df in (Q.matched_by_fold(pairs), grouped):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert sorted((r.line_no, r.row) for r in grouped.collect()) == [(i, i // 2 + 1) for i in range(6)]
