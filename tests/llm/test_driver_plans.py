"""What the driver has to plan at once, and the components that come of it."""

from __future__ import annotations

import random

from corpusmill.llm import components as C
from corpusmill.llm import lines


def _roots(edges):
    """(node, smallest node of its component) of all nodes that aren't that one themselves."""
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return sorted((x, top(x)) for x in up if top(x) != x)


def test_components_of_chains_rings_and_random_edges(spark):
    draw = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200 + i, 200 + (i * 3 + 1) % 17) for i in range(17)]
    edges += [(draw.randrange(-400, 0), draw.randrange(-400, 0)) for _ in range(220)] + [(5, 5), (9, 8), (8, 9), (9, 8)]
    found = C.components(spark.createDataFrame(edges, "a long, b long"), "test-edges")
    assert sorted(map(tuple, found.collect())) == _roots(edges)


def test_stars_need_no_round(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(C, "stored", lambda df, label, f=C.stored: kept.append(label) or f(df, label))
    edges = [(1, x) for x in range(2, 60)] + [(100, 70), (-5, 200)]
    found = C.components(spark.createDataFrame(edges, "a long, b long"), "test-stars")
    assert sorted(map(tuple, found.collect())) == _roots(edges)
    assert kept == ["test-stars"]


def test_links_of_lines_are_stored_round_by_round(spark, capsys):
    """The plan of all rounds at once took the driver hundreds of megabytes."""
    start = "the quick brown fox jumps over the lazy dog number "
    texts = [f"{start}{i:02d}" for i in range(60)] + [f"{start}{i:02d}x" for i in range(60)]
    rows = spark.createDataFrame([(x,) for x in texts], "line string").selectExpr("line", "xxhash64(line) as h")
    links = lines.edit_links(rows, crowded=4)
    capsys.readouterr()
    links.explain()
    assert "Join" not in capsys.readouterr().out
    assert len(_roots([tuple(r) for r in links.collect()])) == len(texts) - 1
