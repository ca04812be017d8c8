"""Ratings kept as a table against ratings of the whole calendar at once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchweave.operators import elo, rating_store
from matchweave.operators.components import components
from matchweave.session import scratch_path

SCHEMA = "competicao string, partida_id bigint, clube_casa_id bigint, clube_vis_id bigint, resultado string, data_partida timestamp_ntz, placar_casa int"


def league(seed, n=300, clubs=24, days=90):
    dice = random.Random(seed)
    rows = []
    for k in range(n):
        home, away = dice.sample(range(1, clubs + 1), 2)
        day = None if dice.random() < 0.03 else datetime(2024, 1, 1) + timedelta(days=dice.randrange(days), hours=dice.randrange(24))
        rows.append((dice.choice(["a", "a", "a", "b", None]), k, home, away, dice.choice([elo.HOME, elo.DRAW, elo.AWAY, None]), day, dice.randrange(5)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def whole(spark, rows):
    return {r.partida_id: (r.elo_casa, r.elo_vis, r.elo_casa_depois, r.elo_vis_depois) for r in elo.elo(frame(spark, rows), after=True).collect()}


def kept(store):
    found = store.rated().collect()
    assert len({r.partida_id for r in found}) == len(found)
    return {r.partida_id: (r.elo_casa, r.elo_vis, r.elo_casa_depois, r.elo_vis_depois) for r in found}


def same(a, b):
    return set(a) == set(b) and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_equal_to_the_whole_calendar_and_only_what_changed_is_rated(spark):
    rows = league(1)
    store = rating_store.RatingStore(spark, scratch_path(spark, "elo"), days=10, every=3)
    first = [r for r in rows if r[5] is not None and r[5] < datetime(2024, 3, 1)]
    assert len(store.update(frame(spark, first))) == 7
    assert same(kept(store), whole(spark, first))
    # the same again rates nothing, a new day only its own window
    assert store.update(frame(spark, first)) == []
    day = [(*r[:5], datetime(2024, 3, 4, 20), r[6]) for r in league(2, n=6)]
    day = [(r[0], 1000 + r[1], *r[2:4], elo.HOME, *r[5:]) for r in day]
    assert len(store.update(frame(spark, first + day))) == 1
    assert same(kept(store), whole(spark, first + day))
    # all the rest, with undated matches in a window of their own
    done = store.update(frame(spark, rows + day))
    assert done[-1] == rating_store.UNDATED and same(kept(store), whole(spark, rows + day))
    # a corrected old result, then a match withdrawn: from their windows on
    at = next(k for k, r in enumerate(rows) if r[4] == elo.HOME and r[5] is not None and datetime(2024, 2, 1) < r[5] < datetime(2024, 2, 10))
    corrected = [*rows[:at], (*rows[at][:4], elo.AWAY, *rows[at][5:]), *rows[at + 1 :]] + day
    again = store.update(frame(spark, corrected))
    assert 1 < len(again) < len(store._marks()) and same(kept(store), whole(spark, corrected))
    store.update(frame(spark, corrected[:-1] if corrected[-1][4] else corrected))
    assert same(kept(store), whole(spark, corrected[:-1]))


def test_a_run_that_broke_off_is_made_up_for(spark, monkeypatch):
    rows = [r for r in league(3, n=120) if r[5] is not None]
    store = rating_store.RatingStore(spark, scratch_path(spark, "elo"), days=10, every=2)
    rate, done = rating_store.RatingStore._rate, []

    def breaks(self, lines, facts, before, window):
        rate(self, lines, facts, before, window)
        done.append(window)
        if len(done) == 6:
            raise RuntimeError("lost")

    monkeypatch.setattr(rating_store.RatingStore, "_rate", breaks)
    with pytest.raises(RuntimeError):
        store.update(frame(spark, rows))
    assert len(store._marks()) == 4
    monkeypatch.undo()
    store.update(frame(spark, rows))
    assert same(kept(store), whole(spark, rows))


def test_groups_are_components(spark):
    """Weekly fixtures: each group is one match, whatever the size of the league."""
    rows = []
    for week in range(3):
        order = random.Random(week).sample(range(100), 100)
        rows += [("a", week * 100 + k, order[2 * k], order[2 * k + 1], elo.HOME, datetime(2024, 1, 1) + timedelta(days=7 * week), 1) for k in range(50)]
    store = rating_store.RatingStore(spark, scratch_path(spark, "elo"))
    facts = store._grouped(store._windowed(frame(spark, rows)))
    assert facts.groupBy(rating_store.WINDOW, "_grupo").count().agg(F.max("count"), F.count("*")).first()[:] == (1, 150)
    store.update(frame(spark, rows))
    assert same(kept(store), whole(spark, rows))


def test_components(spark):
    dice = random.Random(4)
    edges = [(dice.randrange(300), dice.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {(r.node, r.root) for r in found} == {(x, find(x)) for x in list(root)} and len(found) == len(root)


def test_no_match(spark):
    assert rating_store.elo_by_window(frame(spark, []), scratch_path(spark, "elo")).collect() == []
