"""Random leagues against plain Python, and methods that must agree against each other."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from matchweave.functions.numeric import clock_micros, half_up
from matchweave.operators import clean, clubrows as C, dataset, elo, features, joins
from matchweave.operators.latest import append_dedupe, latest_per_key, rank_within
from tests import golden

START = datetime(2026, 1, 1)


def league(seed, clubs=9, rounds=12, crowded=False):
    """Rows as golden.games gives them; ``crowded`` lets a club play several times a day."""
    dice, rows = random.Random(seed), []
    for rodada in range(1, rounds + 1):
        names = list(range(1, clubs + 1))
        dice.shuffle(names)
        pairs = list(zip(names[::2], names[1::2]))
        if crowded:
            pairs += [tuple(dice.sample(names, 2)) for _ in range(clubs // 2)]
        for home, away in dict.fromkeys(pairs):
            if dice.random() < 0.8:
                day = START + timedelta(days=rodada * 3 + dice.randrange(2))
                rows.append((len(rows) + 1, rodada, home, away, dice.randrange(4), dice.randrange(4), day))
    return rows


def by_club(rows):
    """club -> list of (round, at home, points, for, against) in order."""
    history = {}
    for _, rodada, home, away, gh, ga, day in sorted(rows, key=lambda r: (r[1], r[-1], r[0])):
        ph, pa = (3, 0) if gh > ga else (0, 3) if gh < ga else (1, 1)
        history.setdefault(home, []).append((rodada, True, ph, gh, ga))
        history.setdefault(away, []).append((rodada, False, pa, ga, gh))
    return history


def mean(values):
    values = list(values)
    return sum(values) / len(values) if values else 0.0


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_form_and_momentum(spark, seed):
    rows = league(seed)
    matches = golden.matches(spark, rows)
    values = C.form5_prior() | {f"prior_{n}": c for n, c in C.venue_rate_prior().items()} | {
        "m3": C.momentum_sum3()["momentum"], "mw": C.momentum_weighted()["momentum"], "md": C.momentum_diff()["momentum"],
        "vp": C.venue_points_pct()["aproveitamento_casa"], "vi": C.venue_rate_incl()["aproveitamento_fora"],
    }
    found = C.over_clubs(C.club_rows(matches), values, ["clube_id", "rodada"]).collect()
    history = by_club(rows)
    for r in found:
        games = history[r.clube_id]
        at = [g[0] for g in games].index(r.rodada)
        before, so_far = games[:at], games[: at + 1]
        assert r.media_pontos_5j == pytest.approx(mean(g[2] for g in before[-5:]))
        assert r.media_gols_sofr_5j == pytest.approx(mean(g[4] for g in before[-5:]))
        assert r.m3 == sum(g[2] for g in before[-3:])
        home = [g for g in before if g[1]]
        assert r.prior_aproveitamento_casa == pytest.approx(sum(g[2] == 3 for g in home) / max(len(home), 1))
        assert r.md == pytest.approx(mean(g[2] for g in so_far[-3:]) - mean(g[2] for g in so_far[-6:]))
        newest = [{3: 1.0, 1: 0.5, 0: 0.0}[g[2]] for g in reversed(so_far[-3:])]
        weights = [3, 2, 1][: len(newest)]
        assert r.mw == pytest.approx(sum(w * v for w, v in zip(weights, newest)) / sum(weights), abs=5.1e-5)
        home = [g for g in so_far if g[1]]
        assert r.vp == pytest.approx(100 * sum(g[2] for g in home) / (3 * len(home)) if home else 0, abs=5.1e-3)
        away = [g for g in so_far if not g[1]]
        assert r.vi == pytest.approx(mean(g[2] == 3 for g in away) if not games[at][1] else 0)


def undated(matches, *ids):
    return matches.withColumn("data_partida", F.when(~F.col("partida_id").isin(*ids), F.col("data_partida")))


def test_undated_matches_come_last_everywhere(spark):
    rows = [(1, 1, 5, 6, 2, 0, START), (2, 1, 5, 7, 0, 1, START + timedelta(days=1)), (3, 1, 5, 8, 1, 1, START - timedelta(days=9))]
    matches = undated(golden.matches(spark, rows), 3)
    values = C.cum_stats() | C.momentum_sum3()
    found = {r.partida_id: (r.pontos_acumulados, r.momentum) for r in C.over_clubs(C.club_rows(matches), values, ["clube_id", "partida_id"]).filter("clube_id = 5").collect()}
    assert found == {1: (3, 0), 2: (3, 3), 3: (4, 3)}
    state = features.feature_store(matches, per_round=True).filter("clube_id = 5").first()
    assert state.pontos_acumulados == 4


def test_a_postponed_round_counts_from_its_date(spark):
    """Round 2 is played after round 3: round 3 must not know it, round 2 must know round 3."""
    day = lambda n: START + timedelta(days=n)
    rows = [(1, 1, 5, 6, 1, 0, day(0)), (2, 2, 5, 7, 0, 0, day(30)), (3, 3, 5, 8, 0, 2, day(14))]
    form = {r.rodada: r for r in features.features_job(golden.matches(spark, rows)).filter("clube_id = 5").collect()}
    assert (form[3].momentum, form[3].media_pontos_5j) == (3.0, 3.0)
    assert (form[2].momentum, form[2].media_pontos_5j) == (3.0, 1.5)
    assert form[3].elo_rating == pytest.approx(1516.0) and form[2].elo_rating < form[3].elo_rating


def test_one_row_per_round_holds_the_state_after_it(spark):
    rows = league(7, clubs=5, rounds=6, crowded=True)
    store = features.feature_store(golden.matches(spark, rows), per_round=True).collect()
    history = by_club(rows)
    assert len(store) == sum(len({g[0] for g in games}) for games in history.values())
    for r in store:
        assert r.pontos_acumulados == sum(g[2] for g in history[r.clube_id] if g[0] <= r.rodada)


def test_intervals_follow_matches_and_hold_the_grid(spark, season):
    """A club that plays twice in a hundred rounds has three intervals, and rounds looked up are those of the grid."""
    rows = [(None, k, 1 + 49 * k, 1 + k, 9, "casa", 1, 0, datetime(2024, 1, 1) + timedelta(days=k)) for k in range(3)] + [("b", 7, 4, 1, 2, "empate", 1, 1, None)]
    schema = "competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint, resultado string, placar_casa int, placar_vis int, data_partida timestamp_ntz"
    matches = spark.createDataFrame(rows, schema)
    spans, grid = features.grid_intervals(matches), features.round_club_grid(matches)
    assert spans.count() <= 2 * 4 * 2 and grid.count() == 4 * 99 + 2 * 4
    asked = spark.createDataFrame([(None, 1), (None, 60), (None, 60), ("b", 2), ("b", 50), ("c", 1)], "competicao string, rodada int")
    whole = {tuple(r) for r in grid.filter("competicao IS NULL AND rodada IN (1, 60) OR competicao = 'b' AND rodada = 2").collect()}
    found = features.round_club_grid(matches, rounds=asked).collect()
    assert len(found) == len(whole) == 10 and {tuple(r) for r in found} == whole


def test_grid_carries_every_club_through_every_round(spark):
    rows = league(5, clubs=7)
    matches = golden.matches(spark, rows)
    history, last = by_club(rows), max(r[1] for r in rows)
    found = {(r.clube_id, r.rodada): r for r in features.round_club_grid(matches).collect()}
    assert set(found) == {(c, n) for c in history for n in range(1, last + 1)}
    for (club, rodada), r in found.items():
        games = [g for g in history[club] if g[0] <= rodada]
        assert r.pontos_acumulados == sum(g[2] for g in games)
        assert r.saldo_gols == sum(g[3] - g[4] for g in games)


def test_seed_store_before_the_first_match(spark):
    matches = golden.matches(spark, [r for r in golden.games() if r[1] > 1 or 101 not in r[2:4]])
    base = spark.createDataFrame([(101, 1640.0)], "clube_id bigint, elo_base double")
    first = features.features_seed(matches, base).filter("clube_id = 101 AND rodada = 1").first()
    assert (first.elo_rating, first.momentum, first.media_pontos_5j, first.aproveitamento_casa) == (1640.0, 0.5, 0.0, 0.0)


def same_ratings(matches):
    both = [{(r.partida_id, r.clube_casa_id): (r.elo_casa, r.elo_vis) for r in elo.elo(matches, method=m).collect()} for m in ("grouped", "levels")]
    assert set(both[0]) == set(both[1])
    assert len(both[0]) == matches.filter("resultado IS NOT NULL").count()
    for match, pair in both[0].items():
        assert both[1][match] == pytest.approx(pair, abs=1e-9)


@pytest.mark.parametrize("crowded", [False, True])
def test_both_methods_rate_alike(spark, crowded):
    """Clubs once or several times a day, some matches undated."""
    same_ratings(undated(golden.matches(spark, league(3, clubs=6, rounds=4, crowded=crowded)), 2, 7))


def test_both_methods_rate_repeated_match_keys(spark):
    rows = league(5, clubs=6, rounds=3)
    rows += [(r[0] + 1000, *r[1:]) for r in rows[:4]]
    same_ratings(golden.matches(spark, rows))


def test_ratings_after_the_match_lead_to_those_before_the_next(spark, season):
    rated = elo.elo(season, after=True).collect()
    after = {}
    for r in sorted(rated, key=lambda r: (r.data_partida, r.partida_id)):
        for club, before, now in ((r.clube_casa_id, r.elo_casa, r.elo_casa_depois), (r.clube_vis_id, r.elo_vis, r.elo_vis_depois)):
            assert before == pytest.approx(after.get(club, 1500.0), abs=1e-9)
            after[club] = now


def test_levels_hold_no_club_twice_and_keep_its_order(spark):
    matches = golden.matches(spark, league(8, clubs=6, rounds=5, crowded=True)).withColumn("_linha", F.col("partida_id"))
    level = {r["_linha"]: r["_nivel"] for r in elo.levels(matches).collect()}
    seen = {}
    for r in sorted(matches.collect(), key=lambda r: (r.data_partida, r.partida_id)):
        for club in (r.clube_casa_id, r.clube_vis_id):
            assert seen.get(club, 0) < level[r.partida_id]
            seen[club] = level[r.partida_id]


@pytest.mark.parametrize("chunk", [1, 3, 1_000_000])
def test_rank_in_buckets_equals_one_window(spark, chunk):
    dice = random.Random(4)
    rows = [(k, i, dice.randrange(3), dice.randrange(2), dice.randrange(2)) for k in "AB" for i in range(60)]
    df = spark.createDataFrame(rows, "competicao string, clube_id bigint, p int, v int, s int")
    order = [F.desc("p"), F.desc("v"), F.desc("s"), "clube_id"]
    plain = df.withColumn("posicao", F.row_number().over(Window.partitionBy("competicao").orderBy(*order)))
    split = rank_within(df, ["competicao"], ["p", "v", "s"], "clube_id", "posicao", chunk=chunk)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("share", [0.0, 0.5, 0.8, 1.0])
def test_split_equals_a_full_sort(spark, share):
    rows = league(6, crowded=True)
    split = dataset.time_split(golden.matches(spark, rows), share)
    ordered = sorted(rows, key=lambda r: (r[1], r[-1], r[0]))
    first = {r[0] for r in ordered[: int(len(rows) * share)]}
    assert {r.partida_id for r in split.filter("conjunto = 'treino'").collect()} == first


@pytest.mark.parametrize("missing", range(0, 11, 2))
def test_split_with_undated_rows(spark, missing):
    """Undated rows are the first of their round; the first part has its full size whatever their number."""
    rows = [(i, 3, 2 * i, 2 * i + 1, 1, 0, START + timedelta(days=i % 3)) for i in range(1, 11)]
    matches = undated(golden.matches(spark, rows), *range(1, missing + 1)) if missing else golden.matches(spark, rows)
    ordered = sorted(rows, key=lambda r: (r[0] > missing, r[-1] if r[0] > missing else START, r[0]))
    found = {r.partida_id for r in dataset.time_split(matches).filter("conjunto = 'treino'").collect()}
    assert found == {r[0] for r in ordered[:8]}


def test_split_with_one_round_holding_everything(spark):
    rows = [(i * 10**12 + 7, 3, 2 * i, 2 * i + 1, 1, 0, START) for i in range(1, 400)]
    split = dataset.time_split(golden.matches(spark, rows))
    assert {r.partida_id for r in split.filter("conjunto = 'treino'").collect()} == {r[0] for r in rows[:319]}


def test_split_with_ids_over_all_of_bigint(spark):
    ids = [-(2**63), -5, 0, 3, 2**62, 2**63 - 1]
    split = dataset.time_split(golden.matches(spark, [(n, 1, i, i + 50, 1, 0, START) for i, n in enumerate(ids)]), 0.5)
    assert {r.partida_id for r in split.filter("conjunto = 'treino'").collect()} == set(ids[:3])


def test_one_match_per_round(spark):
    rows = league(9, clubs=8, rounds=6, crowded=True)
    kept = clean.one_match_per_round(golden.matches(spark, rows)).collect()
    first = {}
    for r in sorted(rows, key=lambda r: (r[-1], r[0])):
        for club in r[2:4]:
            first.setdefault((r[1], club), r[0])
    expected = {r[0] for r in rows if first[r[1], r[2]] == first[r[1], r[3]] == r[0]}
    assert {r.partida_id for r in kept} == expected


def test_a_hot_club_is_bounded_by_the_calendar(spark):
    """A club named by most raw rows still has one row per round behind the round key."""
    raw = spark.range(30_000).selectExpr(
        "'A' competicao", "id partida_id", "cast(id % 7 + 1 as int) rodada", "if(id % 3 < 2, 1, id + 10) clube_casa_id",
        "id + 100000 clube_vis_id", "1 placar_casa", "0 placar_vis", "timestamp_ntz'2026-01-01 00:00:00' data_partida",
    )
    kept = clean.one_match_per_round(clean.silver_matches(raw))
    per_club = C.club_rows(kept).groupBy("clube_id").count()
    assert per_club.agg(F.max("count")).first()[0] <= 7
    assert per_club.filter("clube_id = 1").first()["count"] == 7


def test_asof_takes_the_round_before(spark, season):
    store = features.features_sql(season)
    state = joins.join_features(store, features.feature_store(season))
    fixtures = season.select("competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id")
    exact = {(r.rodada, r.clube_id): r for r in state.collect()}
    for r in joins.features_asof(fixtures, state).collect():
        before = exact.get((r.rodada - 1, r.clube_casa_id))
        assert r.elo_casa == (before.elo_rating if before else 0.0)
        before = exact.get((r.rodada - 1, r.clube_vis_id))
        assert r.saldo_gols_vis == (before.saldo_gols if before else 0.0)


def test_asof_and_exact_on_future_rounds(spark, season):
    state = joins.join_features(features.features_sql(season), features.feature_store(season))
    future = spark.createDataFrame([("A", 99, 9, 101, 102), ("A", 98, 9, 101, 999)], "competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint")
    asof = {r.partida_id: r for r in joins.match_features(future, state).collect()}
    exact = joins.match_features(future, state, mode="exact").collect()
    goals = {row[1]: row[9] for row in golden.table()}
    assert asof[99].saldo_gols_casa == goals[101] and asof[99].saldo_gols_vis == goals[102] and asof[98].elo_vis == 0
    assert all(r[name] == 0 for r in exact for name in joins.FEATURES)


def test_latest_and_append(spark):
    old = spark.createDataFrame([(1, 5, "velho"), (2, 5, "só velho"), (3, None, "x")], "k int, t int, v string")
    new = spark.createDataFrame([(1, 5, "novo"), (3, 1, "y"), (4, 0, "só novo")], "k int, t int, v string")
    merged = {r.k: r.v for r in append_dedupe(old, new, ["k"], ["t"]).collect()}
    assert merged == {1: "novo", 2: "só velho", 3: "y", 4: "só novo"}
    assert latest_per_key(old.unionByName(new), ["k"], ["t"]).count() == 4


def test_lagged_training_set_does_not_see_the_match(spark, season):
    enhanced, base = features.features_job(season), features.feature_store(season)
    same = dataset.training_set(season, enhanced, base)
    lagged = dataset.training_set(season, enhanced, base, lagged=True)
    before = {(r.rodada + 1, r.clube_id): r.saldo_gols for r in base.collect()}
    assert same.count() == lagged.count() == 50
    for r in lagged.collect():
        assert r.saldo_gols_casa == before.get((r.rodada, r.clube_casa_id), 0)


def test_class_weights(spark, season):
    weights = {r.resultado: r.peso for r in dataset.class_weights(season).collect()}
    assert weights == {result: 50 / (3 * n) for result, n in golden.outcomes().items()}


def test_clock_order_ignores_the_session_zone(spark):
    """23:30 and 00:30 around a spring-forward gap keep their distance."""
    texts = ["2018-11-03 23:30:00", "2018-11-04 00:30:00", "2018-11-04 01:30:00.25"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        a, b, c = (r[0] for r in df.select(clock_micros(F.col("t"))).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (b - a, c - b) == (3_600_000_000, 3_600_250_000)


def test_half_up(spark):
    values = spark.createDataFrame([(2.675,), (-0.125,), (50.15,), (None,)], "x double")
    assert [r[0] for r in values.select(half_up(F.col("x"), 2)).collect()] == [2.68, -0.13, 50.15, None]


def test_slices_hand_ratings_on(spark, monkeypatch):
    """No task gets more than a slice of a competition, and ratings are those of the whole calendar."""
    dice = random.Random(7)
    rows = []
    for k in range(400):
        home, away = dice.sample(range(1, 9), 2)
        league = dice.choice(["a", "a", "a", "b", None])
        day = None if dice.random() < 0.05 else datetime(2024, 1, 1) + timedelta(days=dice.randrange(60))
        rows.append((league, k, home, away, dice.choice(["H", "D", "A"]), day))
    matches = spark.createDataFrame(rows, "competicao string, partida_id bigint, clube_casa_id bigint, clube_vis_id bigint, resultado string, data_partida timestamp_ntz")
    matches = matches.replace({"H": elo.HOME, "D": elo.DRAW, "A": elo.AWAY}, subset=["resultado"])
    ratings = lambda: {r.partida_id: (r.elo_casa, r.elo_vis) for r in elo.elo(matches).collect()}
    whole = ratings()
    monkeypatch.setattr(elo, "SLICE", 25)
    sizes, rater = spark.sparkContext.accumulator(0), elo._rater

    def watched(k, start):
        rate = rater(k, start)

        def run(pdf, known):
            sizes.add(int(len(pdf) > 100))
            return rate(pdf, known)

        return run

    monkeypatch.setattr(elo, "_rater", watched)
    sliced = ratings()
    assert sizes.value == 0 and set(sliced) == set(whole) and len(whole) == 400
    assert all(sliced[k] == pytest.approx(whole[k], abs=1e-9) for k in whole)
