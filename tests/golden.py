"""The golden season: 20 clubs, five rounds drawn by a seeded generator, and its table worked out in plain Python."""

import json
import random
from datetime import datetime, timedelta

from matchweave.operators.clean import with_result

FIRST, LAST, ROUNDS = 101, 120, 5
START = datetime(2026, 4, 4)

SCHEMA = (
    "competicao string, partida_id bigint, rodada int, clube_casa_id bigint, clube_vis_id bigint, "
    "placar_casa int, placar_vis int, data_partida timestamp_ntz"
)


def games():
    """(id, round, home, away, home goals, away goals, date): everyone plays once a round, half of the matches a day later."""
    dice, clubs, rows = random.Random(20), list(range(FIRST, LAST + 1)), []
    for rodada in range(1, ROUNDS + 1):
        half = len(clubs) // 2
        for k in range(half):
            home, away = sorted((clubs[k], clubs[-1 - k]), key=lambda c: (c + rodada) % 2)
            goals = [dice.choice((0, 0, 1, 1, 1, 2, 3)) for _ in range(2)]
            rows.append((len(rows) + 1, rodada, home, away, *goals, START + timedelta(days=7 * (rodada - 1) + (k >= half // 2))))
        clubs = [clubs[0], clubs[-1], *clubs[1:-1]]
    return rows


def outcomes(rows=None):
    """Home wins, away wins and draws."""
    signs = [(r[4] > r[5]) - (r[4] < r[5]) for r in rows or games()]
    return {"casa": signs.count(1), "visitante": signs.count(-1), "empate": signs.count(0)}


def ratings(rows=None):
    """Rating of each club after its last match, by date and id."""
    now = {}
    for _, _, home, away, scored, conceded, _ in sorted(rows or games(), key=lambda r: (r[6], r[0])):
        a, b = now.get(home, 1500.0), now.get(away, 1500.0)
        won = 0.5 + 0.5 * ((scored > conceded) - (scored < conceded))
        gain = 32 * (won - 1 / (1 + 10 ** ((b - a) / 400)))
        now[home], now[away] = a + gain, b - gain
    return now


def table():
    """(place, club, games, points, won, drawn, lost, for, against, difference, rate, rating) of each club, best first."""
    totals = {club: [0] * 6 for club in range(FIRST, LAST + 1)}  # games, won, drawn, lost, for, against
    for _, _, home, away, scored, conceded, _ in games():
        for club, mine, theirs in ((home, scored, conceded), (away, conceded, scored)):
            now = totals[club]
            now[0] += 1
            now[1 if mine > theirs else 2 if mine == theirs else 3] += 1
            now[4] += mine
            now[5] += theirs
    rated = ratings()
    rows = []
    for club, (n, won, drawn, lost, scored, conceded) in totals.items():
        points = 3 * won + drawn
        rows.append((club, n, points, won, drawn, lost, scored, conceded, scored - conceded, round(100 * points / (3 * n), 2), round(rated[club], 4)))
    rows.sort(key=lambda r: (-r[2], -r[3], -r[8], -r[6], r[0]))
    return [(place, *row) for place, row in enumerate(rows, start=1)]


def matches(spark, rows=None, competition="A"):
    rows = games() if rows is None else rows
    return with_result(spark.createDataFrame([(competition, *row) for row in rows], SCHEMA))


def feed_document(rows, scored=lambda row: True):
    """Match feed JSON of ``rows``; unscored ones are ahead. No match id, as in the public feed."""
    def item(row):
        _, rodada, home, away, goals_home, goals_away, date = row
        done = scored(row)
        return {
            "rodada": rodada, "clube_casa_id": home, "clube_visitante_id": away,
            "placar_oficial_mandante": goals_home if done else None,
            "placar_oficial_visitante": goals_away if done else None,
            "partida_data": date.strftime("%Y-%m-%d %H:%M:%S"), "partida_status": "", "local": "São Paulo",
        }

    return json.dumps({"partidas": [item(r) for r in rows]}, ensure_ascii=False)


def club_document():
    return json.dumps({str(c): {"nome": f" Clube {c} ", "abreviacao": f"C{c}", "escudos": {"60x60": f"u{c}"}} for c in range(FIRST, LAST + 1)})
