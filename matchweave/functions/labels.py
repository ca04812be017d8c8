"""Published labels: table zones, colours, confidence bands, display names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# First place, last place, label, colour of each table zone.
ZONES = [
    (1, 4, "Libertadores (fase de grupos)", "#1a7a1a"),
    (5, 6, "Libertadores (pre-fase)", "#2e8b57"),
    (7, 12, "Sul-Americana", "#4682b4"),
    (17, 20, "Rebaixamento", "#cc2222"),
]
OTHER_ZONE = ("Meio de tabela", "#666666")

# Lower bound in percent of each confidence band.
BANDS = [(70, "alta"), (50, "media")]
LOWEST_BAND = "baixa"


def _by_place(place: str, which: int) -> Column:
    values = [F.when(F.col(place).between(z[0], z[1]), z[2 + which]) for z in ZONES]
    return F.coalesce(*values, F.lit(OTHER_ZONE[which]))


def zone(place: str = "posicao") -> Column:
    return _by_place(place, 0)


def zone_color(place: str = "posicao") -> Column:
    return _by_place(place, 1)


def confidence_band(pct: str) -> Column:
    value = F.coalesce(F.col(pct), F.lit(0.0))
    bands = [F.when(value >= low, name) for low, name in BANDS]
    return F.coalesce(*bands, F.lit(LOWEST_BAND))


def display_name(stored: str, club_name: str, club_id: str) -> Column:
    """Stored name, else the club table's, else ``Clube <id>``."""
    return F.coalesce(F.col(stored), F.col(club_name), F.concat(F.lit("Clube "), F.col(club_id).cast("string")))
