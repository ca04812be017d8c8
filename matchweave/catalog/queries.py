"""One query per operator, on the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from matchweave.catalog import layers as T
from matchweave.functions import labels, numeric, scoring
from matchweave.operators import (
    accuracy as A, clean, clubrows as C, dataset, elo as E, features as FE, forest, joins as J, latest, quality as Q,
    rating_store as RS, reads as R, standings as ST,
)
from matchweave.plans import marts
from matchweave.session import shared_folder
from matchweave.sources import audit, feeds, league_from_orders as L, tables, views

Query = Callable[[SparkSession, str], DataFrame]
ROW = ("competicao", "clube_id", "rodada", "partida_id")
MATCH = ("competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id", "placar_casa", "placar_vis", "data_partida")
REGISTERED: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTERED[build.__name__] = build
    return build


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return C.club_rows(T.matches(spark, d))


def _window_query(name: str, values: Callable[[], dict]) -> None:
    def build(spark: SparkSession, d: str) -> DataFrame:
        return C.over_clubs(_rows(spark, d), values(), ROW)

    build.__name__ = name
    query(build)


# ---- sources and sinks

@query
def write_read_roundtrip(s, d):
    path = _new_folder(s, "clubes")
    tables.write_table(L.clubs(s, d), path)
    return tables.read_table(s, path)


@query
def ingest_matches(s, d):
    rows = feeds.ingest_matches(L.match_feed(T.raw(s, d)))
    return rows.select(*MATCH, "status", (F.length("raw_payload") > 0).alias("com_payload"))


@query
def ingest_clubs(s, d):
    return feeds.ingest_clubs(L.club_feed(s, d)).drop("raw_payload")


@query
def ingest_athletes(s, d):
    return feeds.ingest_athletes(L.athlete_feed(s, d)).drop("raw_payload")


@query
def ingest_scores(s, d):
    return feeds.ingest_scores(L.score_feed(s, d)).drop("raw_payload")


@query
def ingest_rejects(s, d):
    mixed = L.mixed_payloads(s, d)
    none = feeds.ingest_matches(mixed).groupBy("origem").agg(F.count("*").alias("partidas"))
    return feeds.rejects(mixed).join(none, "origem", "left").select("origem", F.coalesce("partidas", F.lit(0)).alias("partidas"))


@query
def current_round(s, d):
    return feeds.current_round(L.status_payloads(s, d))


@query
def append_dedupe(s, d):
    old = T.raw(s, d).withColumn("placar_casa", F.lit(9))
    day_before = F.when(F.col("partida_id") % 2 == 0, F.col("data_partida")).otherwise(F.col("data_partida") - F.expr("INTERVAL 1 DAY"))
    new = T.raw(s, d).withColumn("data_partida", day_before)
    return latest.append_dedupe(old, new, ["competicao", *latest.MATCH_KEY], ["data_partida", "partida_id"])


@query
def write_guard(s, d):
    path = _new_folder(s, "clubes")
    tables.write_if_nonempty(L.clubs(s, d), path)
    tables.write_if_nonempty(L.clubs(s, d).filter("clube_id < 0"), path)
    return tables.read_table(s, path)


def _upsert(s, d):
    """A table, and changed and added rows for it."""
    target = T.matches(s, d).select(*MATCH)
    changed = target.filter("rodada % 2 = 0").withColumn("placar_casa", F.col("placar_casa") + 1)
    added = target.filter("rodada % 50 = 0").withColumn("rodada", F.col("rodada") + 1000)
    return target, changed.unionByName(added)


@query
def upsert(s, d):
    return tables.upsert(*_upsert(s, d), ["competicao", *latest.MATCH_KEY])


@query
def upsert_partitions(s, d):
    """Into a table by competition and year; a year without changes keeps its files."""
    target, source = (df.withColumn("ano", F.year("data_partida")) for df in _upsert(s, d))
    path = _new_folder(s, "partidas")
    tables.write_table(target.repartition("competicao", "ano"), path, partition_by=["competicao", "ano"])
    tables.upsert_partitions(source, path, ["competicao", *latest.MATCH_KEY], ["competicao", "ano"])
    return s.read.schema(source.schema).parquet(path).select(*MATCH)


@query
def model_register(s, d):
    metrics = {"acuracia": 0.51234567, "f1_score": 0.49876543, "log_loss": 1.01234567}
    new = audit.new_model(s, "previsao_resultados", forest.ALGORITHM, metrics, (10, 12), {"maxDepth": 8}, datetime(2026, 3, 27, 20, 0))
    return audit.register_model(L.registry(s, d), new)


@query
def model_active(s, d):
    return audit.active_version(L.registry(s, d))


@query
def run_audit(s, d):
    path = _new_folder(s, "pipeline_executions")
    tables.write_table(L.runs(s, d), path)
    at = datetime(2026, 3, 27, 20, 0)
    audit.log_run(s, path, "gold", "success", at, at, records=7)
    audit.log_run(s, path, "gold", "failed", at, at, error="tempo esgotado")
    logged = tables.read_table(s, path)
    return logged.groupBy("stage", "status").agg(
        F.count("*").alias("execucoes"), F.sum("records_processed").alias("registros"), F.max("started_at").alias("ultima")
    )


@query
def check_log(s, d):
    path = _new_folder(s, "data_quality_checks")
    audit.log_check(Q.dq_match_keys(T.matches(s, d)), path)
    audit.log_check(Q.dq_row_count(T.store(s, d), "gold.feature_store", "gold_feature_store_count"), path)
    return tables.read_table(s, path)


@query
def model_roundtrip(s, d):
    trained = T.model(s, d)
    path = _new_folder(s, "modelo")
    audit.save_model(trained, path)
    rows = T.split(s, d).filter("conjunto = 'teste'").select("partida_id", *J.FEATURES)
    first, second = (forest.score(m, rows).select("partida_id", "previsao", "confianca") for m in (trained, audit.load_model(path)))
    again = second.withColumnsRenamed({"previsao": "previsao_lida", "confianca": "confianca_lida"})
    same = (F.col("previsao") == F.col("previsao_lida")) & (F.col("confianca") == F.col("confianca_lida"))
    return first.join(again, "partida_id").agg(F.count("*").alias("partidas"), F.sum(same.cast("bigint")).alias("iguais"))


@query
def materialize(s, d):
    return views.read_view(s, tables.materialize(L.clubs(s, d), "gold", "clubes_publicados", "view"))


def _registered(s, d, name: str) -> DataFrame:
    standard = marts.standard_views(T.store(s, d), L.clubs(s, d), _ahead(s, d), _validated(s, d))
    views.register_views(standard | {"previsoes_proximas_partidas": _ahead(s, d)})
    return views.read_view(s, name)


@query
def published_predictions(s, d):
    return _registered(s, d, "gold_vw_previsoes")


@query
def published_accuracy(s, d):
    return _registered(s, d, "gold_vw_desempenho_modelo")


@query
def published_alias(s, d):
    return _registered(s, d, "diamond_previsoes_proximas_partidas")


@query
def published_views(s, d):
    standard = marts.standard_views(T.store(s, d), L.clubs(s, d), _ahead(s, d), _validated(s, d))
    views.register_views(standard | {"previsoes_proximas_partidas": _ahead(s, d)})
    table, ranking = (views.read_view(s, v) for v in ("gold_vw_classificacao", "gold_vw_elo_ranking"))
    rows = [
        table.select("competicao", F.lit("vw_classificacao").alias("visao"), "clube_id", F.col("posicao").alias("valor")),
        ranking.select("competicao", F.lit("vw_elo_ranking").alias("visao"), "clube_id", F.col("ranking").alias("valor")),
    ]
    return Q.union_reports(*rows)


# ---- projections, filters, labels

@query
def match_result(s, d):
    return clean.with_result(T.raw(s, d)).select("competicao", "partida_id", "resultado")


@query
def played(s, d):
    return clean.played(T.matches(s, d))


@query
def upcoming(s, d):
    return clean.upcoming(T.matches(s, d))


@query
def points(s, d):
    return T.matches(s, d).filter("resultado IS NOT NULL").select(
        "partida_id", *[scoring.points("resultado", v).alias(f"pontos_{v}") for v in (scoring.HOME, scoring.AWAY)]
    )


@query
def outcome_flags(s, d):
    flags = [c.alias(f"{n}_{v}") for v in (scoring.HOME, scoring.AWAY) for n, c in scoring.outcome_flags("resultado", v).items()]
    return T.matches(s, d).filter("resultado IS NOT NULL").select("partida_id", *flags)


def _table_places(s, d):
    return ST.standings_rank(T.latest(s, d))


@query
def zone(s, d):
    return _table_places(s, d).select("competicao", "clube_id", "posicao", labels.zone().alias("situacao"))


@query
def zone_color(s, d):
    return _table_places(s, d).select("competicao", "clube_id", "posicao", labels.zone_color().alias("cor_situacao"))


@query
def pct_round(s, d):
    columns = {"aprov_1": ("aproveitamento_pct", 1), "aprov_0": ("aproveitamento_pct", 0), "saldo_medio": ("saldo_medio", 2)}
    mean = T.store(s, d).withColumn("saldo_medio", F.col("saldo_gols") / F.col("rodada"))
    return mean.select("competicao", "rodada", "clube_id", *[numeric.half_up(F.col(c), n).alias(a) for a, (c, n) in columns.items()])


def _with_unknown(rows: DataFrame, club: str) -> DataFrame:
    """Every third club under an id that no club has."""
    return rows.withColumn(club, F.when(F.col(club) % 3 == 0, F.col(club) + 10**12).otherwise(F.col(club)))


@query
def display_name(s, d):
    named = J.join_club_names(_with_unknown(T.predictions(s, d), "clube_casa_id"), L.clubs(s, d).withColumnRenamed("nome", "clube"), ("clube",))
    return named.select("id", *[labels.display_name(f"nome_{x}", f"clube_{x}", f"clube_{x}_id").alias(f"nome_{x}") for x in J.SIDES])


def _validated(s, d):
    return L.validated_of(T.predictions(s, d))


def _ahead(s, d):
    return T.predictions(s, d).filter("resultado IS NULL").drop("resultado")


@query
def hit(s, d):
    return T.predictions(s, d).select("id", scoring.hit("previsao", "resultado").alias("acerto"))


@query
def confidence_band(s, d):
    perf = A.mart_performance(_validated(s, d))
    return perf.select(
        "competicao", "rodada", labels.confidence_band("acuracia_pct").alias("faixa"),
        labels.confidence_band("acuracia_empate_pct").alias("faixa_empate"),
    )


@query
def published_shape(s, d):
    shape = tables.read_table(s, f"{d}/supplier.parquet").select(
        F.col("s_suppkey").cast("int").alias("clube_id"), F.trim("s_name").alias("nome"),
        F.col("s_acctbal").cast("decimal(12,2)").cast("double").alias("saldo"),
    )
    return shape


@query
def payload_nonempty(s, d):
    kept = Q.payload_nonempty(feeds.ingest_clubs(L.club_feed(s, d)))
    return kept.agg(F.count("*").alias("com_payload"), F.countDistinct("clube_id").alias("clubes"))


@query
def silver_matches(s, d):
    return clean.silver_matches(L.raw_matches(s, d))


@query
def silver_matches_played(s, d):
    return clean.silver_matches(L.raw_matches(s, d), played_only=True)


@query
def one_match_per_round(s, d):
    return L.matches(T.raw(s, d))


@query
def silver_clubs(s, d):
    return clean.silver_clubs(L.raw_clubs(s, d), order=["entrada"])


@query
def silver_player_scores(s, d):
    return clean.silver_player_scores(L.scores(s, d), L.athletes(s, d))


@query
def silver_player_scores_dedup(s, d):
    return clean.silver_player_scores(L.scores(s, d), L.athletes(s, d), dedupe=True)


# ---- joins

@query
def join_score_position(s, d):
    return clean.join_score_position(L.scores(s, d), L.athletes(s, d))


@query
def join_features(s, d):
    return J.join_features(T.enhanced_sql(s, d), T.store(s, d))


def _state(s, d):
    return J.join_features(T.enhanced_sql(s, d), T.store(s, d))


@query
def join_match_features(s, d):
    return J.join_match_features(T.matches(s, d).select("competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id"), _state(s, d))


@query
def join_club_names(s, d):
    return J.join_club_names(T.matches(s, d).select("partida_id", "clube_casa_id", "clube_vis_id"), L.clubs(s, d), ("nome", "abreviacao"))


@query
def join_prediction_result(s, d):
    preds = T.predictions(s, d).drop("resultado").select("competicao", "rodada", "clube_casa_id", "clube_vis_id", "previsao")
    return J.join_prediction_result(preds, T.matches(s, d))


@query
def join_latest_round(s, d):
    return J.join_latest_round(T.store(s, d))


def _fixtures(s, d):
    return clean.upcoming(T.matches(s, d)).select("competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id")


@query
def features_exact(s, d):
    return J.match_features(_fixtures(s, d), _state(s, d), mode="exact")


@query
def features_asof(s, d):
    every = T.matches(s, d).select("competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id")
    return J.match_features(every, _state(s, d), mode="asof")


@query
def join_latest_six(s, d):
    table = T.latest(s, d)
    ratings = latest.latest_per_key(T.enhanced_sql(s, d), ["competicao", "clube_id"], ["rodada"])
    wide = J.join_latest_six(_ahead(s, d), L.clubs(s, d), table, ratings)
    joined = ("clube_nome", "abreviacao", "escudo_url", "pontos_acumulados", "aproveitamento_pct", "elo_rating")
    return wide.select("id", *[f"{column}_{side}" for column in joined for side in J.SIDES])


@query
def join_standings(s, d):
    table = T.latest(s, d).select("competicao", "clube_id", "rodada", "pontos_acumulados")
    return J.join_standings(table, L.clubs(s, d), T.risk(s, d))


@query
def join_venue_rates(s, d):
    rows = _rows(s, d)
    rates = C.over_clubs(rows, C.venue_rate_incl(default=None), ["competicao", "clube_id", "rodada", "eh_casa"])
    form = rows.select("competicao", "clube_id", "rodada", "pontos")
    return J.join_venue_rates(form, rates.filter("eh_casa"), rates.filter("NOT eh_casa"))


@query
def join_relegation_name(s, d):
    table = J.join_latest_round(T.store(s, d)).select("competicao", "clube_id", "pontos_acumulados")
    table = _with_unknown(table, "clube_id")
    both = [J.join_relegation_name(table, L.clubs(s, d), how).withColumn("tipo", F.lit(how)) for how in ("left", "inner")]
    return both[0].unionByName(both[1])


# ---- aggregations

@query
def last_round(s, d):
    return J.last_round(T.matches(s, d))


@query
def accuracy_by_round(s, d):
    return A.accuracy_by_round(_validated(s, d))


@query
def accuracy_by_class(s, d):
    return A.accuracy_by_class(_validated(s, d))


@query
def confidence_hit_miss(s, d):
    return A.confidence_hit_miss(_validated(s, d))


@query
def accuracy_view(s, d):
    return A.accuracy_view(_validated(s, d))


@query
def distinct_clubs(s, d):
    return R.distinct_clubs(L.raw_clubs(s, d))


@query
def row_counts(s, d):
    return R.row_counts(
        {"silver.partidas": T.matches(s, d), "silver.clubes": L.clubs(s, d), "gold.feature_store": T.store(s, d),
         "gold.previsoes_validadas": _validated(s, d), "gold.pipeline_executions": L.runs(s, d)}
    )


@query
def kpi_summary(s, d):
    return R.kpi_summary(A.mart_performance(_validated(s, d)), _ahead(s, d), L.registry(s, d))


@query
def bi_max_topn(s, d):
    risk = T.risk(s, d)
    table = ST.view_standings(T.current(s, d), L.clubs(s, d))
    charts = {
        "rebaixamento": R.bi_max_topn(risk, ["nome_clube"], "prob_rebaixamento", 20),
        "pontos": R.bi_max_topn(table, ["nome"], F.col("pontos").cast("double"), 20),
        "confianca": R.bi_max_topn(_ahead(s, d), ["clube_casa_id", "clube_vis_id"], "confianca", 10),
        "acuracia": R.bi_max_topn(A.accuracy_by_round(_validated(s, d)), ["rodada"], "acuracia_pct", 50),
        "elo": R.bi_max_topn(T.enhanced_sql(s, d), ["clube_id"], "elo_rating", 20),
        "forma": R.bi_max_topn(T.enhanced_sql(s, d), ["clube_id"], "media_pontos_5j", 20),
    }
    parts = []
    for name, chart in charts.items():
        label_of = F.concat_ws("-", *[F.col(c).cast("string") for c in chart.columns if c != "valor"])
        parts.append(chart.select(F.lit(name).alias("grafico"), label_of.alias("rotulo"), "valor"))
    return Q.union_reports(*parts)


@query
def bi_count_by(s, d):
    zones = _table_places(s, d).select(labels.zone().alias("rotulo"))
    by_class = R.bi_count_by(_ahead(s, d).withColumnRenamed("previsao", "rotulo"), ["rotulo"])
    return by_class.withColumn("grafico", F.lit("previsao")).unionByName(
        R.bi_count_by(zones, ["rotulo"]).withColumn("grafico", F.lit("situacao"))
    )


@query
def class_weights(s, d):
    return dataset.class_weights(clean.played(T.matches(s, d)))


# ---- unpivot and windows

@query
def club_rows(s, d):
    return _rows(s, d)


for _name, _values in {
    "cum_stats": C.cum_stats,
    "goal_diff": C.goal_diff,
    "goal_diff_double": C.goal_diff_double,
    "games": C.games,
    "success_rate": lambda: {"taxa": C.success_rate()["aproveitamento_pct"], "taxa_2": C.success_rate(digits=2)["aproveitamento_pct"]},
    "form5_prior": C.form5_prior,
    "form_incl": C.form_incl,
    "venue_rate_prior": C.venue_rate_prior,
    "venue_rate_incl": C.venue_rate_incl,
    "venue_points_pct": C.venue_points_pct,
    "momentum_sum3": C.momentum_sum3,
    "momentum_diff": C.momentum_diff,
    "momentum_weighted": C.momentum_weighted,
}.items():
    _window_query(_name, _values)


@query
def elo(s, d):
    rated = E.elo(T.matches(s, d))
    return rated.select("competicao", "partida_id", *[F.round(c, 6).alias(c) for c in E.PRE])


def _by_window(rated: DataFrame) -> DataFrame:
    return rated.select("competicao", "partida_id", *[F.round(c, 6).alias(c) for c in E.PRE])


@query
def elo_by_window(s, d):
    """Half-year windows, each one's components in parallel."""
    return _by_window(RS.elo_by_window(T.matches(s, d), _new_folder(s, "elo"), days=182))


@query
def elo_rerated(s, d):
    """A store of what was known in mid-2000, with the results of that year the other way round, brought up to date."""
    matches, year = T.matches(s, d), F.lit("2000-01-01").cast("timestamp_ntz")
    turned = F.when(F.col("data_partida") < year, F.col("resultado")).when(F.col("resultado") == "casa", "visitante").when(F.col("resultado") == "visitante", "casa").otherwise(F.col("resultado"))
    known = matches.filter(F.col("data_partida") < F.lit("2000-07-01").cast("timestamp_ntz")).withColumn("resultado", turned)
    store = RS.RatingStore(s, _new_folder(s, "elo"), days=182, every=4)
    store.update(known)
    store.update(matches)
    return _by_window(store.rated())


@query
def elo_additive(s, d):
    return E.elo_additive(_rows(s, d), L.base_ratings(s, d), ROW)


@query
def elo_simplified(s, d):
    form, rates = C.form_incl(), C.venue_rate_incl(default=None)
    rating = E.elo_simplified(rates["aproveitamento_casa"], rates["aproveitamento_fora"], form["media_pontos_5j"])
    return C.over_clubs(_rows(s, d), {"elo_rating": rating}, ROW)


@query
def round_club_grid(s, d):
    return FE.round_club_grid(T.matches(s, d))


def _last_rounds(s, d):
    return T.matches(s, d).filter("resultado IS NOT NULL").groupBy("competicao").agg(F.max("rodada").alias("rodada"))


@query
def grid_last_round(s, d):
    """Every club in the last round of its competition, looked up in the intervals."""
    return FE.round_club_grid(T.matches(s, d), rounds=_last_rounds(s, d))


@query
def standings_rank(s, d):
    return _table_places(s, d)


@query
def points_rank(s, d):
    return ST.points_rank(T.latest(s, d))


@query
def relegation_rank(s, d):
    return ST.relegation_rank(T.latest(s, d))


@query
def accuracy_moving(s, d):
    return A.accuracy_moving(A.accuracy_by_round(_validated(s, d)))


@query
def latest_per_key(s, d):
    return latest.latest_per_key(T.store(s, d), ["competicao", "clube_id"], ["rodada"])


# ---- read queries

def _mart_predictions(s, d):
    return marts.mart_predictions(_ahead(s, d), L.clubs(s, d), T.store(s, d), T.enhanced_sql(s, d))


def _mart_standings(s, d):
    clubs = L.clubs(s, d)
    return ST.mart_standings(T.latest(s, d), clubs, T.risk(s, d))


@query
def top_predictions(s, d):
    return R.top_predictions(_mart_predictions(s, d)).select("rodada", "id", "nome_casa", "nome_visitante", "prob_casa_pct")


@query
def top_standings(s, d):
    return R.top_standings(_mart_standings(s, d)).select("competicao", "posicao", "clube", "pontos", "situacao")


@query
def top_ranking(s, d):
    return R.top_ranking(ST.view_ranking(T.current(s, d), L.clubs(s, d)))


@query
def performance_by_round(s, d):
    return R.performance_by_round(A.mart_performance(_validated(s, d)))


@query
def latest_models(s, d):
    return R.latest_models(L.registry(s, d))


@query
def latest_runs(s, d):
    return R.latest_runs(L.runs(s, d))


@query
def relegation_sorted(s, d):
    return R.relegation_sorted(_mart_standings(s, d))


@query
def predictions_view(s, d):
    return R.predictions_view(_ahead(s, d))


@query
def best_round(s, d):
    return R.best_round(A.mart_performance(_validated(s, d)))


@query
def latest_rounds(s, d):
    return R.latest_rounds(A.mart_performance(_validated(s, d)))


@query
def confidence_gap(s, d):
    return R.confidence_gap(A.mart_performance(_validated(s, d)))


@query
def bi_table(s, d):
    table = ST.view_standings(T.current(s, d), L.clubs(s, d))
    risk = T.risk(s, d)
    perf = A.mart_performance(_validated(s, d))
    charts = {
        "classificacao": R.bi_table(table.withColumnsRenamed({"clube_id": "rotulo", "posicao": "valor"}), ["competicao", "rotulo", "valor"], ["valor", "competicao"], 20),
        "rebaixamento": R.bi_table(risk.withColumnsRenamed({"clube_id": "rotulo", "prob_rebaixamento": "valor"}), ["competicao", "rotulo", "valor"], [F.desc("valor"), "competicao", "rotulo"], 25),
        "previsoes": R.bi_table(_ahead(s, d).withColumnsRenamed({"id": "rotulo", "confianca": "valor"}), ["competicao", "rotulo", "valor"], [F.desc("valor"), "rotulo"], 10),
        "acuracia": R.bi_table(perf.withColumnsRenamed({"rodada": "rotulo", "acuracia_pct": "valor"}), ["competicao", "rotulo", "valor"], ["rotulo", "competicao"], 50),
    }
    return Q.union_reports(*[
        c.select(F.lit(n).alias("grafico"), "competicao", F.col("rotulo").cast("bigint"), F.col("valor").cast("double"))
        for n, c in charts.items()
    ])


# ---- feature stores and marts

@query
def feature_store(s, d):
    return FE.feature_store(T.matches(s, d))


@query
def feature_store_job(s, d):
    return FE.feature_store(T.matches(s, d), variant="job")


@query
def features_job(s, d):
    return FE.features_job(T.matches(s, d)).withColumn("elo_rating", F.round("elo_rating", 6))


@query
def features_sql(s, d):
    return FE.features_sql(T.matches(s, d))


@query
def features_seed(s, d):
    return FE.features_seed(T.matches(s, d), L.base_ratings(s, d))


@query
def seed_last_round(s, d):
    return FE.features_seed(T.matches(s, d), L.base_ratings(s, d), rounds=_last_rounds(s, d))


@query
def mart_standings(s, d):
    return _mart_standings(s, d)


@query
def view_standings(s, d):
    return ST.view_standings(T.current(s, d), L.clubs(s, d))


@query
def mart_predictions(s, d):
    return _mart_predictions(s, d)


@query
def performance_from_counts(s, d):
    """Counts of the first seasons, the last of their rounds counted wrongly, brought up to date by those of that round and after."""
    validated, last = _validated(s, d), F.lit(170)
    wrong = validated.filter(F.col("rodada") <= last).withColumn("acerto", F.col("acerto") & (F.col("rodada") < last))
    counts = A.merge_counts(A.round_counts(wrong), A.round_counts(validated.filter(F.col("rodada") >= last)))
    return A.performance_from_counts(counts)


@query
def mart_performance(s, d):
    return A.mart_performance(_validated(s, d))


# ---- training, prediction, risk

def _rounded_elo(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in E.PRE})


@query
def training_set(s, d):
    return _rounded_elo(dataset.training_set(T.matches(s, d), T.enhanced_job(s, d), T.store_job(s, d)))


@query
def training_set_lagged(s, d):
    return _rounded_elo(dataset.training_set(T.matches(s, d), T.enhanced_job(s, d), T.store(s, d), lagged=True))


@query
def time_split(s, d):
    return dataset.time_split(T.training(s, d)).select("competicao", "partida_id", "rodada", "conjunto")


@query
def train_forest(s, d):
    metrics = forest.model_metrics(T.model(s, d), T.split(s, d).filter("conjunto = 'teste'"))
    inside = [F.lit(0 <= metrics[n] <= 1).alias(n) for n in ("acuracia", "f1_score")] + [F.lit(metrics["log_loss"] > 0).alias("log_loss")]
    return forest.split_rounds(T.split(s, d)).select(F.lit(forest.ALGORITHM).alias("algoritmo"), *inside, "rodada_treino", "rodada_teste", "linhas_treino", "linhas_teste")


@query
def model_metrics(s, d):
    return A.prediction_metrics(_validated(s, d))


@query
def features_ahead(s, d):
    state = FE.model_state(T.matches(s, d), ahead=True)
    return _rounded_elo(J.features_ahead(_fixtures(s, d), state))


@query
def training_rows(s, d):
    return _rounded_elo(T.training(s, d))


@query
def predict(s, d):
    fixtures = J.features_ahead(_fixtures(s, d), FE.model_state(T.matches(s, d), ahead=True))
    ahead = forest.predict(T.model(s, d), J.join_club_names(fixtures, L.clubs(s, d)), "v1")
    chances = {"casa": "prob_casa", "empate": "prob_empate", "visitante": "prob_visitante"}
    own = F.coalesce(*[F.when(F.col("previsao") == label, F.col(column)) for label, column in chances.items()])
    return ahead.select(
        "competicao", "partida_id", "rodada", "clube_casa_id", "clube_vis_id", "nome_casa", "nome_vis", "modelo_versao",
        (F.abs(F.col("prob_casa") + F.col("prob_empate") + F.col("prob_visitante") - 1) < 1e-9).alias("soma_um"),
        ((own == F.col("confianca")) & (own == F.greatest(*chances.values()))).alias("maior"),
    )


@query
def validate_predictions(s, d):
    joined = J.join_prediction_result(T.predictions(s, d).drop("resultado"), T.matches(s, d))
    return A.validate_predictions(joined)


@query
def relegation_risk(s, d):
    return ST.relegation_risk(T.current(s, d), L.clubs(s, d))


@query
def relegation_piecewise(s, d):
    ranked = ST.relegation_rank(T.latest(s, d))
    return ST.relegation_piecewise(ranked).select("competicao", "clube_id", "posicao", "prob_rebaixamento", "zona_rebaixamento")


@query
def min_sample_guard(s, d):
    parts = {"todas": T.training(s, d), "nenhuma": T.training(s, d).filter("rodada < 0")}
    return Q.union_reports(*[
        rows.agg(F.count("*").alias("linhas")).select(
            F.lit(name).alias("conjunto"), "linhas",
            F.lit("success" if dataset.enough_rows(rows) else "skipped").alias("status"),
        )
        for name, rows in parts.items()
    ])


@query
def accuracy_gate(s, d):
    return Q.accuracy_gate(A.prediction_metrics(_validated(s, d)))


@query
def no_model_guard(s, d):
    paths = {"salvo": T.model_path(s, d), "ausente": T.model_path(s, d) + "-ausente"}
    ahead = clean.upcoming(T.matches(s, d)).agg(F.count("*").alias("partidas"))
    return Q.union_reports(*[
        ahead.select(F.lit(n).alias("modelo"), F.lit("success" if audit.model_exists(s, p) else "skipped").alias("status"), "partidas")
        for n, p in paths.items()
    ])


# ---- data quality

@query
def dq_row_count(s, d):
    return Q.union_reports(
        Q.dq_row_count(T.matches(s, d), "silver.partidas", "silver_partidas_count"),
        Q.dq_row_count(T.matches(s, d).filter("rodada < 0"), "silver.vazia", "silver_vazia_count"),
    )


@query
def dq_not_null(s, d):
    return Q.dq_not_null(T.matches(s, d), "silver.partidas", ["rodada", "clube_casa_id", "clube_vis_id", "placar_casa"])


@query
def dq_unique(s, d):
    return Q.union_reports(
        Q.dq_unique(L.raw_clubs(s, d), "bronze.clubes_info_raw", ["clube_id"]),
        Q.dq_unique(T.matches(s, d), "silver.partidas", ["partida_id"]),
    )


@query
def dq_accepted(s, d):
    known = F.col("resultado").isNotNull()
    return Q.union_reports(
        Q.dq_accepted(T.matches(s, d), "silver.partidas", "resultado", A.CLASSES, known),
        Q.dq_accepted(T.matches(s, d), "silver.partidas_sem_empate", "resultado", ("casa", "visitante"), known),
    )


@query
def dq_range(s, d):
    return Q.union_reports(
        Q.dq_range(T.store(s, d), "gold.feature_store", "aproveitamento_pct", 0, 100),
        Q.dq_range(T.store(s, d), "gold.feature_store", "saldo_gols", 0, 10),
    )


@query
def dq_prob_sum(s, d):
    return Q.dq_prob_sum(T.predictions(s, d), "gold.previsoes_proximas_partidas")


@query
def dq_bounds(s, d):
    risk = T.risk(s, d)
    return Q.union_reports(
        Q.dq_bounds(T.store(s, d), "gold.feature_store", {"pontos_acumulados": (0, None), "aproveitamento_pct": (0, 100), "gols_sofridos": (None, 50)}),
        Q.dq_bounds(risk, "gold.analise_rebaixamento", {"prob_rebaixamento": (0, 1)}),
        Q.dq_bounds(A.accuracy_view(_validated(s, d)), "gold.vw_desempenho_modelo", {"acuracia_pct": (0, 100)}),
    )


@query
def dq_positions(s, d):
    return Q.dq_positions(ST.view_standings(T.current(s, d), L.clubs(s, d)))


@query
def dq_match_keys(s, d):
    elo_range = Q.dq_elo_range(T.enhanced_sql(s, d), "gold.feature_store_enhanced")
    return Q.union_reports(Q.dq_match_keys(clean.with_result(T.raw(s, d))), elo_range)


@query
def dq_status(s, d):
    checks = L.runs(s, d).select(F.col("stage").alias("check_name"), "status")
    return Q.dq_status(L.runs(s, d), checks)


@query
def dq_predictions(s, d):
    return Q.dq_predictions(_ahead(s, d))


@query
def dq_feature_keys(s, d):
    risk = T.risk(s, d)
    return Q.union_reports(
        Q.dq_feature_keys(T.store(s, d), "gold.feature_store"),
        Q.dq_feature_keys(T.enhanced_sql(s, d), "gold.feature_store_enhanced"),
        Q.dq_feature_keys(risk, "gold.analise_rebaixamento", columns=("clube_id",)),
    )
