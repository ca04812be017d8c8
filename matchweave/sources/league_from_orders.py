"""League facts derived from the star-schema test tables.

A competition is an order priority, a club a supplier, a match an order that two
suppliers served, a round a week. See FIXTURES.md part B.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matchweave.operators.clean import one_match_per_round, silver_matches
from matchweave.functions.scoring import AWAY, DRAW, HOME
from matchweave.sources.tables import read_table

EPOCH = "1995-01-01"
FIRST_UNPLAYED = "2001-01-01"
EVENTS_EPOCH = "2024-01-01"
GOALS_MODULUS = 5
PAGE = 64
#: Order lines that one task adds up.
LINES = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def raw_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1: one scan and one exchange of lineitem, by order, which the join with orders uses again.

    The tasks follow the number of lines, which the files' footers tell, so the sums that a task holds do not grow with the table.
    """
    lines = table(spark, sf_dir, "lineitem")
    tasks = max(-(-lines.count() // LINES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    items = lines.select("l_orderkey", "l_suppkey", "l_quantity").repartition(tasks, "l_orderkey")
    sold = items.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    sides = sold.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("lo"),
        F.max("l_suppkey").alias("hi"),
        F.min_by("q", "l_suppkey").alias("q_lo"),
        F.max_by("q", "l_suppkey").alias("q_hi"),
    ).filter("lo <> hi")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    both = orders.join(sides, orders.o_orderkey == sides.l_orderkey)
    even = F.col("o_orderkey") % 2 == 0
    unplayed = F.col("o_orderdate") >= F.lit(FIRST_UNPLAYED).cast("timestamp_ntz")

    def score(when_even: str, when_odd: str) -> Column:
        goals = F.when(even, F.col(when_even)).otherwise(F.col(when_odd)).cast("int") % GOALS_MODULUS
        return F.when(~unplayed, goals)

    return both.select(
        F.col("o_orderpriority").alias("competicao"),
        F.col("o_orderkey").alias("partida_id"),
        week(F.col("o_orderdate")).alias("rodada"),
        F.when(even, F.col("lo")).otherwise(F.col("hi")).alias("clube_casa_id"),
        F.when(even, F.col("hi")).otherwise(F.col("lo")).alias("clube_vis_id"),
        score("q_lo", "q_hi").alias("placar_casa"),
        score("q_hi", "q_lo").alias("placar_vis"),
        F.col("o_orderdate").alias("data_partida"),
    )


def week(date: Column) -> Column:
    return (F.floor(F.datediff(date, F.lit(EPOCH).cast("date")) / 7) + 1).cast("int")


def matches(raw: DataFrame) -> DataFrame:
    """F-1s: clean matches of the raw ones, one per club and round."""
    return one_match_per_round(silver_matches(raw))


def raw_clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-2 with blanks to trim, and every club twice: an older and a newer entry."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    named = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    blank = F.lit("  ")
    return named.select(
        F.col("s_suppkey").alias("clube_id"),
        F.concat(blank, "s_name", blank).alias("nome"),
        F.concat(F.upper(F.substring("n_name", 1, 3)), blank).alias("abreviacao"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("entrada"),
        F.concat("s_name", F.lit("/"), "n_name").alias("escudo"),
    ).select("clube_id", "nome", "abreviacao", F.concat("escudo", F.lit("#"), F.col("entrada")).alias("escudo_url"), "entrada")


def clubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-2: one row per club."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("clube_id"),
        F.col("s_name").alias("nome"),
        F.upper(F.substring("n_name", 1, 3)).alias("abreviacao"),
        F.concat("s_name", F.lit("/"), "n_name").alias("escudo_url"),
    )


def base_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base Elo per club, 1400 to 1680 in steps of 20."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("clube_id"), (1400.0 + (F.col("s_suppkey") % 15) * 20).alias("elo_base")
    )


def event_day(ts: Column) -> Column:
    return (F.datediff(ts, F.lit(EVENTS_EPOCH).cast("date")) + 1).cast("int")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3 scores: an event is an athlete's score."""
    return table(spark, sf_dir, "events").select(
        event_day(F.col("ts")).alias("rodada"),
        F.col("user_id").alias("atleta_id"),
        (F.col("user_id") % 10).alias("clube_id"),
        F.col("value").alias("pontos"),
    )


def athletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-3 status: one in ten athletes has none."""
    user = F.col("user_id")
    return table(spark, sf_dir, "events").filter(user % 10 != 0).select(
        user.alias("atleta_id"), (user % 6).cast("int").alias("posicao_id"), (user % 8).cast("int").alias("status_id")
    ).distinct()


#: Made-up probabilities (casa, empate, visitante) by predicted class; each row sums to one.
PROBABILITIES = {HOME: (0.61, 0.22, 0.17), DRAW: (0.31, 0.41, 0.28), AWAY: (0.16, 0.24, 0.6)}
CLASS_BY_REMAINDER = (HOME, DRAW, AWAY)


def predictions_of(facts: DataFrame) -> DataFrame:
    """F-5: a prediction for every match; some without stored names."""
    predicted = F.element_at(F.array(*map(F.lit, CLASS_BY_REMAINDER)), (F.col("partida_id") % 3 + 1).cast("int"))
    table_of = F.create_map(*[x for c, p in PROBABILITIES.items() for x in (F.lit(c), F.array(*map(F.lit, p)))])
    names = {
        f"nome_{side}": F.when(F.col("partida_id") % 5 != 0, F.concat(F.lit("Time "), f"clube_{side}_id"))
        for side in ("casa", "vis")
    }
    probs = F.element_at(table_of, F.col("previsao"))
    return (
        facts.withColumn("previsao", predicted)
        .withColumn("_p", probs)
        .select(
            "competicao", F.col("partida_id").alias("id"), "rodada", "clube_casa_id", "clube_vis_id",
            *[c.alias(n) for n, c in names.items()],
            *[F.col("_p")[i].alias(f"prob_{c}") for i, c in enumerate((HOME, DRAW, AWAY))],
            "previsao", F.array_max("_p").alias("confianca"),
            F.lit("v1").alias("modelo_versao"), F.col("data_partida").alias("processed_at"), "resultado",
        )
    )


def validated_of(predicted: DataFrame) -> DataFrame:
    """Predictions of played matches with their stored hit flag."""
    known = predicted.filter("resultado IS NOT NULL").withColumnRenamed("resultado", "resultado_real")
    return known.withColumn("acerto", F.col("previsao") == F.col("resultado_real"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-6 model registry: a part is a trained model."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("modelo_nome"),
        F.concat(F.lit("v"), key).alias("versao"),
        F.col("p_brand").alias("algoritmo"),
        (key % 97 / 100.0).alias("acuracia"),
        (key % 89 / 100.0).alias("f1_score"),
        (key % 83 / 50.0).alias("log_loss"),
        (key % 30).cast("int").alias("rodada_treino"),
        (key % 30 + 8).cast("int").alias("rodada_teste"),
        F.to_json(F.struct(F.col("p_size").alias("max_depth"))).alias("parametros"),
        (key % 7 == 0).alias("ativo"),
        F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, cast(p_partkey as int))").alias("processed_at"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-6 audit log: an event is a stage run."""
    seconds = F.floor("value").cast("bigint")
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("value") < 1, "skipped").otherwise("success")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit("liga").alias("pipeline_name"),
        F.col("event_type").alias("stage"),
        status.alias("status"),
        F.col("ts").cast("timestamp_ntz").alias("started_at"),
        F.expr("cast(ts as timestamp_ntz) + make_dt_interval(0, 0, 0, cast(floor(value) as int))").alias("finished_at"),
        seconds.alias("duration_seconds"),
        F.get_json_object("props", "$.k").cast("bigint").alias("records_processed"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
    )


def _paged(df: DataFrame, group: list[str], id_column: str, element: Column, as_map: bool, root: str | None) -> DataFrame:
    """JSON documents of at most ``PAGE`` ids each, the way a paged feed lands."""
    paged = df.withColumn("_page", F.expr(f"{id_column} div {PAGE}")).groupBy(*group, "_page")
    if as_map:
        items = F.map_from_entries(F.collect_list(F.struct(F.col(id_column).cast("string"), element)))
    else:
        items = F.collect_list(element)
    docs = paged.agg(items.alias(root or "items"))
    body = F.to_json(F.struct(root)) if root else F.to_json(F.col("items"))
    return docs.select(*group, body.alias("payload"))


def match_feed(raw: DataFrame) -> DataFrame:
    """F-4: every seventh match lacks its round, every fifth its date."""
    key = F.col("partida_id")
    element = F.struct(
        key,
        F.when(key % 7 != 0, F.col("rodada")).alias("rodada"),
        "clube_casa_id",
        F.col("clube_vis_id").alias("clube_visitante_id"),
        F.col("placar_casa").alias("placar_oficial_mandante"),
        F.col("placar_vis").alias("placar_oficial_visitante"),
        F.when(key % 5 != 0, F.col("data_partida").cast("timestamp_ntz").cast("string")).alias("partida_data"),
        F.when(F.col("placar_casa").isNotNull(), "Encerrada").alias("partida_status"),
    )
    return _paged(raw, ["competicao"], "partida_id", element, False, "partidas")


def club_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.struct(
        "nome", "abreviacao",
        F.when(F.col("clube_id") % 4 != 0, F.struct(F.col("escudo_url").alias("60x60"))).alias("escudos"),
    )
    return _paged(clubs(spark, sf_dir), [], "clube_id", element, True, None)


def athlete_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    element = F.struct(
        "atleta_id", F.concat(F.lit("Atleta "), "atleta_id").alias("apelido"),
        F.when(F.col("atleta_id") % 4 != 0, F.col("atleta_id") % 10).alias("clube_id"), "posicao_id", "status_id",
    )
    return _paged(athletes(spark, sf_dir), [], "atleta_id", element, False, "atletas")


def score_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per round and page; an athlete's best score of the round."""
    best = scores(spark, sf_dir).groupBy("rodada", "atleta_id").agg(F.max("pontos").alias("pontos"), F.max("clube_id").alias("clube_id"))
    element = F.struct("clube_id", F.when(F.col("atleta_id") % 4 != 0, F.col("pontos")).alias("pontuacao"))
    return _paged(best, ["rodada"], "atleta_id", element, True, "atletas")


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that are no feed documents: event properties and prose."""
    events = table(spark, sf_dir, "events").select(F.concat(F.lit("e"), "event_id").alias("origem"), F.col("props").alias("payload"))
    prose = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), "doc_id").alias("origem"), F.col("text").alias("payload"))
    return events.unionByName(prose)


def status_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status document per event; every third one lacks the round."""
    k = F.get_json_object("props", "$.k").cast("int")
    nested = F.struct(F.struct(F.when(F.col("event_id") % 3 != 0, k).alias("rodada_atual")).alias("rodada"))
    return table(spark, sf_dir, "events").select("event_id", F.to_json(nested).alias("payload"))
