"""SQL that another engine runs on the same tables, one statement per query.

Written apart from the DataFrame code: scans, unions, window functions and a recursive
rating, never the shortcuts the operators take.
"""

from __future__ import annotations

import re


def pct(expression: str, digits: int) -> str:
    return f"CAST(round(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


DAY = "date_diff('day', DATE '{}', CAST({} AS DATE))"
W = "(PARTITION BY competicao, clube_id ORDER BY rodada, data_partida, partida_id{})"


def over(first: str = "UNBOUNDED PRECEDING", last: str = "CURRENT ROW") -> str:
    return "OVER " + W.format(f" ROWS BETWEEN {first} AND {last}")


def total(column: str, *frame: str) -> str:
    return f"CAST(sum({column}) {over(*frame)} AS BIGINT)"


def by_date(text: str) -> str:
    """The same windows in order of dates."""
    return text.replace("ORDER BY rodada, data_partida, partida_id", "ORDER BY data_partida, partida_id")


PRIOR = ("UNBOUNDED PRECEDING", "1 PRECEDING")


def last(n: int) -> tuple[str, str]:
    return (f"{n - 1} PRECEDING", "CURRENT ROW")


CUM = ", ".join(
    f"{total(c)} AS {n}"
    for n, c in [
        ("pontos_acumulados", "pontos"), ("vitorias", "vitoria"), ("empates", "empate"), ("derrotas", "derrota"),
        ("gols_marcados", "gols_marcados"), ("gols_sofridos", "gols_sofridos"),
    ]
)
RATE = f"{total('pontos')} / ({total('1')} * 3) * 100"
RATE2 = pct(RATE, 2)


def venue_prior(home: str, frame: str = over(*PRIOR)) -> str:
    won = f"sum(CASE WHEN eh_casa = {home} THEN vitoria ELSE 0 END) {frame}"
    games = f"sum(CASE WHEN eh_casa = {home} THEN 1 ELSE 0 END) {frame}"
    return f"coalesce(CAST({won} AS BIGINT) / greatest(CAST({games} AS BIGINT), 1), 0.0)"


VENUE_AVG = "avg(vitoria) OVER (PARTITION BY competicao, clube_id, eh_casa ORDER BY rodada, data_partida, partida_id ROWS UNBOUNDED PRECEDING)"
HOME_RATE = f"CASE WHEN eh_casa THEN {VENUE_AVG} END"
AWAY_RATE = f"CASE WHEN NOT eh_casa THEN {VENUE_AVG} END"


def venue_points(home: str) -> str:
    won = f"CAST(sum(CASE WHEN eh_casa = {home} THEN pontos ELSE 0 END) {over()} AS BIGINT)"
    possible = f"CAST(sum(CASE WHEN eh_casa = {home} THEN 3 ELSE 0 END) {over()} AS BIGINT)"
    return f"coalesce({pct(f'{won} / nullif({possible}, 0) * 100', 2)}, 0.0)"


FORM_VALUE = "(CASE WHEN vitoria = 1 THEN 1.0::DOUBLE WHEN empate = 1 THEN 0.5 ELSE 0.0 END)"
LAG1, LAG2 = (f"lag({FORM_VALUE}, {i}) OVER {W.format('')}" for i in (1, 2))
MOMENTUM = pct(
    f"(3 * {FORM_VALUE} + 2 * coalesce({LAG1}, 0) + coalesce({LAG2}, 0))"
    f" / (3 + CASE WHEN {LAG1} IS NULL THEN 0 ELSE 2 END + CASE WHEN {LAG2} IS NULL THEN 0 ELSE 1 END)",
    4,
)
DELTA = "CASE WHEN vitoria = 1 THEN 21.0::DOUBLE WHEN derrota = 1 THEN -21.0 WHEN eh_casa THEN 3.0 ELSE -3.0 END"


def mean(column: str, n: int) -> str:
    return f"avg({column}) {over(*last(n))}"


SIMPLE = f"1500.0 + (coalesce(aproveitamento_casa, 0.33::DOUBLE) * 200 + coalesce(aproveitamento_fora, 0.33::DOUBLE) * 100 + coalesce(media_pontos_5j, 1.0::DOUBLE) * 50)"
ROW = "competicao, clube_id, rodada, partida_id"
MATCH = "competicao, partida_id, rodada, clube_casa_id, clube_vis_id, placar_casa, placar_vis, data_partida"
RESULT = "CASE WHEN placar_casa IS NULL OR placar_vis IS NULL THEN NULL WHEN placar_casa > placar_vis THEN 'casa' WHEN placar_casa < placar_vis THEN 'visitante' ELSE 'empate' END"
ORDER_TABLE = "pontos_acumulados DESC, vitorias DESC, saldo_gols DESC, gols_marcados DESC, clube_id"


def place(order: str, name: str = "posicao") -> str:
    return f"CAST(row_number() OVER (PARTITION BY competicao ORDER BY {order}) AS INTEGER) AS {name}"


ZONE = "CASE WHEN posicao <= 4 THEN 'Libertadores (fase de grupos)' WHEN posicao <= 6 THEN 'Libertadores (pre-fase)' WHEN posicao <= 12 THEN 'Sul-Americana' WHEN posicao BETWEEN 17 AND 20 THEN 'Rebaixamento' ELSE 'Meio de tabela' END"
COLOR = "CASE WHEN posicao <= 4 THEN '#1a7a1a' WHEN posicao <= 6 THEN '#2e8b57' WHEN posicao <= 12 THEN '#4682b4' WHEN posicao BETWEEN 17 AND 20 THEN '#cc2222' ELSE '#666666' END"

SIDE = """SELECT competicao, rodada, data_partida, partida_id, clube_{me}_id AS clube_id, {home} AS eh_casa,
    CAST(CASE WHEN resultado = '{win}' THEN 3 WHEN resultado = 'empate' THEN 1 ELSE 0 END AS INTEGER) AS pontos,
    CAST(resultado = '{win}' AS INTEGER) AS vitoria, CAST(resultado = 'empate' AS INTEGER) AS empate,
    CAST(resultado = '{lose}' AS INTEGER) AS derrota, placar_{me} AS gols_marcados, placar_{other} AS gols_sofridos,
    clube_{other}_id AS adversario FROM silver WHERE resultado IS NOT NULL"""

FORM_SQL = f"""{mean('pontos', 5)} AS media_pontos_5j, {mean('gols_marcados', 5)} AS media_gols_marc_5j,
    {mean('gols_sofridos', 5)} AS media_gols_sofr_5j, {mean('pontos', 3)} AS media_pontos_3j, {mean('pontos', 6)} AS media_pontos_6j"""

PROB = "CASE previsao WHEN 'casa' THEN {}::DOUBLE WHEN 'empate' THEN {}::DOUBLE ELSE {}::DOUBLE END"
MODEL_FEATURES = ("elo_rating", "media_pontos_5j", "media_gols_marc_5j", "media_gols_sofr_5j", "momentum", "saldo_gols")
NAMES = {"elo_rating": "elo"}


def side_columns(alias: str, side: str, default: str | None = None) -> str:
    venue = "aproveitamento_casa" if side == "casa" else "aproveitamento_fora"
    parts = []
    for column in (*MODEL_FEATURES, venue):
        value = f"{alias}.{column}" if default is None else f"coalesce({alias}.{column}, {default})"
        parts.append(f"{value} AS {NAMES.get(column, column)}_{side}")
    return ", ".join(parts)


# Derived tables by name; a statement gets those it mentions.
DERIVED = {
    "li": "SELECT l_orderkey, min(l_suppkey) lo, max(l_suppkey) hi FROM lineitem GROUP BY l_orderkey",
    "pairs": """SELECT o_orderkey, o_orderdate, o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN lo ELSE hi END casa,
        CASE WHEN o_orderkey % 2 = 0 THEN hi ELSE lo END vis FROM orders JOIN li ON o_orderkey = l_orderkey WHERE lo <> hi""",
    "goals": """SELECT o_orderkey, o_orderdate, o_orderpriority, casa, vis,
        sum(CASE WHEN l_suppkey = casa THEN l_quantity ELSE 0 END) gc, sum(CASE WHEN l_suppkey = vis THEN l_quantity ELSE 0 END) gv
        FROM pairs JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
    "raw": f"""SELECT o_orderpriority AS competicao, o_orderkey AS partida_id,
        CAST(floor({DAY.format('1995-01-01', 'o_orderdate')} / 7) + 1 AS INTEGER) AS rodada,
        casa AS clube_casa_id, vis AS clube_vis_id,
        CASE WHEN o_orderdate < TIMESTAMP '2001-01-01 00:00:00' THEN CAST(gc AS INTEGER) % 5 END AS placar_casa,
        CASE WHEN o_orderdate < TIMESTAMP '2001-01-01 00:00:00' THEN CAST(gv AS INTEGER) % 5 END AS placar_vis,
        o_orderdate AS data_partida FROM goals""",
    "newest": """SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY competicao, rodada, clube_casa_id, clube_vis_id
        ORDER BY data_partida DESC, partida_id DESC) n FROM raw) WHERE n = 1""",
    "sided": "SELECT competicao, rodada, data_partida, partida_id, unnest([clube_casa_id, clube_vis_id]) AS clube FROM newest",
    "kept": """SELECT partida_id FROM (SELECT partida_id, row_number() OVER (PARTITION BY competicao, rodada, clube
        ORDER BY data_partida, partida_id) n FROM sided) WHERE n = 1 GROUP BY partida_id HAVING count(*) = 2""",
    "silver": f"SELECT newest.*, {RESULT} AS resultado FROM newest JOIN kept USING (partida_id)",
    "crows": SIDE.format(me="casa", other="vis", home="true", win="casa", lose="visitante")
    + " UNION ALL " + SIDE.format(me="vis", other="casa", home="false", win="visitante", lose="casa"),
    "store": f"SELECT competicao, rodada, clube_id, {CUM}, {total('gols_marcados')} - {total('gols_sofridos')} AS saldo_gols, {RATE2} AS aproveitamento_pct FROM crows",
    "running": f"SELECT competicao, rodada, clube_id, data_partida, partida_id, {CUM}, {RATE} AS aproveitamento_pct FROM crows",
    "storejob": f"""SELECT competicao, rodada, clube_id, pontos_acumulados, vitorias, empates, derrotas, gols_marcados, gols_sofridos,
        {total('gols_marcados')} - {total('gols_sofridos')} AS saldo_gols, aproveitamento_pct FROM running""",
    "venues": f"SELECT *, {HOME_RATE} AS aproveitamento_casa, {AWAY_RATE} AS aproveitamento_fora, {FORM_SQL} FROM crows",
    "featsql": f"""SELECT competicao, rodada, clube_id, {SIMPLE} AS elo_rating, coalesce(media_pontos_5j, 0) AS media_pontos_5j,
        coalesce(media_gols_marc_5j, 0) AS media_gols_marc_5j, coalesce(media_gols_sofr_5j, 0) AS media_gols_sofr_5j,
        coalesce(aproveitamento_casa, 0.0) AS aproveitamento_casa, coalesce(aproveitamento_fora, 0.0) AS aproveitamento_fora,
        media_pontos_3j - media_pontos_6j AS momentum FROM venues""",
    "ratings": """SELECT 0 AS rodada, competicao, clube_id, 1500.0::DOUBLE AS r FROM (SELECT DISTINCT competicao, clube_id FROM crows)
        UNION ALL
        SELECT s.rodada + 1, s.competicao, s.clube_id, CASE WHEN c.partida_id IS NULL THEN s.r
            WHEN c.eh_casa THEN s.r + 32 * ((c.vitoria + 0.5::DOUBLE * c.empate) - 1 / (1 + pow(10, (o.r - s.r) / 400)))
            ELSE s.r + 32 * ((1 - (c.derrota + 0.5::DOUBLE * c.empate)) - (1 - 1 / (1 + pow(10, (s.r - o.r) / 400)))) END
        FROM ratings s LEFT JOIN crows c ON c.competicao = s.competicao AND c.clube_id = s.clube_id AND c.rodada = s.rodada + 1
            LEFT JOIN ratings o ON o.competicao = s.competicao AND o.clube_id = c.adversario
        WHERE s.rodada < (SELECT max(rodada) FROM crows)""",
    "featjob": by_date(f"""SELECT c.competicao, c.rodada, c.clube_id, r.r AS elo_rating,
        coalesce(avg(pontos) {over('5 PRECEDING', '1 PRECEDING')}, 0) AS media_pontos_5j,
        coalesce(avg(gols_marcados) {over('5 PRECEDING', '1 PRECEDING')}, 0) AS media_gols_marc_5j,
        coalesce(avg(gols_sofridos) {over('5 PRECEDING', '1 PRECEDING')}, 0) AS media_gols_sofr_5j,
        {venue_prior('true')} AS aproveitamento_casa, {venue_prior('false')} AS aproveitamento_fora,
        CAST(coalesce({total('pontos', '3 PRECEDING', '1 PRECEDING')}, 0) AS DOUBLE) AS momentum
        FROM crows c JOIN ratings r ON r.competicao = c.competicao AND r.clube_id = c.clube_id AND r.rodada = c.rodada - 1""").replace(
        "PARTITION BY competicao, clube_id ORDER BY data_partida", "PARTITION BY c.competicao, c.clube_id ORDER BY c.data_partida"),
    "latestrow": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY competicao, clube_id ORDER BY rodada DESC) n FROM store) WHERE n = 1",
    "ranked": f"SELECT *, {place(ORDER_TABLE)} FROM latestrow",
    "current": "SELECT store.* FROM store JOIN (SELECT competicao, max(rodada) AS rodada FROM store GROUP BY competicao) USING (competicao, rodada)",
    "club": "SELECT s_suppkey AS clube_id, s_name AS nome, upper(substr(n_name, 1, 3)) AS abreviacao, s_name || '/' || n_name AS escudo_url FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "base": "SELECT s_suppkey AS clube_id, 1400.0::DOUBLE + (s_suppkey % 15) * 20 AS elo_base FROM supplier",
    "preds": f"""SELECT *, greatest(prob_casa, prob_empate, prob_visitante) AS confianca, 'v1' AS modelo_versao FROM (
        SELECT *, {PROB.format(0.61, 0.31, 0.16)} AS prob_casa, {PROB.format(0.22, 0.41, 0.24)} AS prob_empate, {PROB.format(0.17, 0.28, 0.6)} AS prob_visitante FROM (
        SELECT competicao, partida_id AS id, rodada, clube_casa_id, clube_vis_id, resultado, data_partida AS processed_at,
            CASE WHEN partida_id % 5 <> 0 THEN 'Time ' || clube_casa_id END AS nome_casa, CASE WHEN partida_id % 5 <> 0 THEN 'Time ' || clube_vis_id END AS nome_vis,
            CASE partida_id % 3 WHEN 0 THEN 'casa' WHEN 1 THEN 'empate' ELSE 'visitante' END AS previsao FROM silver))""",
    "valid": "SELECT * EXCLUDE (resultado), resultado AS resultado_real, previsao = resultado AS acerto FROM preds WHERE resultado IS NOT NULL",
    "ahead": "SELECT * EXCLUDE (resultado) FROM preds WHERE resultado IS NULL",
    "byround": f"SELECT competicao, rodada, count(*) AS total_jogos, count(*) FILTER (acerto) AS acertos, {pct('count(*) FILTER (acerto) / count(*) * 100', 1)} AS acuracia_pct FROM valid GROUP BY competicao, rodada",
    "byclass": "SELECT competicao, rodada, " + ", ".join(
        pct(f"avg(CASE WHEN resultado_real = '{c}' THEN CAST(acerto AS INTEGER) END) * 100", 1) + f" AS acuracia_{c}_pct" for c in ("casa", "empate", "visitante")
    ) + " FROM valid GROUP BY competicao, rodada",
    "conf": "SELECT competicao, rodada, " + ", ".join(
        pct(f"CAST(sum(CASE WHEN {w} THEN CAST(prob_casa AS DECIMAL(18,10)) END) AS DOUBLE) / nullif(count(*) FILTER ({w}), 0) * 100", 1) + f" AS conf_media_{n}"
        for n, w in (("acerto", "acerto"), ("erro", "NOT acerto"))
    ) + " FROM valid GROUP BY competicao, rodada",
    "moving": f"""SELECT *, {pct('acertos_acumulado / total_jogos_acumulado * 100', 1)} AS acuracia_geral_pct FROM (
        SELECT *, {pct('CAST(sum(CAST(acuracia_pct AS DECIMAL(18,4))) OVER (PARTITION BY competicao ORDER BY rodada ROWS 4 PRECEDING) AS DOUBLE) / count(*) OVER (PARTITION BY competicao ORDER BY rodada ROWS 4 PRECEDING)', 1)} AS acuracia_media_5r,
        CAST(sum(total_jogos) OVER (PARTITION BY competicao ORDER BY rodada) AS BIGINT) AS total_jogos_acumulado,
        CAST(sum(acertos) OVER (PARTITION BY competicao ORDER BY rodada) AS BIGINT) AS acertos_acumulado FROM byround)""",
    "perf": "SELECT * FROM moving JOIN byclass USING (competicao, rodada) JOIN conf USING (competicao, rodada)",
    "riskrank": f"SELECT *, {place('pontos_acumulados DESC, vitorias DESC, saldo_gols DESC, clube_id')}, count(*) OVER (PARTITION BY competicao) AS n FROM current",
    "risk": f"""SELECT competicao, r.clube_id, coalesce(nome, CAST(r.clube_id AS VARCHAR)) AS nome_clube, posicao, pontos_acumulados AS pontos, vitorias + empates + derrotas AS jogos,
        saldo_gols, {pct('1 / (1 + exp(-10 * (posicao / n - 0.85::DOUBLE)))', 4)} AS prob_rebaixamento, posicao > n - 4 AS zona_rebaixamento
        FROM riskrank r LEFT JOIN club USING (clube_id)""",
    "viewtable": f"""SELECT competicao, {place(ORDER_TABLE)}, clube_id, nome, abreviacao, vitorias + empates + derrotas AS jogos, pontos_acumulados AS pontos,
        vitorias, empates, derrotas, gols_marcados AS gols_pro, gols_sofridos AS gols_contra, saldo_gols, aproveitamento_pct AS aproveitamento
        FROM current JOIN club USING (clube_id)""",
    "viewrank": f"""SELECT competicao, {place('pontos_acumulados DESC, aproveitamento_pct DESC, clube_id', 'ranking')}, clube_id, nome, abreviacao,
        pontos_acumulados AS pontos, aproveitamento_pct AS aproveitamento, vitorias, empates, derrotas FROM current JOIN club USING (clube_id)""",
    "tablemart": f"""SELECT competicao, posicao, nome AS clube, abreviacao, escudo_url, t.vitorias + empates + derrotas AS jogos, pontos_acumulados AS pontos,
        vitorias AS v, empates AS e, derrotas AS d, gols_marcados AS gm, gols_sofridos AS gs, t.saldo_gols AS sg, aproveitamento_pct AS aproveitamento,
        {pct('prob_rebaixamento * 100', 1)} AS prob_rebaixamento_pct, zona_rebaixamento, {ZONE} AS situacao, {COLOR} AS cor_situacao
        FROM ranked t LEFT JOIN club USING (clube_id) LEFT JOIN (SELECT competicao, clube_id, prob_rebaixamento, zona_rebaixamento FROM risk) USING (competicao, clube_id)""",
    "latestelo": "SELECT competicao, clube_id, elo_rating FROM (SELECT *, row_number() OVER (PARTITION BY competicao, clube_id ORDER BY rodada DESC) n FROM featsql) WHERE n = 1",
    "six": """SELECT p.*, cc.nome AS cnc, cc.abreviacao AS abc, cc.escudo_url AS esc, cv.nome AS cnv, cv.abreviacao AS abv, cv.escudo_url AS esv,
        tc.pontos_acumulados AS ptc, tv.pontos_acumulados AS ptv, tc.aproveitamento_pct AS apc, tv.aproveitamento_pct AS apv, ec.elo_rating AS elc, ev.elo_rating AS elv
        FROM ahead p LEFT JOIN club cc ON cc.clube_id = p.clube_casa_id LEFT JOIN club cv ON cv.clube_id = p.clube_vis_id
        LEFT JOIN latestrow tc ON tc.competicao = p.competicao AND tc.clube_id = p.clube_casa_id LEFT JOIN latestrow tv ON tv.competicao = p.competicao AND tv.clube_id = p.clube_vis_id
        LEFT JOIN latestelo ec ON ec.competicao = p.competicao AND ec.clube_id = p.clube_casa_id LEFT JOIN latestelo ev ON ev.competicao = p.competicao AND ev.clube_id = p.clube_vis_id""",
    "predmart": f"""SELECT competicao, id, rodada, clube_casa_id, clube_vis_id, coalesce(nome_casa, cnc) AS nome_casa, coalesce(nome_vis, cnv) AS nome_visitante,
        abc AS abrev_casa, abv AS abrev_visitante, esc AS escudo_casa, esv AS escudo_visitante, {pct('prob_casa * 100', 1)} AS prob_casa_pct,
        {pct('prob_empate * 100', 1)} AS prob_empate_pct, {pct('prob_visitante * 100', 1)} AS prob_visitante_pct, previsao, {pct('confianca * 100', 1)} AS confianca_pct,
        modelo_versao, {pct('elc', 0)} AS elo_casa, {pct('elv', 0)} AS elo_visitante, ptc AS pontos_casa, ptv AS pontos_visitante,
        apc AS aprov_casa_pct, apv AS aprov_vis_pct, processed_at FROM six""",
    "state": "SELECT * FROM featsql JOIN (SELECT competicao, rodada, clube_id, saldo_gols FROM store) USING (competicao, rodada, clube_id)",
    "statejob": "SELECT * FROM featjob JOIN (SELECT competicao, rodada, clube_id, saldo_gols FROM storejob) USING (competicao, rodada, clube_id)",
    "statelag": """SELECT * FROM featjob JOIN (SELECT competicao, rodada, clube_id, coalesce(lag(saldo_gols) OVER (PARTITION BY competicao, clube_id ORDER BY rodada), 0) AS saldo_gols
        FROM store) USING (competicao, rodada, clube_id)""",
    "currentgap": "SELECT * REPLACE (CASE WHEN clube_id % 3 = 0 THEN clube_id + 1000000000000 ELSE clube_id END AS clube_id) FROM current",
    "statebefore": """SELECT * FROM featjob JOIN (SELECT competicao, rodada, clube_id, coalesce(lag(saldo_gols) OVER (PARTITION BY competicao, clube_id ORDER BY rodada), 0) AS saldo_gols
        FROM storejob) USING (competicao, rodada, clube_id)""",
    "asked": """SELECT competicao, clube_casa_id AS clube_id FROM silver WHERE resultado IS NULL UNION SELECT competicao, clube_vis_id FROM silver WHERE resultado IS NULL""",
    "statenext": by_date(f"""SELECT competicao, clube_id, r AS elo_rating, media_pontos_5j, media_gols_marc_5j, media_gols_sofr_5j, aproveitamento_casa, aproveitamento_fora, momentum, saldo_gols
        FROM (SELECT competicao, clube_id, row_number() OVER (PARTITION BY competicao, clube_id ORDER BY data_partida DESC, partida_id DESC) AS n,
            avg(pontos) {over(*last(5))} AS media_pontos_5j, avg(gols_marcados) {over(*last(5))} AS media_gols_marc_5j, avg(gols_sofridos) {over(*last(5))} AS media_gols_sofr_5j,
            {venue_prior('true', over())} AS aproveitamento_casa, {venue_prior('false', over())} AS aproveitamento_fora,
            CAST({total('pontos', '2 PRECEDING', 'CURRENT ROW')} AS DOUBLE) AS momentum FROM crows)
        JOIN (SELECT competicao, clube_id, r FROM ratings WHERE rodada = (SELECT max(rodada) FROM crows)) USING (competicao, clube_id)
        JOIN (SELECT competicao, clube_id, arg_max(saldo_gols, rodada) AS saldo_gols FROM storejob GROUP BY ALL) USING (competicao, clube_id) WHERE n = 1
        UNION ALL SELECT competicao, clube_id, 1500.0::DOUBLE, 0, 0, 0, 0, 0, 0, 0 FROM asked ANTI JOIN crows USING (competicao, clube_id)"""),
    "score": f"SELECT CAST({DAY.format('2024-01-01', 'ts')} + 1 AS INTEGER) AS rodada, user_id AS atleta_id, user_id % 10 AS clube_id, value AS pontos FROM events",
    "athlete": "SELECT DISTINCT user_id AS atleta_id, CAST(user_id % 6 AS INTEGER) AS posicao_id, CAST(user_id % 8 AS INTEGER) AS status_id FROM events WHERE user_id % 10 <> 0",
    "models": """SELECT p_name AS modelo_nome, 'v' || p_partkey AS versao, p_brand AS algoritmo, p_partkey % 97 / 100 AS acuracia, p_partkey % 89 / 100 AS f1_score,
        p_partkey % 83 / 50 AS log_loss, CAST(p_partkey % 30 AS INTEGER) AS rodada_treino, CAST(p_partkey % 30 + 8 AS INTEGER) AS rodada_teste,
        '{"max_depth":' || p_size || '}' AS parametros, p_partkey % 7 = 0 AS ativo, make_timestamp((1767225600 + p_partkey * 60) * 1000000) AS processed_at FROM part""",
    "runlog": """SELECT CAST(event_id AS VARCHAR) AS run_id, 'liga' AS pipeline_name, event_type AS stage,
        CASE WHEN event_type = 'error' THEN 'failed' WHEN value < 1 THEN 'skipped' ELSE 'success' END AS status, ts AS started_at,
        ts + to_seconds(CAST(floor(value) AS BIGINT)) AS finished_at, CAST(floor(value) AS BIGINT) AS duration_seconds,
        CAST(json_extract(props, '$.k') AS BIGINT) AS records_processed, CASE WHEN event_type = 'error' THEN props END AS error_message FROM events""",
}


def sql(body: str) -> str:
    """``body`` with the derived tables it needs, in order of definition."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in DERIVED:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(DERIVED[name])

    visit(body)
    tables = ",\n".join(f"{n} AS ({DERIVED[n]})" for n in DERIVED if n in needed)
    return f"WITH RECURSIVE {tables}\n{body}" if tables else body


def model_features(facts: str, state: str, default: str | None = None, extra: str = "") -> str:
    return f"""SELECT {facts}, {side_columns('c', 'casa', default)}, {side_columns('v', 'vis', default)} FROM silver m
        {{kind}} JOIN {state} c ON c.competicao = m.competicao AND c.rodada = m.rodada AND c.clube_id = m.clube_casa_id
        {{kind}} JOIN {state} v ON v.competicao = m.competicao AND v.rodada = m.rodada AND v.clube_id = m.clube_vis_id {extra}"""


FIXTURE = "m.competicao, m.partida_id, m.rodada, m.clube_casa_id, m.clube_vis_id"


def training(state: str) -> str:
    text = model_features(f"{FIXTURE}, m.data_partida, m.resultado", state, None, "WHERE m.resultado IS NOT NULL").format(kind="LEFT")
    return f"SELECT * REPLACE (round(elo_casa, 6) AS elo_casa, round(elo_vis, 6) AS elo_vis) FROM ({text}) WHERE elo_casa IS NOT NULL AND elo_vis IS NOT NULL"


SPLIT = """SELECT competicao, partida_id, rodada, CASE WHEN row_number() OVER (ORDER BY rodada, data_partida, partida_id) <= floor(count(*) OVER () * 0.8) THEN 'treino' ELSE 'teste' END AS conjunto
        FROM silver WHERE resultado IS NOT NULL"""


def report(name: str, table: str, checked: str, failed: str, severity: str = "failed") -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS tabela, CASE WHEN f = 0 THEN 'success' ELSE '{severity}' END AS status,
        n AS records_checked, f AS records_failed, f || ' de ' || n AS detalhe FROM (SELECT count(*) AS n, count(*) FILTER ({failed}) AS f FROM {checked})"""


def unique(name: str, table: str, source: str, columns: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS tabela, CASE WHEN f = 0 THEN 'success' ELSE 'failed' END AS status, n AS records_checked, f AS records_failed,
        f || ' de ' || n AS detalhe FROM (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n, count(*) FILTER (c > 1) AS f FROM (SELECT {columns}, count(*) AS c FROM {source} GROUP BY {columns}))"""


def counted(name: str, table: str, source: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS tabela, CASE WHEN n > 0 THEN 'success' ELSE 'warning' END AS status, n AS records_checked,
        CAST(0 AS BIGINT) AS records_failed, n || ' registros' AS detalhe FROM (SELECT count(*) AS n FROM {source})"""


def all_of(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def top(chart: str, label: str, source: str, column: str, n: int) -> str:
    return f"""SELECT * FROM (SELECT '{chart}' AS grafico, {label} AS rotulo, valor FROM (
        SELECT {column.split('|')[0]}, CAST(max({column.split('|')[1]}) AS DOUBLE) AS valor FROM {source} GROUP BY ALL ORDER BY valor DESC, {column.split('|')[0]} LIMIT {n}))"""


F1_PART = "coalesce(2 * count(*) FILTER (resultado_real = previsao AND previsao = '{c}') / nullif(count(*) FILTER (resultado_real = '{c}') + count(*) FILTER (previsao = '{c}'), 0), 0) * count(*) FILTER (resultado_real = '{c}')"
METRICS = f"""SELECT count(*) AS amostras, {pct("count(*) FILTER (acerto) / count(*)", 6)} AS acuracia,
    {pct("(" + " + ".join(F1_PART.format(c=c) for c in ("casa", "empate", "visitante")) + ") / count(*)", 6)} AS f1_score,
    {pct("avg(-ln(CASE resultado_real WHEN 'casa' THEN prob_casa WHEN 'empate' THEN prob_empate ELSE prob_visitante END))", 6)} AS log_loss FROM valid"""

MATCH_CHECKS = [
    ("sem_nulos", "rodada IS NULL OR clube_casa_id IS NULL OR clube_vis_id IS NULL"),
    ("placar_valido", "placar_casa < 0 OR placar_vis < 0"),
    ("resultado_valido", "resultado NOT IN ('casa', 'visitante', 'empate')"),
    ("sem_placar", "placar_casa IS NULL OR placar_vis IS NULL"),
]


def match_checks(source: str) -> list[str]:
    rows = [report(n, "silver.partidas", source, w) for n, w in MATCH_CHECKS]
    return rows + [unique("unique_competicao_rodada_clube_casa_id_clube_vis_id", "silver.partidas", source, "competicao, rodada, clube_casa_id, clube_vis_id")]


_BODIES = {
    "write_read_roundtrip": "SELECT * FROM club",
    "write_guard": "SELECT * FROM club",
    "ingest_matches": """SELECT competicao, partida_id, CASE WHEN partida_id % 7 <> 0 THEN rodada ELSE 0 END AS rodada, clube_casa_id, clube_vis_id, placar_casa, placar_vis,
        CASE WHEN partida_id % 5 <> 0 THEN data_partida END AS data_partida, CASE WHEN placar_casa IS NULL THEN '' ELSE 'Encerrada' END AS status, true AS com_payload FROM raw""",
    "ingest_clubs": "SELECT clube_id, nome, abreviacao, CASE WHEN clube_id % 4 <> 0 THEN escudo_url ELSE '' END AS escudo_url FROM club",
    "ingest_athletes": "SELECT atleta_id, 'Atleta ' || atleta_id AS nome, CASE WHEN atleta_id % 4 <> 0 THEN atleta_id % 10 ELSE 0 END AS clube_id, posicao_id, status_id FROM athlete",
    "ingest_scores": "SELECT rodada, atleta_id, max(clube_id) AS clube_id, CASE WHEN atleta_id % 4 <> 0 THEN max(pontos) ELSE 0.0::DOUBLE END AS pontos FROM score GROUP BY rodada, atleta_id",
    "ingest_rejects": """SELECT origem, CAST(0 AS BIGINT) AS partidas FROM (SELECT 'e' || event_id AS origem, props AS payload FROM events UNION ALL SELECT 'd' || doc_id, text FROM documents)
        WHERE CASE WHEN json_valid(payload) THEN json_type(payload) <> 'OBJECT' ELSE true END""",
    "current_round": "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(json_extract(props, '$.k') AS INTEGER) ELSE 1 END AS rodada_atual FROM events",
    "append_dedupe": f"""SELECT {MATCH} FROM (SELECT *, row_number() OVER (PARTITION BY competicao, rodada, clube_casa_id, clube_vis_id ORDER BY data_partida DESC, partida_id DESC, lote DESC) n
        FROM (SELECT * REPLACE (CAST(9 AS INTEGER) AS placar_casa), 0 AS lote FROM raw
        UNION ALL SELECT * REPLACE (CASE WHEN partida_id % 2 = 0 THEN data_partida ELSE data_partida - INTERVAL 1 DAY END AS data_partida), 1 FROM raw)) WHERE n = 1""",
    "upsert": f"""SELECT {MATCH} FROM silver WHERE rodada % 2 <> 0 UNION ALL SELECT {MATCH.replace('placar_casa', 'CAST(placar_casa + 1 AS INTEGER) AS placar_casa')} FROM silver WHERE rodada % 2 = 0
        UNION ALL SELECT {MATCH.replace('rodada', 'CAST(rodada + 1000 AS INTEGER) AS rodada')} FROM silver WHERE rodada % 50 = 0""",
    "model_register": """SELECT * REPLACE (false AS ativo) FROM models UNION ALL SELECT 'previsao_resultados', '20260327_2000', 'RandomForestClassifier', 0.512346, 0.498765, 1.012346,
        10, 12, '{"maxDepth": 8}', true, TIMESTAMP '2026-03-27 20:00:00'""",
    "model_active": "SELECT coalesce(arg_max(versao, processed_at), 'unknown') AS versao FROM models WHERE ativo",
    "run_audit": """SELECT stage, status, count(*) AS execucoes, CAST(sum(records_processed) AS BIGINT) AS registros, max(started_at) AS ultima FROM (
        SELECT stage, status, records_processed, started_at FROM runlog UNION ALL SELECT 'gold', 'success', 7, TIMESTAMP '2026-03-27 20:00:00'
        UNION ALL SELECT 'gold', 'failed', 0, TIMESTAMP '2026-03-27 20:00:00') GROUP BY stage, status""",
    "check_log": all_of(*match_checks("silver"), counted("gold_feature_store_count", "gold.feature_store", "store")),
    "materialize": "SELECT * FROM club",
    "published_predictions": "SELECT competicao, rodada, nome_casa, nome_vis, prob_casa, prob_empate, prob_visitante, previsao, confianca, modelo_versao, processed_at FROM ahead",
    "published_accuracy": "SELECT competicao, rodada, total_jogos AS partidas, acertos, acuracia_pct FROM byround",
    "published_alias": "SELECT * FROM ahead",
    "published_views": all_of(
        "SELECT competicao, 'vw_classificacao' AS visao, clube_id, posicao AS valor FROM viewtable",
        "SELECT competicao, 'vw_elo_ranking', clube_id, ranking FROM viewrank",
        ),
    "match_result": f"SELECT competicao, partida_id, {RESULT} AS resultado FROM raw",
    "played": f"SELECT {MATCH}, resultado FROM silver WHERE resultado IS NOT NULL",
    "upcoming": f"SELECT {MATCH}, resultado FROM silver WHERE resultado IS NULL",
    "points": "SELECT partida_id, CAST(max(pontos) FILTER (eh_casa) AS INTEGER) AS pontos_casa, CAST(max(pontos) FILTER (NOT eh_casa) AS INTEGER) AS pontos_visitante FROM crows GROUP BY partida_id",
    "outcome_flags": "SELECT partida_id, " + ", ".join(
        f"max({c}) FILTER ({w}) AS {c}_{n}" for n, w in (("casa", "eh_casa"), ("visitante", "NOT eh_casa")) for c in ("vitoria", "empate", "derrota")
    ) + " FROM crows GROUP BY partida_id",
    "zone": f"SELECT competicao, clube_id, posicao, {ZONE} AS situacao FROM ranked",
    "zone_color": f"SELECT competicao, clube_id, posicao, {COLOR} AS cor_situacao FROM ranked",
    "pct_round": f"SELECT competicao, rodada, clube_id, {pct('aproveitamento_pct', 1)} AS aprov_1, {pct('aproveitamento_pct', 0)} AS aprov_0, {pct('saldo_gols / rodada', 2)} AS saldo_medio FROM store",
    "display_name": """SELECT id, coalesce(nome_casa, c.nome, 'Clube ' || clube_casa_id) AS nome_casa, coalesce(nome_vis, v.nome, 'Clube ' || clube_vis_id) AS nome_vis
        FROM (SELECT * REPLACE (CASE WHEN clube_casa_id % 3 = 0 THEN clube_casa_id + 1000000000000 ELSE clube_casa_id END AS clube_casa_id) FROM preds)
        LEFT JOIN club c ON c.clube_id = clube_casa_id LEFT JOIN club v ON v.clube_id = clube_vis_id""",
    "hit": "SELECT id, coalesce(previsao = resultado, false) AS acerto FROM preds",
    "confidence_band": "SELECT competicao, rodada, " + ", ".join(
        f"CASE WHEN coalesce({c}, 0) >= 70 THEN 'alta' WHEN coalesce({c}, 0) >= 50 THEN 'media' ELSE 'baixa' END AS {n}"
        for n, c in (("faixa", "acuracia_pct"), ("faixa_empate", "acuracia_empate_pct"))
    ) + " FROM perf",
    "published_shape": "SELECT CAST(s_suppkey AS INTEGER) AS clube_id, trim(s_name) AS nome, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS saldo FROM supplier",
    "payload_nonempty": "SELECT count(*) AS com_payload, count(DISTINCT clube_id) AS clubes FROM club",
    "silver_matches": f"SELECT {MATCH}, {RESULT} AS resultado FROM newest",
    "silver_matches_played": f"""SELECT {MATCH}, {RESULT} AS resultado FROM (SELECT *, row_number() OVER (PARTITION BY competicao, rodada, clube_casa_id, clube_vis_id
        ORDER BY data_partida DESC, partida_id DESC) n FROM raw WHERE placar_casa IS NOT NULL AND placar_vis IS NOT NULL) WHERE n = 1""",
    "one_match_per_round": f"SELECT {MATCH}, resultado FROM silver",
    "silver_clubs": "SELECT clube_id, trim(nome) AS nome, trim(abreviacao) AS abreviacao, escudo_url || '#2' AS escudo_url FROM club",
    "silver_player_scores": "SELECT rodada, atleta_id, clube_id, posicao_id, status_id, pontos FROM score LEFT JOIN athlete USING (atleta_id)",
    "silver_player_scores_dedup": """SELECT rodada, atleta_id, clube_id, coalesce(posicao_id, 0) AS posicao_id, pontos FROM (SELECT *, row_number() OVER (PARTITION BY rodada, atleta_id
        ORDER BY pontos DESC, clube_id DESC) n FROM score) LEFT JOIN athlete USING (atleta_id) WHERE n = 1""",
    "join_score_position": "SELECT rodada, atleta_id, clube_id, pontos, posicao_id FROM score LEFT JOIN athlete USING (atleta_id)",
    "join_features": "SELECT * FROM state",
    "join_match_features": model_features(FIXTURE, "state").format(kind="LEFT"),
    "join_club_names": """SELECT partida_id, clube_casa_id, clube_vis_id, c.nome AS nome_casa, c.abreviacao AS abreviacao_casa, v.nome AS nome_vis, v.abreviacao AS abreviacao_vis
        FROM silver LEFT JOIN club c ON c.clube_id = clube_casa_id LEFT JOIN club v ON v.clube_id = clube_vis_id""",
    "join_prediction_result": """SELECT competicao, rodada, clube_casa_id, clube_vis_id, previsao, m.resultado AS resultado_real
        FROM preds JOIN silver m USING (competicao, rodada, clube_casa_id, clube_vis_id) WHERE m.resultado IS NOT NULL""",
    "join_latest_round": "SELECT * FROM current",
    "features_exact": model_features(FIXTURE, "state", "0", "WHERE m.resultado IS NULL").format(kind="LEFT"),
    "features_asof": f"""SELECT {FIXTURE}, {side_columns('c', 'casa', '0')}, {side_columns('v', 'vis', '0')} FROM silver m
        ASOF LEFT JOIN state c ON c.competicao = m.competicao AND c.clube_id = m.clube_casa_id AND m.rodada > c.rodada
        ASOF LEFT JOIN state v ON v.competicao = m.competicao AND v.clube_id = m.clube_vis_id AND m.rodada > v.rodada""",
    "join_latest_six": "SELECT id, cnc AS clube_nome_casa, cnv AS clube_nome_vis, abc AS abreviacao_casa, abv AS abreviacao_vis, esc AS escudo_url_casa, esv AS escudo_url_vis, "
        "ptc AS pontos_acumulados_casa, ptv AS pontos_acumulados_vis, apc AS aproveitamento_pct_casa, apv AS aproveitamento_pct_vis, elc AS elo_rating_casa, elv AS elo_rating_vis FROM six",
    "join_standings": """SELECT competicao, clube_id, rodada, pontos_acumulados, nome, abreviacao, escudo_url, prob_rebaixamento, zona_rebaixamento FROM latestrow LEFT JOIN club USING (clube_id)
        LEFT JOIN (SELECT competicao, clube_id, prob_rebaixamento, zona_rebaixamento FROM risk) USING (competicao, clube_id)""",
    "join_venue_rates": "SELECT competicao, clube_id, rodada, pontos, aproveitamento_casa, aproveitamento_fora FROM venues",
    "join_relegation_name": """SELECT competicao, clube_id, pontos_acumulados, nome AS nome_clube, 'left' AS tipo FROM currentgap LEFT JOIN club USING (clube_id)
        UNION ALL SELECT competicao, clube_id, pontos_acumulados, nome, 'inner' FROM currentgap JOIN club USING (clube_id)""",
    "last_round": "SELECT competicao, max(rodada) AS rodada FROM silver GROUP BY competicao",
    "accuracy_by_round": "SELECT * FROM byround",
    "accuracy_by_class": "SELECT * FROM byclass",
    "confidence_hit_miss": "SELECT * FROM conf",
    "accuracy_view": "SELECT competicao, rodada, total_jogos AS partidas, acertos, acuracia_pct FROM byround",
    "distinct_clubs": "SELECT count(DISTINCT clube_id) AS clubes FROM club",
    "row_counts": all_of(*[f"SELECT '{n}' AS tabela, count(*) AS registros FROM {t}" for n, t in (
        ("silver.partidas", "silver"), ("silver.clubes", "club"), ("gold.feature_store", "store"), ("gold.previsoes_validadas", "valid"), ("gold.pipeline_executions", "runlog"))]),
    "kpi_summary": """SELECT competicao, acuracia_geral_pct AS acuracia_geral, total_jogos_acumulado AS total_previsoes_historico, acertos_acumulado AS acertos_historico,
        (SELECT count(*) FROM ahead a WHERE a.competicao = moving.competicao) AS proximas_partidas, (SELECT arg_max(modelo_nome, processed_at) FROM models) AS melhor_modelo,
        (SELECT arg_max(acuracia, processed_at) FROM models) AS acuracia_modelo FROM moving WHERE rodada = (SELECT max(rodada) FROM moving m WHERE m.competicao = moving.competicao)""",
    "bi_max_topn": all_of(
        top("rebaixamento", "nome_clube", "risk", "nome_clube|prob_rebaixamento", 20),
        top("pontos", "nome", "viewtable", "nome|pontos", 20),
        top("confianca", "clube_casa_id || '-' || clube_vis_id", "ahead", "clube_casa_id, clube_vis_id|confianca", 10),
        top("acuracia", "CAST(rodada AS VARCHAR)", "byround", "rodada|acuracia_pct", 50),
        top("elo", "CAST(clube_id AS VARCHAR)", "featsql", "clube_id|elo_rating", 20),
        top("forma", "CAST(clube_id AS VARCHAR)", "featsql", "clube_id|media_pontos_5j", 20),
    ),
    "bi_count_by": f"""SELECT previsao AS rotulo, count(*) AS quantidade, 'previsao' AS grafico FROM ahead GROUP BY previsao
        UNION ALL SELECT {ZONE} AS rotulo, count(*), 'situacao' FROM ranked GROUP BY rotulo""",
    "class_weights": "SELECT resultado, count(*) AS n, (SELECT count(*) FROM silver WHERE resultado IS NOT NULL) / (3 * count(*)) AS peso FROM silver WHERE resultado IS NOT NULL GROUP BY resultado",
    "club_rows": "SELECT * EXCLUDE (adversario) FROM crows",
    "cum_stats": f"SELECT {ROW}, {CUM} FROM crows",
    "goal_diff": f"SELECT {ROW}, {total('gols_marcados')} - {total('gols_sofridos')} AS saldo_gols FROM crows",
    "goal_diff_double": f"SELECT competicao, clube_id, rodada, partida_id, {total('gols_marcados')} - {total('gols_sofridos')} AS saldo_gols_double FROM running",
    "games": f"SELECT {ROW}, row_number() OVER {W.format('')} AS jogos FROM crows",
    "success_rate": f"SELECT {ROW}, {RATE} AS taxa, {RATE2} AS taxa_2 FROM crows",
    "form5_prior": by_date(f"SELECT {ROW}, " + ", ".join(
        f"coalesce(avg({c}) {over('5 PRECEDING', '1 PRECEDING')}, 0) AS {n}"
        for n, c in (("media_pontos_5j", "pontos"), ("media_gols_marc_5j", "gols_marcados"), ("media_gols_sofr_5j", "gols_sofridos"))
    ) + " FROM crows"),
    "form_incl": f"SELECT {ROW}, {FORM_SQL} FROM crows",
    "venue_rate_prior": by_date(f"SELECT {ROW}, {venue_prior('true')} AS aproveitamento_casa, {venue_prior('false')} AS aproveitamento_fora FROM crows"),
    "venue_rate_incl": f"SELECT {ROW}, coalesce({HOME_RATE}, 0) AS aproveitamento_casa, coalesce({AWAY_RATE}, 0) AS aproveitamento_fora FROM crows",
    "venue_points_pct": f"SELECT {ROW}, {venue_points('true')} AS aproveitamento_casa, {venue_points('false')} AS aproveitamento_fora FROM crows",
    "momentum_sum3": by_date(f"SELECT {ROW}, coalesce({total('pontos', '3 PRECEDING', '1 PRECEDING')}, 0) AS momentum FROM crows"),
    "momentum_diff": f"SELECT {ROW}, {mean('pontos', 3)} - {mean('pontos', 6)} AS momentum FROM crows",
    "momentum_weighted": f"SELECT {ROW}, {MOMENTUM} AS momentum FROM crows",
    "elo": """SELECT m.competicao, partida_id, round(h.r, 6) AS elo_casa, round(a.r, 6) AS elo_vis FROM silver m
        JOIN ratings h ON h.competicao = m.competicao AND h.clube_id = clube_casa_id AND h.rodada = m.rodada - 1
        JOIN ratings a ON a.competicao = m.competicao AND a.clube_id = clube_vis_id AND a.rodada = m.rodada - 1 WHERE resultado IS NOT NULL""",
    "elo_additive": f"SELECT {ROW}, {pct(f'elo_base + sum({DELTA}) {over()}', 2)} AS elo_rating FROM crows JOIN base USING (clube_id)",
    "elo_simplified": f"SELECT {ROW}, {SIMPLE} AS elo_rating FROM venues",
    "round_club_grid": f"""SELECT g.competicao, g.rodada, g.clube_id, {', '.join(f"CAST(coalesce(sum({c}) OVER w, 0) AS BIGINT) AS {n}" for n, c in (
        ('pontos_acumulados', 'pontos'), ('vitorias', 'vitoria'), ('empates', 'empate'), ('derrotas', 'derrota'), ('gols_marcados', 'gols_marcados'), ('gols_sofridos', 'gols_sofridos')))},
        CAST(coalesce(sum(gols_marcados - gols_sofridos) OVER w, 0) AS BIGINT) AS saldo_gols,
        coalesce({pct("CAST(sum(pontos) OVER w AS BIGINT) / nullif(count(pontos) OVER w * 3, 0) * 100", 2)}, 0.0) AS aproveitamento_pct
        FROM (SELECT competicao, clube_id, CAST(unnest(generate_series(1, ultima)) AS INTEGER) AS rodada FROM (SELECT DISTINCT competicao, clube_id FROM crows)
            JOIN (SELECT competicao, max(rodada) AS ultima FROM crows GROUP BY competicao) USING (competicao)) g
        LEFT JOIN crows USING (competicao, clube_id, rodada) WINDOW w AS (PARTITION BY g.competicao, g.clube_id ORDER BY g.rodada ROWS UNBOUNDED PRECEDING)""",
    "standings_rank": "SELECT * FROM ranked",
    "points_rank": f"SELECT *, {place('pontos_acumulados DESC, aproveitamento_pct DESC, clube_id', 'ranking')} FROM latestrow",
    "relegation_rank": f"SELECT *, {place('pontos_acumulados DESC, vitorias DESC, saldo_gols DESC, clube_id')} FROM latestrow",
    "accuracy_moving": "SELECT * FROM moving",
    "latest_per_key": "SELECT * FROM latestrow",
    "top_predictions": "SELECT rodada, id, nome_casa, nome_visitante, prob_casa_pct FROM predmart ORDER BY rodada, prob_casa_pct DESC",
    "top_standings": "SELECT competicao, posicao, clube, pontos, situacao FROM tablemart ORDER BY competicao, posicao",
    "top_ranking": "SELECT * FROM viewrank WHERE ranking <= 30 ORDER BY competicao, ranking",
    "performance_by_round": "SELECT * FROM perf ORDER BY competicao, rodada",
    "latest_models": "SELECT * FROM models ORDER BY processed_at DESC LIMIT 10",
    "latest_runs": "SELECT * FROM runlog ORDER BY started_at DESC, run_id DESC LIMIT 20",
    "relegation_sorted": "SELECT competicao, posicao, clube, abreviacao, escudo_url, pontos, jogos, prob_rebaixamento_pct, zona_rebaixamento, cor_situacao FROM tablemart ORDER BY prob_rebaixamento_pct DESC NULLS LAST",
    "predictions_view": "SELECT competicao, rodada, nome_casa, nome_vis, prob_casa, prob_empate, prob_visitante, previsao, confianca, modelo_versao, processed_at FROM ahead ORDER BY rodada, confianca DESC",
    "best_round": "SELECT competicao, rodada, acuracia_pct FROM (SELECT *, row_number() OVER (PARTITION BY competicao ORDER BY acuracia_pct DESC, rodada DESC) n FROM byround) WHERE n = 1",
    "latest_rounds": """SELECT competicao, ordem, rodada, total_jogos, acertos, acuracia_pct, acuracia_media_5r, coalesce(rodada = tipo, false) AS ultima_com_classe FROM (
        SELECT *, CAST(row_number() OVER (PARTITION BY competicao ORDER BY rodada DESC) AS INTEGER) AS ordem, max(CASE WHEN coalesce(acuracia_casa_pct, acuracia_empate_pct, acuracia_visitante_pct)
        IS NOT NULL THEN rodada END) OVER (PARTITION BY competicao) AS tipo FROM perf) WHERE ordem <= 10""",
    "confidence_gap": f"SELECT competicao, rodada, {pct('conf_media_acerto - conf_media_erro', 1)} AS diferenca FROM conf WHERE (competicao, rodada) IN (SELECT competicao, max(rodada) FROM conf GROUP BY competicao)",
    "bi_table": all_of(*[
        f"SELECT * FROM (SELECT '{g}' AS grafico, competicao, CAST({r} AS BIGINT) AS rotulo, CAST({v} AS DOUBLE) AS valor FROM {t} ORDER BY {o} LIMIT {n})"
        for g, r, v, t, o, n in (
            ("classificacao", "clube_id", "posicao", "viewtable", "posicao, competicao", 20),
            ("rebaixamento", "clube_id", "prob_rebaixamento", "risk", "prob_rebaixamento DESC, competicao, clube_id", 25),
            ("previsoes", "id", "confianca", "ahead", "confianca DESC, id", 10),
            ("acuracia", "rodada", "acuracia_pct", "byround", "rodada, competicao", 50))]),
    "feature_store": "SELECT * FROM store",
    "feature_store_job": "SELECT * FROM storejob",
    "features_job": "SELECT * REPLACE (round(elo_rating, 6) AS elo_rating) FROM featjob",
    "features_sql": "SELECT * FROM featsql",
    "features_seed": f"""SELECT competicao, rodada, clube_id, {pct('elo_base + coalesce(moved, 0)', 2)} AS elo_rating, coalesce(mp, 0.0) AS media_pontos_5j, coalesce(gm, 0.0) AS media_gols_marc_5j,
        coalesce(gs, 0.0) AS media_gols_sofr_5j, coalesce(ac, 0.0) AS aproveitamento_casa, coalesce(af, 0.0) AS aproveitamento_fora, coalesce(mo, 0.5) AS momentum FROM (
        SELECT g.competicao, g.rodada, g.clube_id, {', '.join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY g.competicao, g.clube_id ORDER BY g.rodada) AS {c}" for c in ('moved', 'mp', 'gm', 'gs', 'ac', 'af', 'mo'))}
        FROM (SELECT competicao, clube_id, CAST(unnest(generate_series(1, ultima)) AS INTEGER) AS rodada FROM (SELECT DISTINCT competicao, clube_id FROM crows)
            JOIN (SELECT competicao, max(rodada) AS ultima FROM crows GROUP BY competicao) USING (competicao)) g
        LEFT JOIN (SELECT competicao, clube_id, rodada, sum({DELTA}) {over()} AS moved, {pct(mean('pontos', 5), 4)} AS mp, {pct(mean('gols_marcados', 5), 4)} AS gm,
            {pct(mean('gols_sofridos', 5), 4)} AS gs, {venue_points('true')} AS ac, {venue_points('false')} AS af, {MOMENTUM} AS mo FROM crows) USING (competicao, clube_id, rodada)) JOIN base USING (clube_id)""",
    "mart_standings": "SELECT * FROM tablemart",
    "view_standings": "SELECT * FROM viewtable",
    "mart_predictions": "SELECT * FROM predmart",
    "mart_performance": "SELECT * FROM perf",
    "training_set": training("statejob"),
    "training_set_lagged": training("statelag"),
    "time_split": SPLIT,
    "training_rows": training("statebefore"),
    "features_ahead": f"""SELECT * REPLACE (round(elo_casa, 6) AS elo_casa, round(elo_vis, 6) AS elo_vis) FROM (SELECT {FIXTURE}, {side_columns('c', 'casa', '0')}, {side_columns('v', 'vis', '0')} FROM silver m
        LEFT JOIN statenext c ON c.competicao = m.competicao AND c.clube_id = m.clube_casa_id LEFT JOIN statenext v ON v.competicao = m.competicao AND v.clube_id = m.clube_vis_id
        WHERE m.resultado IS NULL)""",
    "predict": """SELECT competicao, partida_id, rodada, clube_casa_id, clube_vis_id, coalesce(c.nome, CAST(clube_casa_id AS VARCHAR)) AS nome_casa, coalesce(v.nome, CAST(clube_vis_id AS VARCHAR)) AS nome_vis,
        'v1' AS modelo_versao, true AS soma_um, true AS maior FROM silver LEFT JOIN club c ON c.clube_id = clube_casa_id LEFT JOIN club v ON v.clube_id = clube_vis_id WHERE resultado IS NULL""",
    "train_forest": f"""SELECT 'RandomForestClassifier' AS algoritmo, true AS acuracia, true AS f1_score, true AS log_loss, max(rodada) FILTER (conjunto = 'treino') AS rodada_treino,
        max(rodada) FILTER (conjunto = 'teste') AS rodada_teste, count(*) FILTER (conjunto = 'treino') AS linhas_treino, count(*) FILTER (conjunto = 'teste') AS linhas_teste FROM ({SPLIT})""",
    "model_roundtrip": f"SELECT count(*) AS partidas, CAST(count(*) AS BIGINT) AS iguais FROM ({SPLIT}) WHERE conjunto = 'teste'",
    "model_metrics": METRICS,
    "validate_predictions": "SELECT competicao, rodada, clube_casa_id, clube_vis_id, nome_casa, nome_vis, previsao, resultado_real, acerto, prob_casa, prob_empate, prob_visitante FROM valid",
    "relegation_risk": "SELECT * FROM risk",
    "relegation_piecewise": f"""SELECT competicao, clube_id, posicao, CAST(least(CASE WHEN posicao <= 4 THEN 0.01 + (posicao - 1) * 0.01 WHEN posicao <= 8 THEN 0.02 + (posicao - 4) * 0.02
        WHEN posicao <= 12 THEN 0.08 + (posicao - 8) * 0.04 WHEN posicao <= 16 THEN 0.22 + (posicao - 12) * 0.08 ELSE 0.55 + (posicao - 16) * 0.10 END, 0.95) AS DOUBLE) AS prob_rebaixamento,
        posicao >= 17 AS zona_rebaixamento FROM (SELECT *, {place('pontos_acumulados DESC, vitorias DESC, saldo_gols DESC, clube_id')} FROM latestrow)""",
    "min_sample_guard": "SELECT 'todas' AS conjunto, count(*) AS linhas, CASE WHEN count(*) >= 10 THEN 'success' ELSE 'skipped' END AS status FROM silver WHERE resultado IS NOT NULL UNION ALL SELECT 'nenhuma', 0, 'skipped'",
    "no_model_guard": "SELECT 'salvo' AS modelo, 'success' AS status, count(*) AS partidas FROM silver WHERE resultado IS NULL UNION ALL SELECT 'ausente', 'skipped', count(*) FROM silver WHERE resultado IS NULL",
    "accuracy_gate": f"""SELECT 'modelo_acuracia_minima' AS check_name, 'gold.modelos_registry' AS tabela, CASE WHEN acuracia >= 0.45 THEN 'success' ELSE 'warning' END AS status,
        CAST(1 AS BIGINT) AS records_checked, CAST(acuracia < 0.45 AS BIGINT) AS records_failed, format('acuracia={{:.4f}}', acuracia) AS detalhe FROM ({METRICS})""",
    "dq_row_count": all_of(counted("silver_partidas_count", "silver.partidas", "silver"), counted("silver_vazia_count", "silver.vazia", "silver WHERE rodada < 0")),
    "dq_not_null": all_of(*[report(f"not_null_{c}", "silver.partidas", "silver", f"{c} IS NULL") for c in ("rodada", "clube_casa_id", "clube_vis_id", "placar_casa")]),
    "dq_unique": all_of(
        unique("unique_clube_id", "bronze.clubes_info_raw", "(SELECT clube_id FROM club UNION ALL SELECT clube_id FROM club)", "clube_id"),
        unique("unique_partida_id", "silver.partidas", "silver", "partida_id")),
    "dq_accepted": all_of(
        report("accepted_values_resultado", "silver.partidas", "silver WHERE resultado IS NOT NULL", "resultado NOT IN ('casa', 'empate', 'visitante')"),
        report("accepted_values_resultado", "silver.partidas_sem_empate", "silver WHERE resultado IS NOT NULL", "resultado = 'empate'")),
    "dq_range": all_of(
        report("accepted_range_aproveitamento_pct", "gold.feature_store", "store", "aproveitamento_pct NOT BETWEEN 0 AND 100", "warning"),
        report("accepted_range_saldo_gols", "gold.feature_store", "store", "saldo_gols NOT BETWEEN 0 AND 10", "warning")),
    "dq_prob_sum": report("prob_soma_1", "gold.previsoes_proximas_partidas", "preds", "abs(prob_casa + prob_empate + prob_visitante - 1.0) > 0.01"),
    "dq_bounds": all_of(
        report("limites_pontos_acumulados", "gold.feature_store", "store", "pontos_acumulados < 0"),
        report("limites_aproveitamento_pct", "gold.feature_store", "store", "aproveitamento_pct < 0 OR aproveitamento_pct > 100"),
        report("limites_gols_sofridos", "gold.feature_store", "store", "gols_sofridos > 50"),
        report("limites_prob_rebaixamento", "gold.analise_rebaixamento", "risk", "prob_rebaixamento < 0 OR prob_rebaixamento > 1"),
        report("limites_acuracia_pct", "gold.vw_desempenho_modelo", "byround", "acuracia_pct < 0 OR acuracia_pct > 100")),
    "dq_positions": """SELECT competicao, min(posicao) AS primeira, max(posicao) AS ultima, count(*) AS clubes, CASE WHEN min(posicao) = 1 AND max(posicao) = count(*)
        AND count(DISTINCT posicao) = count(*) THEN 'success' ELSE 'failed' END AS status FROM viewtable GROUP BY competicao""",
    "dq_match_keys": all_of(*match_checks(f"(SELECT *, {RESULT} AS resultado FROM raw)"), report("limites_elo_rating", "gold.feature_store_enhanced", "featsql", "elo_rating < 1300 OR elo_rating > 1800")),
    "dq_status": all_of(
        report("sem_falha_critica", "gold.data_quality_checks", "runlog", "status = 'failed'"),
        """SELECT 'alguma_execucao_ok' AS check_name, 'gold.pipeline_executions' AS tabela, CASE WHEN f = 0 THEN 'success' ELSE 'failed' END AS status, n AS records_checked, f AS records_failed,
        f || ' de ' || n AS detalhe FROM (SELECT count(*) AS n, CAST(count(*) FILTER (status = 'success') = 0 AS BIGINT) AS f FROM runlog)"""),
    "dq_predictions": counted("inferencia_previsoes", "gold.previsoes_proximas_partidas", "ahead"),
    "dq_feature_keys": all_of(
        unique("unique_competicao_rodada_clube_id", "gold.feature_store", "store", "competicao, rodada, clube_id"),
        unique("unique_competicao_rodada_clube_id", "gold.feature_store_enhanced", "featsql", "competicao, rodada, clube_id"),
        unique("unique_competicao_clube_id", "gold.analise_rebaixamento", "risk", "competicao, clube_id")),
}


#: The same ratings over windows of time.
_BODIES |= dict.fromkeys(["elo_by_window", "elo_rerated"], _BODIES["elo"])
#: The same rows from the partitions that hold or get them.
_BODIES["upsert_partitions"] = _BODIES["upsert"]
_BODIES["performance_from_counts"] = _BODIES["mart_performance"]
#: The last round of each competition out of the whole grid.
_BODIES |= {
    name: f"SELECT * FROM ({_BODIES[whole]}) QUALIFY rodada = max(rodada) OVER (PARTITION BY competicao)"
    for name, whole in (("grid_last_round", "round_club_grid"), ("seed_last_round", "features_seed"))
}


def oracles() -> dict[str, str]:
    return {name: sql(body) for name, body in _BODIES.items()}
