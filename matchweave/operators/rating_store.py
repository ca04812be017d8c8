"""Elo kept as a table: rated window after window, in parallel within a window, again only from the first change on.

A window is a stretch of days. Clubs that met in it, directly or over others, are a component; components of one window
share no club, so each is a group of its own, whatever the competition's size. Ratings pass from window to window through the written table, so jobs follow
windows and tasks follow components. After a window that is a multiple of ``every`` all ratings are written as a snapshot.

Each window leaves a mark, the number and the hash of its matches. An update rates again from the first window whose mark is not
that of the matches given; what lies before is neither read nor rated, but for the last snapshot and the ratings written after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from matchweave.operators.clean import played
from matchweave.operators.components import components
from matchweave.operators.elo import K_FACTOR, LINE, POST, PRE, START_RATING, _moved, in_order
from matchweave.operators.latest import KEY
from matchweave.session import exists, remove, stage

WINDOW = "_janela"
#: The window of matches without a date: after all others.
UNDATED = 1 << 30
DAYS, EVERY = 7, 8


class RatingStore:
    """Rated matches and ratings under one folder, every executor's to reach."""

    def __init__(self, spark: SparkSession, root: str, key: Sequence[str] = KEY, k: float = K_FACTOR, start: float = START_RATING, days: int = DAYS, every: int = EVERY):
        self.spark, self.root, self.key, self.k, self.start, self.days, self.every = spark, root, list(key), k, start, days, every

    def _path(self, table: str, window: int | None = None) -> str:
        return f"{self.root}/{table}" if window is None else f"{self.root}/{table}/{WINDOW}={window}"

    def _windowed(self, matches: DataFrame) -> DataFrame:
        number = F.floor(F.datediff(F.col("data_partida").cast("date"), F.lit("1970-01-01").cast("date")) / self.days)
        return played(matches).withColumn(WINDOW, F.coalesce(number, F.lit(UNDATED)).cast("int"))

    def _marks(self) -> dict[int, tuple[int, int]]:
        """Of each rated window the number and the hash of its matches; a window of a run that broke off has none."""
        if not exists(self.spark, self._path("marcas")):
            return {}
        rows = self.spark.read.schema("janela int, n bigint, marca decimal(38,0)").parquet(self._path("marcas")).collect()
        return {r.janela: (r.n, int(r.marca)) for r in rows}

    def _hold(self, marks: dict[int, tuple[int, int]]) -> None:
        rows = [(w, n, Decimal(m)) for w, (n, m) in sorted(marks.items())]
        self.spark.createDataFrame(rows, "janela int, n bigint, marca decimal(38,0)").coalesce(1).write.mode("overwrite").parquet(self._path("marcas"))

    def _written(self, table: str, kinds: T.StructType, windows: Sequence[int]) -> DataFrame:
        """The rows of some windows of a table; folders are named, so none but these is listed or read."""
        paths = [self._path(table, w) for w in windows]
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*kinds.fields, T.StructField(WINDOW, T.IntegerType())]))
        return self.spark.read.schema(T.StructType([*kinds.fields, T.StructField(WINDOW, T.IntegerType())])).option("basePath", self._path(table)).parquet(*paths)

    def _rating_schema(self, facts: DataFrame) -> T.StructType:
        return T.StructType([facts.schema[c] for c in self.key]).add("clube_id", T.LongType()).add("elo", T.DoubleType())

    def _ratings(self, facts: DataFrame, rated: Sequence[int], shots: Sequence[int], window: int) -> DataFrame:
        """Ratings before ``window``: the last snapshot, and over it those written since."""
        last = max((w for w in shots if w < window), default=None)
        since = [w for w in rated if w < window and (last is None or w > last)]
        schema = self._rating_schema(facts)
        both = self._written("fotos", schema, [] if last is None else [last]).unionByName(self._written("notas", schema, since))
        return both.groupBy(*self.key, "clube_id").agg(F.max_by("elo", WINDOW).alias("elo"))

    def _grouped(self, facts: DataFrame) -> DataFrame:
        """``facts`` with the component of each match, of all windows at once."""
        node = lambda club: F.to_json(F.struct(WINDOW, *self.key, F.col(club).alias("_clube")))
        roots = components(facts.select(node("clube_casa_id").alias("a"), node("clube_vis_id").alias("b")))
        return facts.join(roots.withColumnRenamed("root", "_grupo"), node("clube_casa_id") == F.col("node")).drop("node")

    def update(self, matches: DataFrame) -> list[int]:
        """Bring the store to the played ones of ``matches``; the windows that were rated, in order.

        ``matches`` is all that is known now. It is read once for the marks and, from the first window that differs on, once to be rated. A new day costs its own
        windows; a corrected or withdrawn old match all windows from its own on; the same matches again nothing.
        """
        all_ = self._windowed(matches)
        own = F.sum(F.xxhash64(*sorted(matches.columns)).cast("decimal(38,0)")).alias("m")
        new = {r[WINDOW]: (r.n, int(r.m)) for r in all_.groupBy(WINDOW).agg(F.count(F.lit(1)).alias("n"), own).collect()}
        old = self._marks()
        differ = [w for w in {*new, *old} if new.get(w) != old.get(w)]
        if not differ:
            return []
        first = min(differ)
        kept = {w: m for w, m in old.items() if w < first}
        if old:
            self._hold(kept)  # from here on a broken run rates from the first change again
        for window in (w for w in {*new, *old} if w >= first):
            for table in ("partidas", "notas", "fotos"):
                remove(self.spark, self._path(table, window))
        lines = stage(all_.filter(F.col(WINDOW) >= first).withColumn(LINE, F.monotonically_increasing_id()), "elo_janelas")
        facts = stage(self._grouped(lines.select(*self.key, WINDOW, LINE, "data_partida", "partida_id", "clube_casa_id", "clube_vis_id", "resultado")), "elo_grupos")
        todo, rated = sorted(w for w in new if w >= first), sorted(kept)
        shots = [w for n, w in enumerate(rated) if n % self.every == self.every - 1]
        for window in todo:
            before = self._ratings(facts, rated, shots, window)
            self._rate(lines, facts, before, window)
            rated.append(window)
            if len(rated) % self.every == 0:
                self._ratings(facts, rated, shots, window + 1).write.parquet(self._path("fotos", window))
                shots.append(window)
            kept[window] = new[window]
            if len(rated) % self.every == 0 or window == todo[-1]:
                self._hold(kept)
        if not todo:
            self._hold(kept)
        return todo

    def _rate(self, lines: DataFrame, facts: DataFrame, before: DataFrame, window: int) -> None:
        """One window: the matches of a component in order, from the ratings of its clubs."""
        own = facts.filter(F.col(WINDOW) == window)
        sides = own.select(*self.key, F.col("_grupo").alias("_do"), F.explode(F.array(F.col("clube_casa_id").cast("bigint"), F.col("clube_vis_id").cast("bigint"))).alias("clube_id")).distinct()
        named = sides.select("_do", "clube_id", *[F.col(c).alias(f"_k{n}") for n, c in enumerate(self.key)])
        same = [F.col(c).eqNullSafe(F.col(f"_k{n}")) for n, c in enumerate(self.key)]
        met = before.withColumnRenamed("clube_id", "_clube").join(named, [*same, F.col("_clube") == F.col("clube_id")])
        known = met.select(F.col("_do").alias("_grupo"), *self.key, "_clube", F.col("elo").alias("_elo"))
        out = stage(in_order(own, ["_grupo", *self.key], self.k, self.start, known), "elo_janela")
        new = out.filter(F.col(LINE).isNull())
        new.select(*self.key, F.col("_clube").alias("clube_id"), F.col(PRE[0]).alias("elo")).write.parquet(self._path("notas", window))
        rated = lines.filter(F.col(WINDOW) == window).join(out.filter(F.col(LINE).isNotNull()).select(LINE, *PRE), LINE).drop(LINE, WINDOW)
        rated.withColumns(dict(zip(POST, _moved(self.k)))).write.parquet(self._path("partidas", window))

    def marked(self) -> bool:
        """Whether any match has been rated."""
        return bool(self._marks())

    def rated(self) -> DataFrame:
        """Played matches with both clubs' ratings before and after each."""
        marks = sorted(self._marks())
        if not marks:
            raise ValueError("no match has been rated")
        return self.spark.read.option("basePath", self._path("partidas")).parquet(*[self._path("partidas", w) for w in marks]).drop(WINDOW)


def elo_by_window(matches: DataFrame, root: str, key: Sequence[str] = KEY, days: int = DAYS, every: int = EVERY) -> DataFrame:
    """Played matches with the ratings before and after each, from the store under ``root``, which is brought up to date first."""
    store = RatingStore(matches.sparkSession, root, key, days=days, every=every)
    store.update(matches)
    return store.rated() if store.marked() else played(matches).limit(0).withColumns({c: F.lit(None).cast("double") for c in (*PRE, *POST)})
