"""ARIMA by exact Gaussian likelihood over series of any length.

An ARMA process in innovations form has one noise source that each observation reveals, so
given the state x before a stretch of the series, every later state and innovation of the
stretch is linear in x: the last state is A x + b, the innovations are u - g x.  A stretch is
therefore summed up by (A, b, J = sum g g', e = sum g u, s = sum u u), and two neighbouring
stretches combine into one by small matrix products, associatively.  Chunks of positions are
folded in parallel, the chunks of a series are combined in a tree, and the stationary prior
of the first state turns a summary into the likelihood, the last state and its covariance.

Parameters are searched for all series and orders at once: a round scores a handful of
candidates each and moves every search by the parabola through its scores.  Searches of one
order are moved as arrays, not one by one.  A series that one chunk holds has all its rounds in
the task that has the chunk; longer ones take one job a round over the chunks.  The driver sees
no scores.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.unitroot import BLOCK, positions, with_border
from panelforge.session import materialize

ORDERS = [(p, d, q) for p in range(3) for d in range(2) for q in range(3)]
#: Chunk summaries combined by one step of the tree.
FAN = 64
#: Size of the state: orders p up to 3 and q up to 2.
STATE = 3


def coefficients(raw: np.ndarray) -> np.ndarray:
    """Coefficients of stationary polynomials from unbounded numbers (the last axis), through partial autocorrelations."""
    r = np.tanh(np.asarray(raw, float))
    out = r[..., :0]
    for k in range(r.shape[-1]):
        own = r[..., k: k + 1]
        out = np.concatenate([out - own * out[..., ::-1], own], axis=-1)
    return out


class Arma:
    """Matrices of a batch of ARMA models of the same orders or not: candidates are rows (p, q, mean, raw AR, raw MA)."""

    def __init__(self, orders: Sequence[tuple[int, int, int]], raws: Sequence[Sequence[float]]):
        n = len(orders)
        self.mean = np.zeros(n)
        self.step = np.zeros((n, STATE, STATE))
        self.gain = np.zeros((n, STATE))
        self.gain[:, 0] = 1
        places = {}
        for at, order in enumerate(orders):
            places.setdefault(tuple(order), []).append(at)
        for (p, d, q), at in places.items():
            raw = np.array([raws[k] for k in at], float).reshape(len(at), -1)
            if d == 0:
                self.mean[at], raw = raw[:, 0], raw[:, 1:]
            self.step[at, :p, 0] = coefficients(raw[:, :p])
            self.gain[at, 1: q + 1] = -coefficients(raw[:, p: p + q])
        self.step[:, np.arange(STATE - 1), np.arange(1, STATE)] = 1
        self.first = self.step[:, 0, :]
        self.closed = self.step - self.gain[:, :, None] * self.first[:, None, :]

    def prior(self) -> np.ndarray:
        """Stationary covariance of the state, in units of the innovation variance."""
        eye = np.eye(STATE * STATE)
        kron = np.einsum("nij,nkl->nikjl", self.step, self.step).reshape(len(self.mean), STATE * STATE, -1)
        noise = (self.gain[:, :, None] * self.gain[:, None, :]).reshape(len(self.mean), -1, 1)
        return np.linalg.solve(eye - kron, noise).reshape(-1, STATE, STATE)

    def fold(self, values: np.ndarray) -> np.ndarray:
        """Summary rows (A, b, J, e, s, number of values) of one stretch, one per candidate."""
        return self.fold_each(np.broadcast_to(np.asarray(values, float), (len(self.mean), len(values))))

    def fold_each(self, values: np.ndarray) -> np.ndarray:
        """The same for a stretch of its own for every candidate, all of one length: row k of ``values`` is that of candidate k."""
        n = len(self.mean)
        a, b = np.tile(np.eye(STATE), (n, 1, 1)), np.zeros((n, STATE))
        j, e, s = np.zeros((n, STATE, STATE)), np.zeros((n, STATE)), np.zeros(n)
        for y in values.T:
            z = y - self.mean
            u = z - (self.first * b).sum(axis=1)
            g = np.einsum("ni,nij->nj", self.first, a)
            j += g[:, :, None] * g[:, None, :]
            e += g * u[:, None]
            s += u * u
            b = np.einsum("nij,nj->ni", self.closed, b) + self.gain * z[:, None]
            a = self.closed @ a
        return pack(a, b, j, e, s, np.full(n, float(values.shape[1])))


def pack(a, b, j, e, s, n) -> np.ndarray:
    k = len(s)
    return np.concatenate([a.reshape(k, -1), b, j.reshape(k, -1), e, s[:, None], n[:, None]], axis=1)


def unpack(rows: np.ndarray):
    m = STATE * STATE
    a, b, j, e, s, n = np.split(rows, [m, m + STATE, 2 * m + STATE, 2 * m + 2 * STATE, 2 * m + 2 * STATE + 1], axis=1)
    return a.reshape(-1, STATE, STATE), b, j.reshape(-1, STATE, STATE), e, s[:, 0], n[:, 0]


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Summaries of stretches that follow each other."""
    a, b, j, e, s, n = unpack(left)
    a2, b2, j2, e2, s2, n2 = unpack(right)
    at = np.swapaxes(a, 1, 2)
    jb = np.einsum("nij,nj->ni", j2, b)
    return pack(a2 @ a, np.einsum("nij,nj->ni", a2, b) + b2, j + at @ j2 @ a,
                e + np.einsum("nij,nj->ni", at, e2 - jb), s + s2 - 2 * (e2 * b).sum(axis=1) + (b * jb).sum(axis=1), n + n2)


def conclude(rows: np.ndarray, prior: np.ndarray) -> dict[str, np.ndarray]:
    """Log likelihood with the innovation variance at its optimum, that variance, the last state and its covariance in units of it."""
    a, b, j, e, s, n = unpack(rows)
    mixed = np.eye(STATE) + prior @ j
    cov = np.linalg.solve(mixed, prior)
    start = np.einsum("nij,nj->ni", cov, e)
    spread = np.log(np.maximum(np.linalg.det(mixed), 1e-300))
    var = np.maximum(s - (e * start).sum(axis=1), 0.0) / np.maximum(n, 1)
    with np.errstate(divide="ignore"):
        ll = -0.5 * (n * (np.log(2 * np.pi * var) + 1) + spread)
    return {"ll": ll, "var": var, "state": np.einsum("nij,nj->ni", a, start) + b, "cov": a @ cov @ np.swapaxes(a, 1, 2)}


# ---------------------------------------------------------------- Spark

def chunks(series: DataFrame, key: str, period: str = "t", width: int = BLOCK) -> DataFrame:
    """(key, d, chunk, values): each series in units of its deviation from its mean, and its differences, in chunks of positions."""
    rows = series.where("y is not null").select(key, period, F.col("y").cast("double").alias("y"))
    stats = rows.groupBy(key).agg(F.avg("y").alias("_m"), F.stddev_pop("y").alias("_s")).where("_s > 0")
    rows = positions(rows, key, period, width=width).join(stats, key).select(
        key, "pos", ((F.col("y") - F.col("_m")) / F.col("_s")).alias("y"))
    rows = with_border(rows, "pos", 1, width)
    rows = rows.withColumn("dy", F.col("y") - F.lag("y").over(Window.partitionBy(key, "_block").orderBy("pos"))).where("not _copy")
    each = F.explode(F.array(F.struct(F.lit(0).alias("d"), F.col("y").alias("v")), F.struct(F.lit(1).alias("d"), F.col("dy").alias("v"))))
    rows = rows.select(key, F.col("_block").alias("chunk"), "pos", each.alias("x")).where("x.v is not null")
    held = F.array_sort(F.collect_list(F.struct("pos", "x.v")))  # at most ``width`` values
    return rows.groupBy(key, F.col("x.d").alias("d"), "chunk").agg(F.transform(held, lambda r: r["v"]).alias("values"))


def summaries(parts: DataFrame, candidates: DataFrame, key: str, fan: int = FAN) -> DataFrame:
    """(key, p, d, q, c, raw, summary) of all candidates (key, p, d, q, c, raw) over whole series."""
    lists = candidates.groupBy(key, "d").agg(F.collect_list(F.struct("p", "q", "c", "raw")).alias("cands"))
    work = parts.join(lists, [key, "d"]).select(key, "d", "chunk", "values", "cands")
    kind = dict(parts.dtypes)[key]

    def fold(batches):
        for batch in batches:
            out = {c: [] for c in ("key", "d", "chunk", "p", "q", "c", "raw", "summary")}
            for k, d, chunk, values, cands in zip(*(batch.column(i) for i in range(5))):
                cands, d_ = cands.as_py(), d.as_py()
                rows = Arma([(x["p"], d_, x["q"]) for x in cands], [x["raw"] for x in cands]).fold(
                    values.values.to_numpy(zero_copy_only=False))
                for x, row in zip(cands, rows.tolist()):
                    for c, v in zip(out.values(), (k.as_py(), d_, chunk.as_py(), x["p"], x["q"], x["c"], x["raw"], row)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["key"], batch.column(0).type), *[pa.array(out[c], pa.int32()) for c in ("d",)],
                 pa.array(out["chunk"], pa.int64()), *[pa.array(out[c], pa.int32()) for c in ("p", "q", "c")],
                 *[pa.array(out[c], pa.list_(pa.float64())) for c in ("raw", "summary")]],
                [key, "d", "chunk", "p", "q", "c", "raw", "summary"])

    schema = f"`{key}` {kind}, d int, chunk long, p int, q int, c int, raw array<double>, summary array<double>"
    made = work.mapInArrow(fold, schema)
    top = parts.agg(F.max("chunk")).first()[0] or 0
    by = [key, "p", "d", "q", "c"]

    def joined(pdf: pd.Series) -> pd.Series:
        def one(rows):
            whole = np.asarray(rows[0]["summary"], float)[None]
            for r in rows[1:]:
                whole = combine(whole, np.asarray(r["summary"], float)[None])
            return whole[0]
        return pdf.map(one)

    join = F.pandas_udf(joined, "array<double>")
    while top > 0:  # one step of the tree
        rows = F.array_sort(F.collect_list(F.struct("chunk", "summary")))  # at most ``fan`` summaries
        made = (made.groupBy(*by, F.floor(F.col("chunk") / fan).alias("chunk")).agg(F.first("raw").alias("raw"), rows.alias("rows"))
                .withColumn("summary", join("rows")).drop("rows"))
        top //= fan
    return made.drop("chunk")


def likelihoods(parts: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """(key, p, d, q, c, ll, var) of given parameters over whole series, in the units of the chunks."""
    kind = dict(parts.dtypes)[key]

    def run(batches):
        for pdf in batches:
            model = Arma(list(zip(pdf["p"], pdf["d"], pdf["q"])), list(pdf["raw"]))
            end = conclude(np.array([np.asarray(s, float) for s in pdf["summary"]]), model.prior())
            yield pdf[[key, "p", "d", "q", "c"]].assign(ll=end["ll"], var=end["var"])

    return summaries(parts, candidates, key).select(key, "p", "d", "q", "c", "raw", "summary").mapInPandas(
        run, f"`{key}` {kind}, p int, d int, q int, c int, ll double, var double")


_SEARCH = "p int, d int, q int, step double, ll double, raws array<array<double>>"
#: Candidates scored at once in a task, and values they read.
BATCH, BATCH_VALUES = 4096, 2**20
FIRST_STEP = 0.4


def first_candidates(size: int) -> np.ndarray:
    """The first candidates of a search over ``size`` numbers: all zero, both sides of each, and zero again for the parabolas."""
    sides = [sign * FIRST_STEP * np.eye(size)[i] for i in range(size) for sign in (-1, 1)]
    return np.stack([np.zeros(size), *sides, *[np.zeros(size)] * (2 if size else 0)])


def moved(raws: np.ndarray, step: np.ndarray, ll: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next candidates, steps and best scores of searches of one order from their candidates (search, c, number) and scores.

    Candidate 0 is the best so far, then both sides of each number, then the parabolas' vertex and the middle to it.
    """
    n, _, size = raws.shape
    ll = np.where(np.isfinite(ll), ll, -1e300)
    best, every = ll.argmax(axis=1), np.arange(n)
    top = ll[every, best]
    if not size:
        return raws[:, :1], step, top
    low, high = ll[:, 1: 2 * size: 2], ll[:, 2: 2 * size + 1: 2]
    bend = low - 2 * ll[:, :1] + high
    own = step[:, None]
    shift = np.where(bend < 0, own / 2 * (low - high) / np.where(bend < 0, bend, -1.0), np.where(high > low, own, -own))
    vertex = raws[:, 0] + np.clip(shift, -3 * own, 3 * own)
    step = np.where(best == 0, step / 2, step)
    now = raws[every, best]
    sides = [now + sign * step[:, None] * np.eye(size)[i] for i in range(size) for sign in (-1, 1)]
    return np.stack([now, *sides, vertex, (vertex + now) / 2], axis=1), step, top


def _search_whole(values: np.ndarray, order: tuple[int, int, int], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(best numbers, best scores) of one order for series of one length (rows), all rounds."""
    p, d, q = order
    size = p + q + (d == 0)
    start = first_candidates(size)
    raws, step = np.tile(start, (len(values), 1, 1)), np.full(len(values), FIRST_STEP)
    top = np.full(len(values), -1e300)
    for _ in range(rounds):
        c = raws.shape[1]
        model = Arma([order] * (len(values) * c), raws.reshape(len(values) * c, size))
        ll = conclude(model.fold_each(np.repeat(values, c, axis=0)), model.prior())["ll"].reshape(-1, c)
        raws, step, top = moved(raws, step, ll)
    return raws[:, 0], top


def _fit_short(parts: DataFrame, key: str, orders: Sequence[tuple], rounds: int) -> DataFrame:
    """(key, p, d, q, raw, ll) of series that one chunk holds: their rounds need no other task."""
    kind = dict(parts.dtypes)[key]

    def run(batches):
        for batch in batches:
            keys, ds, lists = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            values = [v.values.to_numpy(zero_copy_only=False) for v in lists]
            alike = {}
            for at, (d, v) in enumerate(zip(ds, values)):
                alike.setdefault((int(d), len(v)), []).append(at)
            for (d, length), places in alike.items():
                for order in (o for o in orders if o[1] == d):
                    width = max(1, min(BATCH, BATCH_VALUES // length) // (2 * (order[0] + order[2] + 1) + 3))
                    for begin in range(0, len(places), width):
                        at = places[begin: begin + width]
                        raw, ll = _search_whole(np.stack([values[i] for i in at]), order, rounds)
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(at)), *[pa.array([v] * n, pa.int32()) for v in order],
                             pa.array(raw.tolist(), pa.list_(pa.float64())), pa.array(ll)], [key, "p", "d", "q", "raw", "ll"])

    return parts.select(key, "d", "values").mapInArrow(run, f"`{key}` {kind}, p int, d int, q int, raw array<double>, ll double")


def _fit_long(parts: DataFrame, key: str, orders: Sequence[tuple], rounds: int) -> DataFrame:
    """(key, p, d, q, raw, ll) of series of many chunks, one job a round."""
    spark = parts.sparkSession
    table = spark.createDataFrame([(p, d, q, FIRST_STEP, None, first_candidates(p + q + (d == 0)).tolist()) for p, d, q in orders], _SEARCH)
    search = parts.select(key, "d").distinct().join(F.broadcast(table), "d").select(key, *table.columns)
    by = [key, "p", "d", "q"]
    schema = f"`{key}` {dict(parts.dtypes)[key]}, {_SEARCH}"

    def move(batches):
        for pdf in batches:
            for (p, d, q), own in pdf.groupby(["p", "d", "q"], sort=False):
                rows = [sorted(held, key=lambda x: x["c"]) for held in own["held"]]
                raws = np.array([[x["raw"] for x in held] for held in rows], float)
                n, c, size = raws.shape
                model = Arma([(p, d, q)] * (n * c), raws.reshape(n * c, size))
                ends = conclude(np.array([x["summary"] for held in rows for x in held], float), model.prior())
                raws, step, top = moved(raws, own["step"].to_numpy(), ends["ll"].reshape(n, c))
                yield pd.DataFrame({key: own[key].to_numpy(), "p": p, "d": d, "q": q, "step": step, "ll": top, "raws": raws.tolist()})

    for _ in range(rounds):
        cands = search.select(*by, F.posexplode("raws").alias("c", "raw"))
        held = summaries(parts, cands, key).groupBy(*by).agg(F.collect_list(F.struct("c", "raw", "summary")).alias("held"))
        search = materialize(held.join(search.select(*by, "step"), by).mapInPandas(move, schema))
    return search.select(*by, F.get("raws", F.lit(0)).alias("raw"), "ll")


def fit(series: DataFrame, key: str, period: str = "t", orders: Sequence[tuple] = ORDERS, rounds: int = 14,
        width: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Fits (key, p, d, q, raw, ll, aic, n_params) of every order and the chunks they were fitted on.

    d = 0 has a mean, d = 1 is the same model of the differences.  ll is that of the series in
    its own units.  Series without variation have no fits.
    """
    parts = materialize(chunks(series, key, period, width))
    most = parts.withColumn("_most", F.max("chunk").over(Window.partitionBy(key)))
    short, long = most.where("_most = 0").drop("_most"), most.where("_most > 0").drop("_most")
    n = 2 * series.sparkSession.sparkContext.defaultParallelism  # little data, much work: not by size
    fits = _fit_short(short.repartition(n, key, "d"), key, orders, rounds)
    if long.limit(1).count():
        fits = fits.unionByName(_fit_long(materialize(long), key, orders, rounds))
    fits = materialize(fits)
    n = series.where("y is not null").groupBy(key).agg(F.count("y").alias("_n"), F.stddev_pop("y").alias("_s"))
    k = F.size("raw") + 1
    out = fits.join(n, key)
    ll = F.col("ll") - (F.col("_n") - F.col("d")) * F.log("_s")
    return out.select(key, "p", "d", "q", "raw", ll.alias("ll"), (-2 * ll + 2 * k).alias("aic"), k.alias("n_params")), parts


def select_order(fits: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """FC-4: per key the order with the lowest AIC (ties: the smaller one); (1, 1, 1) without an AIC where nothing could be fitted."""
    best = fits.where("ll > -1e299").groupBy(key).agg(
        F.min_by(F.struct("p", "d", "q", "raw", "ll"), F.struct("aic", "p", "d", "q")).alias("o"), F.min("aic").alias("aic"))
    one = F.lit(1)
    return keys.select(key).distinct().join(best, key, "left").select(
        key, *[F.coalesce(f"o.{c}", one).alias(c) for c in ("p", "d", "q")], "aic", F.col("o.ll").alias("ll"), F.col("o.raw").alias("raw"))


def forecast(series: DataFrame, chosen: DataFrame, parts: DataFrame, key: str, period: str = "t", steps: int = 3,
             alpha: float = 0.2) -> DataFrame:
    """FC-5: mean and (1 - alpha) interval of the next ``steps`` periods from the last state; keys without a fit: none."""
    from panelforge.functions.dist import norm_ppf
    z = norm_ppf(1 - alpha / 2)
    cands = chosen.where("raw is not null").select(key, "p", "d", "q", F.lit(0).alias("c"), "raw")
    whole = summaries(parts, cands, key)
    last = series.where("y is not null").groupBy(key).agg(
        F.max(period).alias("last"), F.max_by("y", period).alias("y"), F.avg("y").alias("m"), F.stddev_pop("y").alias("s"))
    kinds = dict(series.dtypes)

    def run(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                model = Arma([(r.p, r.d, r.q)], [r.raw])
                end = conclude(np.asarray(r.summary, float)[None], model.prior())
                # the state is extended by the sum of its first component, the level of a differenced series
                t = np.zeros((STATE + 1, STATE + 1))
                t[:STATE, :STATE] = model.step[0]
                t[STATE, :STATE], t[STATE, STATE] = model.first[0], 1.0
                g = np.append(model.gain[0], 1.0)
                x, cov = np.append(end["state"][0], 0.0), np.zeros((STATE + 1, STATE + 1))
                cov[:STATE, :STATE] = end["cov"][0]
                for h in range(1, steps + 1):
                    x, cov = t @ x, t @ cov @ t.T + np.outer(g, g)
                    at = STATE if r.d else 0
                    mean = r.y + r.s * x[at] if r.d else r.m + r.s * (model.mean[0] + x[at])
                    half = z * r.s * float(np.sqrt(max(cov[at, at], 0.0) * end["var"][0]))
                    rows.append((getattr(r, "key_"), h, r.last + h, mean, mean - half, mean + half, r.p, r.d, r.q))
            yield pd.DataFrame(rows, columns=[key, "step", period, "forecast", "lo", "hi", "p", "d", "q"])

    work = whole.join(last, key).withColumnRenamed(key, "key_")
    return work.mapInPandas(run, f"`{key}` {kinds[key]}, step int, `{period}` {kinds[period]}, forecast double, lo double, hi double, "
                                 "p int, d int, q int")
