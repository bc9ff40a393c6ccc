"""Piecewise linear trends with sparse changes of slope, one for each entity.

The most probable parameters under normal priors for the slope and the regressors and
a Laplace prior for each change of slope, which makes most changes exactly zero. All
that a fit needs are moments of the rows between neighbouring changepoints: built-in
sums give them, suffix sums over at most ``CHANGEPOINTS`` segments turn them into
products of hinges, and coordinate descent runs on a whole Arrow batch of entities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import codes
from .regression import linear_score

# ---- Fixed values: priors in units of scaled time and target, interval width ----
CHANGEPOINTS = 25
CHANGEPOINT_PRIOR = 0.05
TREND_PRIOR = 5.0
REGRESSOR_PRIOR = 10.0
NOISE_PRIOR = 0.5
INTERVAL = (0.1, 0.9)
INTERVAL_Z = 1.2816
# ----------------------------------------------------------------------------------
#: Simulated futures behind an interval.
DRAWS = 1000
LEAST_NOISE = 1e-4
#: Rounds of descent, sweeps and joint steps in each, and the change at which a fit is done.
ROUNDS, SWEEPS, STEPS, DONE = 500, 1, 10, 1e-9
#: Modulus and steps of the draws' numbers.
MODULUS, DRAW_STEP, EVENT_STEP, KIND_STEP, TURN = 2147483647, 1000003, 7919, 104729, 48271


def trend_rows(train: DataFrame, entity: str, period: str, target: str, regressors: list[str], changepoints: int) -> DataFrame:
    """Complete rows in scaled time and target, with the segment between changepoints that each lies in.

    Changepoints are rows spread evenly over the first four fifths of an entity's rows;
    segment k holds the rows from the k-th changepoint to the next. All windows share one
    placement by entity, whose rows its calendar bounds.
    """
    own = Window.partitionBy(entity)
    rows = train.dropna(subset=[target, *regressors]).select(
        entity,
        F.col(period).cast("double").alias("_p"),
        F.col(target).cast("double").alias("_v"),
        *[F.col(x).cast("double").alias(f"_x{i}") for i, x in enumerate(regressors)],
    )
    top = F.max(F.abs("_v")).over(own)
    spreads = {f"_s{i}": F.stddev_pop(f"_x{i}").over(own) for i in range(len(regressors))}
    means = {f"_m{i}": F.avg(f"_x{i}").over(own) for i in range(len(regressors))}
    scaled = rows.withColumns(
        {
            "_rank": F.row_number().over(own.orderBy("_p")) - 1,
            "_early": F.expr(f"(count(*) OVER (PARTITION BY `{entity}`) * 4) div 5"),
            "_t0": F.min("_p").over(own),
            "_span": F.greatest(F.max("_p").over(own) - F.min("_p").over(own), F.lit(1.0)),
            "_top": F.when(top > 0, top).otherwise(1.0),
            **means,
            **spreads,
        }
    )
    count = F.least(F.lit(changepoints), F.col("_early") - 1)
    segment = F.expr("((2 * _rank + 1) * _knots - 1) div nullif(2 * (_early - 1), 0)")
    units = {
        f"_u{i}": F.when(F.col(f"_s{i}") > 0, (F.col(f"_x{i}") - F.col(f"_m{i}")) / F.col(f"_s{i}")).otherwise(0.0)
        for i in range(len(regressors))
    }
    return scaled.withColumn("_knots", F.greatest(count, F.lit(0))).withColumns(
        {
            "_segment": F.when(F.col("_knots") > 0, F.least(segment, F.col("_knots"))).otherwise(0),
            "_t": (F.col("_p") - F.col("_t0")) / F.col("_span"),
            "_y": F.col("_v") / F.col("_top"),
            **units,
        }
    )


def segment_moments(rows: DataFrame, entity: str, many: int) -> DataFrame:
    """One row for each entity: its scales, and per segment the first time and the sums of products."""
    columns = [F.lit(1.0), F.col("_t"), *[F.col(f"_u{i}") for i in range(many)], F.col("_y")]
    sums = [F.sum(a * b) for i, a in enumerate(columns) for b in columns[i:]]
    scales = {"t0": F.first("_t0"), "t_span": F.first("_span"), "top": F.first("_top"), "knots": F.first("_knots")}
    scales["means"] = F.array(*[F.first(f"_m{i}") for i in range(many)])
    scales["spreads"] = F.array(*[F.first(f"_s{i}") for i in range(many)])
    parts = rows.groupBy(entity, "_segment").agg(
        F.min("_t").alias("at"), F.array(*sums).alias("sums"), *[v.alias(k) for k, v in scales.items()]
    )
    listed = F.array_sort(F.collect_list(F.struct("_segment", "at", "sums")))
    return parts.groupBy(entity).agg(listed.alias("listed"), *[F.first(c).alias(c) for c in scales]).select(
        entity,
        *scales,
        F.transform("listed", lambda x: x["_segment"].cast("int")).alias("segment"),
        F.transform("listed", lambda x: x["at"]).alias("at"),
        F.flatten(F.transform("listed", lambda x: x["sums"])).alias("sums"),
    )


def hinge_system(sums: np.ndarray, at: np.ndarray, segment: np.ndarray, row: np.ndarray, many: int, knots: int):
    """Centred products of (t, regressors, hinges, y) for ``many`` entities, rows of them, and changepoint times."""
    width = int((np.sqrt(8 * sums.shape[1] + 1) - 1) / 2)
    upper = np.triu_indices(width)
    part = np.zeros((many, knots + 1, width, width))
    filled = np.zeros((len(row), width, width))
    filled[:, upper[0], upper[1]] = sums
    filled[:, upper[1], upper[0]] = sums
    part[row, segment] = filled
    times = np.zeros((many, knots + 1))
    times[row, segment] = at
    after = np.cumsum(part[:, ::-1], axis=1)[:, ::-1]  # sums over the rows from a segment on
    knot = times[:, 1:]
    size = width - 1 + knots
    full = np.zeros((many, size + 1, size + 1))  # 1, t, regressors, hinges, y
    plain = [*range(width - 1), size]
    full[np.ix_(range(many), plain, plain)] = after[:, 0]
    cross = after[:, 1:, 1] - knot[:, :, None] * after[:, 1:, 0]
    hinges = [*range(width - 1, size)]
    full[np.ix_(range(many), hinges, plain)] = cross
    full[np.ix_(range(many), plain, hinges)] = cross.transpose(0, 2, 1)
    later = np.maximum(np.arange(knots)[:, None], np.arange(knots)[None, :]) + 1
    square, single, count = (after[:, :, a, b][:, later] for a, b in ((1, 1), (0, 1), (0, 0)))
    product = square - (knot[:, :, None] + knot[:, None, :]) * single + knot[:, :, None] * knot[:, None, :] * count
    full[:, width - 1 : size, width - 1 : size] = product
    n = full[:, 0, 0]
    mean = full[:, 0, 1:] / n[:, None]
    return n, mean, full[:, 1:, 1:] - n[:, None, None] * mean[:, :, None] * mean[:, None, :], knot


def joint_step(inner: np.ndarray, goal: np.ndarray, slopes: np.ndarray, threshold: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All slopes that are not zero move together towards their optimum, until the first one reaches zero.

    Neighbouring hinges are nearly alike, so single coordinates would creep.
    """
    active = slopes != 0
    masked = np.where(active[:, :, None] & active[:, None, :], inner, 0.0)
    diagonal = np.arange(slopes.shape[1])
    masked[:, diagonal, diagonal] += np.where(active, 1e-13 * n[:, None], 1.0)
    wanted = np.where(active, goal - threshold[:, None] * np.sign(slopes), 0.0)
    best = np.linalg.solve(masked, wanted[:, :, None])[:, :, 0]
    crossing = active & (np.sign(best) != np.sign(slopes))
    until = np.divide(slopes, slopes - best, out=np.ones_like(slopes), where=crossing)
    share = until.min(axis=1, initial=1.0)[:, None]
    return np.where(crossing & (until <= share), 0.0, slopes + share * (best - slopes))


def most_probable(n: np.ndarray, gram: np.ndarray, plain: int) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, noise) of many centred systems whose last column is the target.

    The first ``plain`` coefficients have normal priors and are eliminated exactly; the
    others, with Laplace priors, are found by coordinate descent with soft thresholds and
    joint steps. The noise, with a half normal prior, is updated between the sweeps. Finished systems
    leave the batch.
    """
    size = gram.shape[1] - 1
    prior = np.array([TREND_PRIOR] + [REGRESSOR_PRIOR] * (plain - 1)) ** -2.0
    result, noise = np.zeros((len(n), size)), np.ones(len(n))
    slopes, variance, live = np.zeros((len(n), size - plain)), np.ones(len(n)), np.arange(len(n))
    for step in range(ROUNDS):
        g = gram[live]
        normal = g[:, :plain, :plain] + variance[:, None, None] * np.diag(prior)
        solved = np.linalg.solve(normal, g[:, :plain, plain:])
        reduced = g[:, plain:, plain:] - g[:, plain:, :plain] @ solved
        inner, goal, before = reduced[:, :-1, :-1], reduced[:, :-1, -1], slopes
        diagonal = np.einsum("nii->ni", inner)
        usable = diagonal > 1e-12 * n[live][:, None]
        slopes = np.where(usable, slopes, 0.0)
        left = goal - np.einsum("nij,nj->ni", inner, slopes)
        threshold = variance / CHANGEPOINT_PRIOR
        for _ in range(SWEEPS if step else 0):
            for j in range(size - plain):
                wanted = left[:, j] + diagonal[:, j] * slopes[:, j]
                shrunk = np.sign(wanted) * np.maximum(np.abs(wanted) - threshold, 0.0)
                new = np.divide(shrunk, diagonal[:, j], out=np.zeros_like(shrunk), where=usable[:, j])
                left -= inner[:, :, j] * (new - slopes[:, j])[:, None]
                slopes[:, j] = new
        for _ in range(STEPS if step else 0):
            slopes = joint_step(inner, goal, slopes, threshold, n[live])
        coef = np.concatenate([solved[:, :, -1] - np.einsum("nij,nj->ni", solved[:, :, :-1], slopes), slopes], axis=1)
        sse = g[:, -1, -1] - 2 * np.einsum("ni,ni->n", coef, g[:, :-1, -1]) + np.einsum("ni,nij,nj->n", coef, g[:, :-1, :-1], coef)
        sse, old = np.maximum(sse, 0.0), variance
        # least of n log(s) + sse / 2s^2 + s^2 / (2 * prior^2)
        rate = NOISE_PRIOR**-2
        variance = np.maximum(LEAST_NOISE**2, 2 * sse / (n[live] + np.sqrt(n[live] ** 2 + 4 * rate * sse)))
        moved = np.abs(slopes - before).max(axis=1, initial=0.0)
        done = (moved <= DONE) & (np.abs(variance - old) <= DONE * variance) & (step > 0)
        result[live], noise[live] = coef, np.sqrt(variance)
        live, slopes, variance = live[~done], slopes[~done], variance[~done]
        if not len(live):
            break
    return result, noise


def fit_trend(
    train: DataFrame, entity: str, period: str, target: str, regressors: list[str], changepoints: int = CHANGEPOINTS
) -> DataFrame:
    """A trend model for each entity, in data units: slope and regressors in ``coef``, the
    changes of slope that are not zero in ``bends``, and what future changes look like.

    Rows with a null in the target or a regressor are left out; an entity without complete
    rows has no model. A constant regressor counts nothing. The intercept has no prior.
    """
    stats = segment_moments(trend_rows(train, entity, period, target, regressors, changepoints), entity, len(regressors))
    doubles = T.ArrayType(T.DoubleType())
    bend = T.StructType([T.StructField("at", T.DoubleType()), T.StructField("slope", T.DoubleType())])
    schema = T.StructType(
        [
            stats.schema[entity],
            T.StructField("t0", T.DoubleType()),
            T.StructField("t_span", T.DoubleType()),
            T.StructField("coef", doubles),
            T.StructField("intercept", T.DoubleType()),
            T.StructField("bends", T.ArrayType(bend)),
            T.StructField("bend_count", T.IntegerType()),
            T.StructField("bend_scale", T.DoubleType()),
            T.StructField("residual_std", T.DoubleType()),
            T.StructField("train_rows", T.LongType()),
        ]
    )
    plain = 1 + len(regressors)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            lengths = batch["segment"].map(len).to_numpy()
            segment, at = np.concatenate(batch["segment"]), np.concatenate(batch["at"])
            sums = np.concatenate(batch["sums"]).reshape(len(segment), -1)
            row = np.repeat(np.arange(len(batch)), lengths)
            n, mean, gram, knot = hinge_system(sums, at, segment, row, len(batch), int(batch["knots"].max()))
            coef, noise = most_probable(n, gram, plain)
            top, count = batch["top"].to_numpy(), batch["knots"].to_numpy()
            level = mean[:, -1] - np.einsum("ni,ni->n", coef, mean[:, :-1])
            spread = np.array(batch["spreads"].tolist(), float).reshape(len(batch), -1)
            centre = np.array(batch["means"].tolist(), float).reshape(len(batch), -1)
            own = np.divide(coef[:, 1:plain], spread, out=np.zeros_like(spread), where=spread > 0)
            level -= (own * centre).sum(axis=1)
            bends = [
                [{"at": s, "slope": d * u} for s, d in zip(times, slopes) if d]
                for times, slopes, u in zip(knot.tolist(), coef[:, plain:].tolist(), top.tolist())
            ]
            yield pd.DataFrame(
                {
                    entity: batch[entity],
                    "t0": batch["t0"],
                    "t_span": batch["t_span"],
                    "coef": list(np.concatenate([coef[:, :1], own], axis=1) * top[:, None]),
                    "intercept": level * top,
                    "bends": bends,
                    "bend_count": count,
                    "bend_scale": np.abs(coef[:, plain:]).sum(axis=1) / np.maximum(count, 1) * top,
                    "residual_std": noise * top,
                    "train_rows": np.rint(n).astype("int64"),
                }
            )

    return stats.mapInPandas(solve, schema).withColumns(
        {"model": F.lit(codes.TREND_MODEL), "features": F.array(*[F.lit(c) for c in regressors]).cast("array<string>")}
    )


# ---- Forecasts ---------------------------------------------------------------


def unit(draw: np.ndarray, event: np.ndarray, kind: int) -> np.ndarray:
    """Fixed numbers above 0 and below 1, from whole-number arithmetic alone."""
    x = (draw * DRAW_STEP + event * EVENT_STEP + kind * KIND_STEP + 1) % MODULUS
    for _ in range(3):
        x = (x * x + TURN * x + 11) % MODULUS
    return (x + 0.5) / MODULUS


class Futures:
    """Draws that all entities share: when slopes change, by how much, and noise.

    Changes come at rate one in units of the mean distance between changepoints, with
    Laplace sizes of scale one; an entity's own rate and scale stretch them.
    """

    def __init__(self, draws: int):
        self.draw = np.arange(draws, dtype=np.int64)
        none = np.zeros_like(self.draw)
        self.noise = np.sqrt(-2 * np.log(unit(self.draw, none, 1))) * np.cos(2 * np.pi * unit(self.draw, none, 2))
        self.when, self.size = np.zeros((0, draws)), np.zeros((0, draws))

    def reach(self, a: float) -> None:
        """Have every draw's events up to time ``a``."""
        while not len(self.when) or self.when[-1].min() < a:
            event = np.arange(len(self.when), len(self.when) + 64, dtype=np.int64)[:, None]
            gaps = -np.log(unit(self.draw, event, 3))
            size = -np.log(unit(self.draw, event, 4)) * np.where(unit(self.draw, event, 5) < 0.5, -1.0, 1.0)
            last = self.when[-1] if len(self.when) else 0.0
            self.when = np.concatenate([self.when, last + np.cumsum(gaps, axis=0)])
            self.size = np.concatenate([self.size, size])

    def offsets(self, ahead: np.ndarray, bend: np.ndarray, noise: np.ndarray) -> np.ndarray:
        """Quantiles of trend change and noise, ``ahead`` in mean distances, at INTERVAL."""
        out = np.zeros((2, len(ahead)))
        if not len(ahead):
            return out
        self.reach(float(ahead.max()))
        slope, shift = np.zeros((2, len(self.when) + 1, len(self.draw)))
        np.cumsum(self.size, axis=0, out=slope[1:])
        np.cumsum(self.size * self.when, axis=0, out=shift[1:])
        for a in range(0, len(ahead), 2048):
            part = ahead[a : a + 2048]
            past = np.stack([np.searchsorted(w, part) for w in self.when.T], axis=1)
            change = part[:, None] * slope[past, self.draw] - shift[past, self.draw]
            total = bend[a : a + 2048, None] * change + noise[a : a + 2048, None] * self.noise
            out[:, a : a + 2048] = np.quantile(total, INTERVAL, axis=1)
        return out


def future_offsets(draws: int):
    """A Pandas function of (mean distances ahead, change of slope for one, noise) → (lo, hi) around the trend."""

    @F.pandas_udf("lo double, hi double")
    def offsets(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        futures = Futures(draws)
        for ahead, bend, noise in parts:
            known = ahead.notna().to_numpy()
            out = np.full((2, len(ahead)), np.nan)
            out[:, known] = futures.offsets(ahead.to_numpy()[known], bend.to_numpy()[known], noise.to_numpy()[known])
            yield pd.DataFrame({"lo": out[0], "hi": out[1]})

    return offsets


#: Scaled time while rows are scored.
TIME = "_time"


def score_trend(
    df: DataFrame, coefs: DataFrame, entity: str, period: str, regressors: list[str], draws: int = DRAWS
) -> DataFrame:
    """Point forecast and 80% interval for rows with the same regressors.

    Within the training span the interval is the noise. Beyond it, slopes may change as
    often and as strongly as they did: quantiles over ``draws`` fixed futures. Who selects
    the forecast alone runs no Python.
    """
    model = ["t0", "t_span", "coef", "intercept", "bends", "bend_count", "bend_scale", "residual_std"]
    joined = df.join(coefs.select(entity, *[F.col(c).alias(f"_{c}") for c in model]), entity)
    margin = F.col("_residual_std") * INTERVAL_Z
    ahead = (F.col(TIME) - 1) * F.col("_bend_count")
    beyond = (ahead > 0) & (F.col("_bend_scale") > 0)
    drawn = future_offsets(draws)(
        F.when(beyond, ahead), F.col("_bend_scale") / F.greatest(F.col("_bend_count"), F.lit(1)), F.col("_residual_std")
    )
    bent = F.aggregate("_bends", F.lit(0.0), lambda s, b: s + b["slope"] * F.greatest(F.lit(0.0), F.col(TIME) - b["at"]))
    return (
        joined.withColumn(TIME, (F.col(period) - F.col("_t0")) / F.col("_t_span"))
        .withColumns({"yhat": linear_score([TIME, *regressors], "_coef", "_intercept") + bent, "_drawn": drawn})
        .withColumns(
            {
                "yhat_lo": F.col("yhat") + F.when(beyond, F.col("_drawn.lo")).otherwise(-margin),
                "yhat_hi": F.col("yhat") + F.when(beyond, F.col("_drawn.hi")).otherwise(margin),
            }
        )
        .drop(TIME, "_drawn", *[f"_{c}" for c in model])
    )
