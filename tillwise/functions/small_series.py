"""Numeric helpers for one daily series, run inside pandas tasks. No Spark in here."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd


def arima_rows(name, last_day, y: np.ndarray, periods: int, drift: bool = False) -> pd.DataFrame:
    """ARIMA(p, 1, q) forecast of one series; ``drift`` adds the mean step at every step."""
    steps = np.arange(1, periods + 1)
    best = None
    d = np.diff(y)
    if len(d) >= 30 and d.std() > 0:
        mean = d.mean() if drift else 0.0
        x = d - mean
        e = _long_ar_residuals(x)
        for p in (1, 2):
            for q in (1, 2):
                got = _arma(x, e, p, q)
                if got is not None and (best is None or got[0] < best[0]):
                    best = (*got, p, q, mean, x, e)
    if best is None:
        level = y[-7:].mean()
        model, aic, mid, half = "naive", None, np.full(periods, level), None
    else:
        aic, phi, theta, var, p, q, mean, x, e = best
        xs, es = list(x), list(e)
        for _ in range(periods):
            nxt = sum(phi[i] * xs[-1 - i] for i in range(p)) + sum(theta[j] * es[-1 - j] for j in range(q))
            xs.append(nxt)
            es.append(0.0)
        mid = y[-1] + np.cumsum(np.array(xs[-periods:]) + mean)
        psi = [1.0]
        for k in range(1, periods):
            psi.append(sum(phi[i] * psi[k - 1 - i] for i in range(p) if k - 1 - i >= 0) + (theta[k - 1] if k <= q else 0.0))
        half = 1.959964 * np.sqrt(var * np.cumsum(np.cumsum(psi) ** 2))
        model = f"ARIMA({p}, 1, {q})"
    days = [last_day + pd.Timedelta(days=int(s)) for s in steps] if not hasattr(last_day, "toordinal") else [
        last_day.fromordinal(last_day.toordinal() + int(s)) for s in steps]
    return pd.DataFrame({"series": name, "model": model, "aic": aic, "step": steps.astype("int32"), "day": days, "forecast": mid,
                         "lower_bound": mid - half if half is not None else None,
                         "upper_bound": mid + half if half is not None else None})


def _long_ar_residuals(x: np.ndarray) -> np.ndarray:
    k = min(10, len(x) // 5)
    design = np.column_stack([x[k - i - 1:len(x) - i - 1] for i in range(k)])
    beta, *_ = np.linalg.lstsq(design, x[k:], rcond=None)
    return np.concatenate([np.zeros(k), x[k:] - design @ beta])


def _arma(x, e, p, q):
    k = 12
    n = len(x) - k
    design = np.column_stack([x[k - i - 1:len(x) - i - 1] for i in range(p)] + [e[k - j - 1:len(e) - j - 1] for j in range(q)])
    beta, *_ = np.linalg.lstsq(design, x[k:], rcond=None)
    phi, theta = beta[:p], beta[p:]
    if np.any(np.abs(np.roots(np.concatenate([[1.0], -phi]))) >= 1.0):
        return None
    var = float(np.mean((x[k:] - design @ beta) ** 2))
    if not np.isfinite(var) or var <= 0:
        return None
    return n * (math.log(2 * math.pi * var) + 1) + 2 * (p + q + 1), phi, theta, var


# fixed values: MacKinnon's published surface for the constant-only Dickey-Fuller statistic
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
TAU_SMALL = (2.1659, 1.4412, 0.038269)
TAU_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_p_value(stat: float) -> float:
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    coefficients = TAU_SMALL if stat <= TAU_STAR else TAU_LARGE
    z = sum(c * stat ** i for i, c in enumerate(coefficients))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _fit(design: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    beta, *_ = np.linalg.lstsq(design, target, rcond=None)
    return beta, max(float(np.sum((target - design @ beta) ** 2)), 1e-300)


def adf_row(name, y: np.ndarray) -> pd.DataFrame:
    """Dickey-Fuller t value: the lag minimises AIC on a common sample, then the fit uses all rows it can."""
    sd = y.std()
    y = (y - y.mean()) / (sd if sd > 0 else 1.0)
    d = np.diff(y)
    longest = max(0, min(int(math.ceil(12 * (len(y) / 100) ** 0.25)), len(y) // 2 - 2))

    def design(lags, start):
        rows = np.arange(start, len(d))
        columns = [np.ones(len(rows)), y[rows]] + [d[rows - i] for i in range(1, lags + 1)]
        return np.column_stack(columns), d[rows]

    x, target = design(longest, longest)
    n = len(target)
    best = min(range(longest + 1), key=lambda k: n * math.log(_fit(x[:, :2 + k], target)[1] / n) + 2 * (2 + k))
    x, target = design(best, best)
    beta, ssr = _fit(x, target)
    error = math.sqrt(ssr / (len(target) - x.shape[1]) * np.linalg.pinv(x.T @ x)[1, 1])
    stat = float(beta[1] / error) if error else 0.0
    p = adf_p_value(stat)
    return pd.DataFrame({"series": [name], "lags": [best], "n": [len(target)], "adf_statistic": [round(stat, 4)],
                         "adf_pvalue": [round(p, 4)], "adf_stationary": [p < 0.05]})
