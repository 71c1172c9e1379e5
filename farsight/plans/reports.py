"""Reports in the shape of the reference programs' printed output.

``points_report``: number of points, MR-FFT round times, radius, sure
outliers, uncertain points and the outlier step's time, for points read
from a header-less CSV (or any point frame).

``items_report``: over the items consumed up to the batch holding item n,
the true frequent items, the ceil(1/phi)-reservoir sample, the size of the
sticky-sampling table and the epsilon-approximate frequent items marked
'+'/'-' against the truth.

Only parameter-bounded results reach the driver: K centers, at most 1/phi
frequent items, m sample rows and the sticky table (expected ~r rows).

    python -m farsight.plans.reports points <csv> M K L
    python -m farsight.plans.reports items <text-file> n phi epsilon delta [batch_size]
    python -m farsight.plans.reports stream <dir-of-line-files> n phi epsilon delta
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farsight.functions.params import check_items_params, reservoir_size
from farsight.operators import items as itemops, kcenter, outliers, sampling
from farsight.session import materialize


def _ms(t0: float) -> int:
    return int((time.perf_counter() - t0) * 1000)


def points_report(points: DataFrame, M: int, K: int, L: int | None) -> dict:
    pts = points.select("id", "x", "y")
    out = {"M": int(M), "K": int(K), "L": L, "points": pts.count()}
    t0 = time.perf_counter()
    core = materialize(kcenter.mr_fft_coreset(pts, K, L))
    out["round1_ms"] = _ms(t0)
    t0 = time.perf_counter()
    rows = kcenter.collect_centers(kcenter.mr_fft_centers_from_coreset(core, K, L))
    out["round2_ms"] = _ms(t0)
    t0 = time.perf_counter()
    D, = kcenter.kcenter_radii(pts, [rows])
    out["round3_ms"] = _ms(t0)
    out["radius"] = D
    t0 = time.perf_counter()
    s = outliers.approx_outliers(pts, D, M).collect()[0]
    out["outliers_ms"] = _ms(t0)
    out["sure_outliers"] = s["sure_outliers"]
    out["uncertain_points"] = s["uncertain_points"]
    return out


def format_points_report(r: dict, source: str = "") -> str:
    return "\n".join([
        f"{source} M={r['M']} K={r['K']} L={r['L']}",
        f"Number of points = {r['points']}",
        f"Running time of MRFFT Round 1 = {r['round1_ms']} ms",
        f"Running time of MRFFT Round 2 = {r['round2_ms']} ms",
        f"Running time of MRFFT Round 3 = {r['round3_ms']} ms",
        f"Radius = {round(r['radius'], 8)}",
        f"Number of sure outliers = {r['sure_outliers']}",
        f"Number of uncertain points = {r['uncertain_points']}",
        f"Running time of MRApproxOutliers = {r['outliers_ms']} ms",
    ])


def items_report(items: DataFrame, n: int, phi: float, epsilon: float, delta: float,
                 batch_size: int | None = None) -> dict:
    """``items``: ``pos, item`` (optionally ``batch``)."""
    check_items_params(phi, epsilon, delta)
    consumed = itemops.stream_cutoff(items, n, batch_size).select("pos", "item")
    consumed = materialize(consumed)
    truth = sorted(r["item"] for r in itemops.frequent_exact(consumed, phi, n).collect())
    m = reservoir_size(phi)
    sample = sorted(r["item"] for r in sampling.reservoir_first_n(consumed, m, n).collect())
    S = sampling.sticky_table(consumed, phi, epsilon, delta, n)
    est = sorted(r["item"] for r in S.where(F.col("est") >= F.lit((phi - epsilon) * n)).collect())
    return {
        "n": int(n), "phi": phi, "epsilon": epsilon, "delta": delta,
        "consumed": consumed.count(),
        "true_frequent": truth,
        "reservoir": sample,
        "sticky_table_size": S.count(),
        "approx_frequent": [(i, "+" if i in set(truth) else "-") for i in est],
    }


def stream_items_report(spark, stream: DataFrame, n: int, phi: float, epsilon: float,
                        delta: float, processing_time: str | None = None) -> dict:
    """The items report from Structured Streaming queries over ``stream`` (a
    line stream such as ``item_text_stream``, or items with positions and
    batches): the consumption stops after the batch holding item n, as in the
    reference.  ``processing_time`` takes lines in live, at that interval."""
    from farsight.streaming import ItemStream, arrivals
    check_items_params(phi, epsilon, delta)
    if "value" in stream.columns:
        stream = arrivals(stream, n, processing_time=processing_time)
    run = ItemStream(stream).until(n)
    truth = sorted(r["item"] for r in run.frequent_exact(phi, n).collect())
    est = sorted(r["item"] for r in run.frequent_sticky(phi, epsilon, delta, n).collect())
    return {
        "n": int(n), "phi": phi, "epsilon": epsilon, "delta": delta,
        "consumed": run.length().first()["n_items"],
        "true_frequent": truth,
        "reservoir": sorted(r["item"] for r in run.reservoir(reservoir_size(phi), n=n).collect()),
        "sticky_table_size": run.sticky(phi, epsilon, delta, n).count(),
        "approx_frequent": [(i, "+" if i in set(truth) else "-") for i in est],
    }


def format_items_report(r: dict) -> str:
    lines = [f"n = {r['n']} phi = {r['phi']} epsilon = {r['epsilon']} delta = {r['delta']}",
             f"Number of items processed = {r['consumed']}",
             f"Number of true frequent items = {len(r['true_frequent'])}",
             "True frequent items:", *[str(i) for i in r["true_frequent"]],
             "Reservoir sample:", *[str(i) for i in r["reservoir"]],
             f"Number of items in the Hash Table = {r['sticky_table_size']}",
             f"Number of estimated frequent items = {len(r['approx_frequent'])}",
             *[f"{i} {mark}" for i, mark in r["approx_frequent"]]]
    return "\n".join(lines)


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in ("points", "items", "stream"):
        raise SystemExit(__doc__)
    from farsight.session import local_session
    from farsight.sources import read_items_text, read_points_text
    spark = local_session()
    if argv[0] == "points":
        path, M, K, L = argv[1], int(argv[2]), int(argv[3]), int(argv[4])
        print(format_points_report(points_report(read_points_text(spark, path), M, K, L), path))
    elif argv[0] == "stream":
        from farsight.streaming import item_text_stream
        path, n, phi, eps, delta = argv[1], int(argv[2]), float(argv[3]), float(argv[4]), float(argv[5])
        r = stream_items_report(spark, item_text_stream(spark, path), n, phi, eps, delta)
        print(format_items_report(r))
    elif argv[0] == "items":
        path, n, phi, eps, delta = argv[1], int(argv[2]), float(argv[3]), float(argv[4]), float(argv[5])
        bs = int(argv[6]) if len(argv) > 6 else 360
        print(format_items_report(items_report(read_items_text(spark, path), n, phi, eps, delta, bs)))
    else:
        raise SystemExit(__doc__)


if __name__ == "__main__":
    main(sys.argv[1:])
