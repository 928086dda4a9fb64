"""Plain Python answers for small inputs."""

from __future__ import annotations

import datetime as dt
import itertools
import math


def history(rows):
    """History columns of each row, straight from their definitions."""
    ordered = sorted(rows, key=lambda r: (r["transaction_time"], r["transaction_id"]))
    out = {}
    for i, row in enumerate(ordered):
        earlier = [r for r in ordered[:i] if r["customer_id"] == row["customer_id"]]
        amounts = [r["amount"] for r in earlier if r["amount"] is not None]

        def within(hours, row=row):
            start = row["transaction_time"] - dt.timedelta(hours=hours)
            return float(
                sum(
                    r["customer_id"] == row["customer_id"]
                    and r["amount"] is not None
                    and start <= r["transaction_time"] < row["transaction_time"]
                    for r in ordered
                )
            )

        move = 0.0
        if earlier:
            last = earlier[-1]
            move = math.hypot(row["location_lat"] - last["location_lat"], row["location_lon"] - last["location_lon"])
        out[row["transaction_id"]] = {
            "running_avg": sum(amounts) / len(amounts) if amounts else None,
            "last_24h": within(24),
            "last_1h": within(1),
            "new_device": int(row["device"] is not None and all(r["device"] != row["device"] for r in earlier)),
            "location_change": move,
        }
    return out


def auc(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg))
    return won / (len(pos) * len(neg))


def average_precision(pairs):
    total = sum(y for y, _ in pairs)
    area = 0.0
    for threshold in sorted({s for _, s in pairs}, reverse=True):
        at = sum(y for y, s in pairs if s == threshold)
        above = [y for y, s in pairs if s >= threshold]
        area += at / total * sum(above) / len(above)
    return area


def tree_value(tree, node, x, known):
    """Expected output when only the ``known`` features are seen; others follow the training weights."""
    n = tree[node]
    if n["left"] < 0:
        return n["prediction"]
    if n["feature"] in known:
        return tree_value(tree, n["left"] if x[n["feature"]] <= n["threshold"] else n["right"], x, known)
    return sum(
        tree[c]["cover"] / n["cover"] * tree_value(tree, c, x, known) for c in (n["left"], n["right"])
    )


def shapley(tree, x, features):
    values = []
    for j in range(features):
        others = [f for f in range(features) if f != j]
        total = 0.0
        for size in range(len(others) + 1):
            for chosen in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                total += weight * (
                    tree_value(tree, 0, x, {*chosen, j}) - tree_value(tree, 0, x, set(chosen))
                )
        values.append(total)
    return values
