"""Mixtures: what their shares allow, and whether their plans are sound."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How far shares may miss 1 in sum, and keys that a plan must not hold.
TOLERANCE = 1e-6
FORBIDDEN_KEYS = ("oversampling", "weights", "epochs", "learning_rate", "batch_size")


def capacity(components: DataFrame) -> DataFrame:
    """``components(component, available, share_bp)`` with ``capacity``, ``limits`` and ``repeats_bp``.

    A component allows a mixture of available / share words; the mixture's
    capacity is the least of these. ``repeats_bp`` is how often, in basis
    points, a component must be seen for a mixture as large as the largest
    component allows. Whole numbers throughout; shares of 0 limit nothing.
    """
    rows = components.select("component", F.coalesce("available", F.lit(0)).cast("decimal(28,0)").alias("available"), F.coalesce("share_bp", F.lit(0)).cast("long").alias("share_bp"))
    rows = rows.withColumn("allows", F.expr("cast(available * 10000 div nullif(share_bp, 0) as bigint)"))
    whole = rows.agg(F.min("allows").alias("capacity"), F.max("allows").alias("__most"))
    rows = rows.crossJoin(F.broadcast(whole))  # one row
    needed = F.expr("cast(cast(__most as decimal(28,0)) * share_bp div nullif(available, 0) as bigint)")
    return rows.select(
        "component", F.col("available").cast("long").alias("available"), "share_bp", "allows", "capacity", (F.col("allows") == F.col("capacity")).alias("limits"), needed.alias("repeats_bp")
    )


def plan_errors(plan: Mapping) -> list[str]:
    """What is wrong with one mixture plan; an empty list if nothing is."""
    errors = []

    def look(node: object, path: str) -> None:
        if isinstance(node, Mapping):
            for k, v in node.items():
                if str(k) in FORBIDDEN_KEYS:
                    errors.append(f"{path}{k}: key is not allowed")
                look(v, f"{path}{k}.")
        elif isinstance(node, list | tuple):
            for i, v in enumerate(node):
                look(v, f"{path}{i}.")

    look(plan, "")
    sources = plan.get("sources")
    if not isinstance(sources, Mapping) or not sources:
        return [*errors, "sources: missing"]

    def share(node: object) -> float | None:
        value = node.get("share") if isinstance(node, Mapping) else None
        return float(value) if isinstance(value, int | float) and not isinstance(value, bool) else None

    shares = {n: share(s) for n, s in sources.items()}
    for n, s in shares.items():
        if s is None or not 0 <= s <= 1:
            errors.append(f"sources.{n}.share: must be a number from 0 to 1")
    if all(s is not None for s in shares.values()) and abs(sum(shares.values()) - 1) > TOLERANCE:
        errors.append("sources: shares do not sum up to 1")
    for n, s in sources.items():
        if not isinstance(s, Mapping):
            continue
        if not any(s.get(k) for k in ("commit_sha", "revision", "snapshot_date")):
            errors.append(f"sources.{n}: no commit_sha, revision or snapshot_date")
        parts = s.get("subsets")
        if isinstance(parts, Mapping) and parts:
            inside = [share(x) if isinstance(x, Mapping) else float(x) for x in parts.values()]
            if None in inside or abs(sum(inside) - 1) > TOLERANCE:
                errors.append(f"sources.{n}.subsets: shares do not sum up to 1")
    return errors


def consistency_errors(plans: Mapping[str, Mapping], same: tuple[str, ...] = ("schema_version", "mixture_unit")) -> list[str]:
    """Where several plans disagree in what they must share: the named fields, their sources, and the sources' revisions."""
    errors, names = [], sorted(plans)
    for name in names[1:]:
        first, other = plans[names[0]], plans[name]
        errors += [f"{name}.{k}: differs from {names[0]}" for k in same if first.get(k) != other.get(k)]
        a, b = first.get("sources") or {}, other.get("sources") or {}
        if set(a) != set(b):
            errors.append(f"{name}.sources: other sources than {names[0]}")
        for s in sorted(set(a) & set(b)):
            for k in ("commit_sha", "revision", "snapshot_date"):
                if a[s].get(k) != b[s].get(k):
                    errors.append(f"{name}.sources.{s}.{k}: differs from {names[0]}")
    return errors
