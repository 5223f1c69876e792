"""One dimension joined in several roles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Dimension rows up to which it is broadcast (about 32 MB of ids and names).
BROADCAST_ROWS = 500_000


def join_roles(fact: DataFrame, dim: DataFrame, key: str, roles: dict[str, str], attrs: list[str],
               broadcast_rows: int = BROADCAST_ROWS, asked: DataFrame | None = None) -> DataFrame:
    """``fact`` with ``<role>_<attr>`` for every role; ``roles`` names the fact
    column that holds each role's key, ``dim`` has one row per ``key``. A key
    that is null or unknown gives nulls.

    A dimension of a checked size is broadcast once and used by every role. Of
    a larger one a role may ask for few rows: those that its keys find are
    broadcast if their number is within the bound. The other roles exchange the
    dimension once: what is looked up depends on a row's role keys only, so the
    distinct tuples of them (combined before the shuffle) are unpivoted to
    (tuple, role, key), joined to the dimension, pivoted back and joined to the
    fact, which is shuffled once instead of once a role. ``asked``: rows with
    the key columns of every row of ``fact`` (``fact`` itself by default), for
    callers that have the keys in a cheaper place.
    """
    out = {f"{role}_{a}": (role, a) for role in roles for a in attrs}
    if dim.select(key).limit(broadcast_rows + 1).count() <= broadcast_rows:
        # the same projection for every role, so that one broadcast serves all
        side = F.broadcast(dim.select(key, *attrs))
        joined = fact.alias("_fact")
        for role, column in roles.items():
            joined = joined.join(side.alias(f"_{role}"), F.col(f"_fact.{column}") == F.col(f"_{role}.{key}"), "left")
        return joined.select("_fact.*", *[F.col(f"_{role}.{a}").alias(name) for name, (role, a) in out.items()])

    asked = fact if asked is None else asked
    columns, names = fact.columns, list(out)
    few = {}
    for column in dict.fromkeys(roles.values()):
        found = dim.select(key, *attrs).join(asked.select(F.col(column).alias(key)).distinct(), key, "left_semi")
        if found.limit(broadcast_rows + 1).count() <= broadcast_rows:
            # one row a key, as from the exchange below
            few[column] = found.groupBy(key).agg(F.max(F.struct(*attrs)).alias("_found")).select(key, "_found.*")
    for role, column in roles.items():
        if column in few:
            side = F.broadcast(few[column].select(F.col(key).alias(f"_key_{role}"), *[F.col(a).alias(f"{role}_{a}") for a in attrs]))
            fact = fact.join(side, F.col(column) == F.col(f"_key_{role}"), "left").drop(f"_key_{role}")
    roles = {role: column for role, column in roles.items() if column not in few}
    if not roles:
        return fact.select(*columns, *names)

    keys = {role: f"_key_{role}" for role in roles}
    tuples = asked.select(*[F.col(c).alias(keys[r]) for r, c in roles.items()]).distinct()
    entry = F.explode(F.array(*[F.struct(F.lit(r).alias("_role"), F.col(k).alias("_key")) for r, k in keys.items()]))
    asked = tuples.select(*keys.values(), entry.alias("_e")).select(*keys.values(), "_e._role", "_e._key").filter("_key is not null")
    found = asked.join(dim.select(F.col(key).alias("_key"), F.struct(*attrs).alias("_found")), "_key")
    pivoted = found.groupBy(*keys.values()).agg(*[
        F.max(F.when(F.col("_role") == r, F.col("_found"))).alias(f"_found_{r}") for r in roles])
    match = reduce(lambda a, b: a & b, [fact[c].eqNullSafe(pivoted[keys[r]]) for r, c in roles.items()])
    return fact.join(pivoted, match, "left").select(
        *fact.columns, *[F.col(f"_found_{role}")[a].alias(name) for name, (role, a) in out.items() if role in roles]
    ).select(*columns, *names)
