"""Dimension look-ups made unique per key.

The reference "dedups" look-ups with DISTINCT, which still leaves several rows
per key (one per business unit) and multiplies every summed measure. Here a
look-up holds exactly one row per key: the first by the ``order`` columns,
ascending, NULLs last. The choice is a hash aggregate (partial + final), so it
never gathers a key's rows in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_lookup(dim: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str] | None = None) -> DataFrame:
    payload = list(order if payload is None else payload)
    fields = []
    for i, c in enumerate(order):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    fields += [F.col(c).alias(f"_p{j}") for j, c in enumerate(payload)]
    best = F.min(F.struct(*fields)).alias("_best")
    return dim.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_best._p{j}").alias(c) for j, c in enumerate(payload)]
    )


def account_lookup(ec2: DataFrame) -> DataFrame:
    """account_id -> account_name (one row per account)."""
    return unique_lookup(ec2, ["account_id"], ["account_name"])


def instance_lookup(ec2: DataFrame) -> DataFrame:
    """(account_id, region, instance_id) -> account_name, biz_unit, application_id."""
    return unique_lookup(
        ec2, ["account_id", "region", "instance_id"], ["account_name", "biz_unit", "application_id"]
    )


def biz_fallback(ec2: DataFrame, by: Sequence[str] = ("account_id", "region")) -> DataFrame:
    """Account-level fallback labels when the instance is not in the inventory."""
    return unique_lookup(ec2, list(by), ["account_name", "biz_unit"])


def with_account(df: DataFrame, ec2: DataFrame, name: str = "account_name", default: str | None = "UNKNOWN") -> DataFrame:
    """Attach COALESCE(account_name, default) by account_id (left join)."""
    acct = account_lookup(ec2).withColumnRenamed("account_name", "_acct_name")
    out = df.join(acct, "account_id", "left")
    label = F.col("_acct_name") if default is None else F.coalesce("_acct_name", F.lit(default))
    return out.withColumn(name, label).drop("_acct_name")


def with_owner_labels(df: DataFrame, ec2: DataFrame, fallback_by: Sequence[str] = ("account_id", "region"), default: str = "UNKNOWN") -> DataFrame:
    """account_name / biz_unit / application_id from the instance, else the
    account (+region) fallback, else ``default``."""
    inst = instance_lookup(ec2).select(
        "account_id", "region", "instance_id",
        F.col("account_name").alias("_i_name"), F.col("biz_unit").alias("_i_biz"),
        F.col("application_id").alias("_i_app"),
    )
    fb = biz_fallback(ec2, fallback_by).select(
        *fallback_by, F.col("account_name").alias("_f_name"), F.col("biz_unit").alias("_f_biz")
    )
    out = df.join(inst, ["account_id", "region", "instance_id"], "left").join(fb, list(fallback_by), "left")
    return out.withColumns({
        "account_name": F.coalesce("_i_name", "_f_name", F.lit(default)),
        "biz_unit": F.coalesce("_i_biz", "_f_biz", F.lit(default)),
        "application_id": F.coalesce("_i_app", F.lit(default)),
    }).drop("_i_name", "_i_biz", "_i_app", "_f_name", "_f_biz")
