"""Linked accounts: service map -> own poster ids, and the own-post test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.sources.schemas import SERVICE_SOURCE


def _service_source_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in SERVICE_SOURCE.items() for x in kv])


def linked_account_ids(linked_accounts) -> Column:
    """map<service, array<struct<account_id,...>>> -> array of 'FB-<account_id>' poster ids.

    Unknown services are skipped; facebook and facebookpages both give 'FB'; null -> empty."""
    m = F.col(linked_accounts) if isinstance(linked_accounts, str) else linked_accounts
    per_service = F.transform(
        F.map_entries(m),
        lambda e: F.transform(
            e["value"],
            lambda a: F.concat(_service_source_map()[e["key"]], F.lit("-"), a["account_id"])),
    )
    # null map or null list -> no ids; unknown service -> null id, filtered below
    ids = F.coalesce(F.flatten(F.filter(per_service, lambda l: l.isNotNull())), F.array().cast("array<string>"))
    return F.filter(ids, lambda x: x.isNotNull())


def linked_accounts_by_source(linked_accounts) -> Column:
    """map<source, array<poster id>> with the five sources always present (empty lists)."""
    from venue_analytics.sources.schemas import SOURCES
    ids = linked_account_ids(linked_accounts)
    return F.map_from_arrays(
        F.array(*[F.lit(s) for s in SOURCES]),
        F.array(*[F.filter(ids, _has_source(s)) for s in SOURCES]))


def _has_source(source: str):
    # a one-argument lambda: Spark reads a second argument as the element index
    return lambda x: F.substring(x, 1, 2) == F.lit(source)


def is_own_post(own_ids, poster_id) -> Column:
    """True when the poster id is one of the merchant's own ids; null poster/ids -> False."""
    own = F.col(own_ids) if isinstance(own_ids, str) else own_ids
    pid = F.col(poster_id) if isinstance(poster_id, str) else poster_id
    return F.coalesce(F.array_contains(own, pid), F.lit(False))


def merchant_accounts(merchants: DataFrame) -> DataFrame:
    """Flat own-account relation (merchant_id, poster_id) from merchants.linked_accounts.

    One row per linked account; the reports anti-join on it, so a merchant with many accounts
    never turns into a long array scanned per post."""
    if "linked_accounts" not in merchants.columns:
        return merchants.sparkSession.createDataFrame([], "merchant_id string, poster_id string")
    # no distinct: a repeated account cannot change an anti-join, and it would cost a shuffle
    return merchants.select(F.col("id").alias("merchant_id"),
                            F.explode(linked_account_ids("linked_accounts")).alias("poster_id"))
