"""Keyed MAC pseudonyms."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.operators.lookup import Enricher

# Key derivation parameters and the default password prefix.
PREFIX = "fdah7usad782345@"
ITERATIONS = 10
OUTPUT_BYTES = 6


def _pseudonym(prefix: bytes):
    @F.pandas_udf("string")
    def derive(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            # one derivation per distinct salted address of the batch
            codes, values = pd.factorize(batch)
            made = []
            for text in values:
                salt, mac = text.split("|")
                key = hashlib.pbkdf2_hmac(
                    "sha256", prefix + bytes.fromhex(mac), bytes.fromhex(salt), ITERATIONS, OUTPUT_BYTES)
                made.append(key.hex(":"))
            made.append(None)  # code -1 marks NULL
            yield pd.Series([made[c] for c in codes], dtype=object)
    return derive


def scramble_macs(df: DataFrame, salts: DataFrame, prefix: str | None = None, mac: str = "client_mac",
                  provider: str = "service_provider_uuid") -> DataFrame:
    """Replace ``mac`` by its PBKDF2 pseudonym under the provider's salt.

    ``salts`` is ``(uuid, salt)`` with a hex salt. Rows without a salt, or whose address is not pairs of
    hex digits, keep their address. The derivation is a pure function of the row, done once per distinct
    address of each Arrow batch, so the fact table is not shuffled for it.
    """
    if mac not in df.columns or provider not in df.columns:
        return df
    dim = salts.select(F.col("uuid").alias("_uuid"), F.col("salt").alias("_salt"))
    joined = df.join(dim, F.col(provider) == F.col("_uuid"), "left")
    hex_mac = F.regexp_replace(F.col(mac), ":", "")
    usable = F.col("_salt").rlike("^([0-9a-fA-F]{2})+$") & hex_mac.rlike("^([0-9a-fA-F]{2})+$")
    salted = joined.withColumn("_salted", F.when(usable, F.concat("_salt", F.lit("|"), hex_mac)))
    derive = _pseudonym((prefix or PREFIX).encode())
    return salted.withColumn(mac, F.coalesce(derive(F.col("_salted")), F.col(mac))).drop("_uuid", "_salt", "_salted")


def mac_enricher(salts: DataFrame, prefix: str | None = None) -> Enricher:
    fn = lambda df: scramble_macs(df, salts, prefix)
    fn.edits_record = True
    return fn
