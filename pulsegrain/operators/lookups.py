"""Country and language lookups; Spark broadcasts the tables where their size allows it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrain.functions.text import first_tag_part, last_tag_part

def checked_codes(df: DataFrame, name: str) -> DataFrame:
    """The table, after a check that ``alpha_2`` and the exported names are unique.

    NULL codes and empty names match nothing, so they may repeat.
    """
    keys = {"alpha_2": "alpha_2"}
    if "firebase_name" in df.columns:
        keys["firebase_name"] = "nullif(lower(firebase_name), '')"
    for column, key in keys.items():
        repeated = (df.selectExpr(f"{key} AS key").where("key IS NOT NULL").groupBy("key").count()
                    .where("count > 1"))
        if not repeated.isEmpty():
            raise ValueError(f"{name}: {column} is not unique")
    return df


@dataclass(frozen=True)
class Lookups:
    """``country(firebase_name, name, alpha_2, ...)``, ``language(name, alpha_2, ...)``."""

    country: DataFrame
    language: DataFrame

    @classmethod
    def checked(cls, country: DataFrame, language: DataFrame) -> Lookups:
        return cls(checked_codes(country, "country"), checked_codes(language, "language"))

    def sent_to_rows(self) -> Lookups:
        """The tables for joins that must leave rows where they are, whatever Spark makes of the sizes."""
        return Lookups(F.broadcast(self.country), F.broadcast(self.language))


def with_country(df: DataFrame, lookups: Lookups, country: str) -> DataFrame:
    """Add ``iso_country_name`` and ``iso_country_alpha_2`` by country name."""
    # Countries without an exported name match nothing, not even an empty name.
    seed = lookups.country.where("firebase_name != ''").selectExpr(
        "lower(firebase_name) AS __country_key", "name AS iso_country_name",
        "alpha_2 AS iso_country_alpha_2")
    return (df.join(seed, F.expr(f"lower({country}) = __country_key"), "left")
            .drop("__country_key"))


def with_language(df: DataFrame, lookups: Lookups, tag: str) -> DataFrame:
    """Add ``iso_language_alpha_2`` and ``iso_language_country_alpha_2`` by tag.

    The country is the *last* part, so that three-part tags work. A one-part
    tag is therefore also read as a country.
    """
    language = lookups.language.selectExpr("alpha_2 AS iso_language_alpha_2")
    region = lookups.country.selectExpr("alpha_2 AS iso_language_country_alpha_2")
    spoken = F.expr(f"lower({first_tag_part(tag)}) = iso_language_alpha_2")
    place = F.expr(f"lower({last_tag_part(tag)}) = iso_language_country_alpha_2")
    return (df.join(language, spoken, "left")
            .join(region, place, "left"))
