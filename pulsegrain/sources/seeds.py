"""Code tables from CSV files. Their content is a parameter of the project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrain.operators.lookups import Lookups

# Header of the files. The language file's fourth column is misspelled in
# files in circulation, so columns are taken by position.
COUNTRY = "firebase_name string, name string, alpha_2 string, alpha_3 string, numeric int"
LANGUAGE = ("name string, alpha_2 string, alpha_3 string, alpha_3_en string, "
            "alpha_3_variety string")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (spark.read.schema(schema)
            .option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
            .csv(path))


def read_lookups(spark: SparkSession, country_path: str, language_path: str) -> Lookups:
    """Both code tables, checked to be small and unique."""
    return Lookups.checked(read_seed(spark, country_path, COUNTRY),
                           read_seed(spark, language_path, LANGUAGE))
