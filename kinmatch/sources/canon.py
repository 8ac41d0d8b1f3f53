"""The shapes that all steps read: adapters map any input to them.

Strings are compared exactly after trailing blanks are cut, once, here;
``fold_case`` makes comparison case-insensitive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The tables' columns.
PERSON_DECL = "id_ligne_declaration spe_nom spe_nom_normalized spe_prenom spe_prenom_normalized spe_dateNaissance spe_communeNaissance created_at valid_to".split()
COMPANY_DECL = "id_ligne_declaration pseudo_siret created_at valid_to".split()
PERSON_FORMAT = "spe_masterid spe_nom_normalized spe_prenom_normalized spe_dateNaissance spe_communeNaissance rnvp_ok created_at valid_to".split()
COMPANY_FORMAT = "pe_masterid pseudo_siret rnvp_ok created_at valid_to".split()
MAPPING = "id_ligne_declaration spe_masterid pe_masterid spe_match_status pe_match_status created_at valid_to".split()


def blocking() -> dict[str, Column]:
    """Year of birth and two letters of each name; null in, null out."""
    return {
        "blocking_year": F.year("spe_dateNaissance"),
        "blocking_nom2": F.substring("spe_nom_normalized", 1, 2),
        "blocking_pre2": F.substring("spe_prenom_normalized", 1, 2),
    }


def with_blocking(df: DataFrame) -> DataFrame:
    return df.withColumns(blocking())


def _clean(df: DataFrame, columns: list[str], fold_case: bool) -> DataFrame:
    fold = (lambda c: F.upper(F.rtrim(c))) if fold_case else F.rtrim
    compared = {"spe_nom_normalized", "spe_prenom_normalized", "spe_communeNaissance", "pseudo_siret"}
    return df.select(*[(fold(F.col(c)).alias(c) if c in compared else F.col(c)) for c in columns])


def person_declarations(df: DataFrame, fold_case: bool = False) -> DataFrame:
    return _clean(df, PERSON_DECL, fold_case)


def company_declarations(df: DataFrame, fold_case: bool = False) -> DataFrame:
    return _clean(df, COMPANY_DECL, fold_case)


def person_formats(df: DataFrame, fold_case: bool = False) -> DataFrame:
    return with_blocking(_clean(df, PERSON_FORMAT, fold_case))


def company_formats(df: DataFrame, fold_case: bool = False) -> DataFrame:
    return _clean(df, COMPANY_FORMAT, fold_case)


def mappings(df: DataFrame) -> DataFrame:
    return df.select(*MAPPING)
