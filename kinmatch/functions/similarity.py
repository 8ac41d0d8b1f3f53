"""Similarity of strings, dates and persons as built-in expressions.

Names follow the tables: a person has a name (nom), a first name (prenom), a
date and a commune of birth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The attributes that a person is matched on.
MATCH = ["spe_nom_normalized", "spe_prenom_normalized", "spe_dateNaissance", "spe_communeNaissance"]
#: The keys of a block: only persons of one block are compared.
BLOCK = ["blocking_year", "blocking_nom2", "blocking_pre2"]
_SIZE = lambda c: F.length(F.rtrim(c))


def levenshtein(a: Column, b: Column) -> Column:
    """Edit distance by code points; null counts as empty, trailing blanks don't count."""
    return F.levenshtein(F.coalesce(F.rtrim(a), F.lit("")), F.coalesce(F.rtrim(b), F.lit("")))


def _presence(a: Column, b: Column, both: Column) -> Column:
    return F.when(a.isNull() & b.isNull(), F.lit(1.0)).when(a.isNull() | b.isNull(), F.lit(0.0)).otherwise(both)


def similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; both null or both empty: 1, one null: 0."""
    longer = F.greatest(_SIZE(a), _SIZE(b))
    # equal strings are common within a block and need no edit distance
    return _presence(a, b, F.when((a == b) | (longer == 0), F.lit(1.0)).otherwise(F.lit(1.0) - levenshtein(a, b) / longer))


def similarity_bound(a: Column, b: Column) -> Column:
    """What similarity can't exceed, from the lengths alone: the distance is at least their difference."""
    longer = F.greatest(_SIZE(a), _SIZE(b))
    return _presence(a, b, F.when(longer == 0, F.lit(1.0)).otherwise(F.least(_SIZE(a), _SIZE(b)) / longer))


def date_similarity(a: Column, b: Column) -> Column:
    """1 for equal dates or two nulls, else 0."""
    return a.eqNullSafe(b).cast("double")


def scores(left: str, right: str) -> dict[str, Column]:
    """The four scores of a pair of rows, by the aliases of its sides."""
    col = lambda side, k: F.col(f"{side}.{MATCH[k]}")
    return {
        "score_nom": similarity(col(left, 0), col(right, 0)),
        "score_prenom": similarity(col(left, 1), col(right, 1)),
        "score_dob": date_similarity(col(left, 2), col(right, 2)),
        "score_commune": similarity(col(left, 3), col(right, 3)),
    }


def total(parts: dict[str, Column] | None = None) -> Column:
    """Unweighted mean of the four scores, added in this order; of columns where none are given."""
    p = parts or {c: F.col(c) for c in ("score_nom", "score_prenom", "score_dob", "score_commune")}
    return (p["score_nom"] + p["score_prenom"] + p["score_dob"] + p["score_commune"]) / F.lit(4.0)


def same_key(threshold: float) -> dict[str, Column]:
    """What must be equal for a total to reach the threshold: one score of 0 leaves 3/4 at most."""
    date = F.coalesce(F.col(MATCH[2]), F.lit("0001-01-01").cast("date"))
    return {"key_date": date, "key_none": F.col(MATCH[3]).isNull()} if threshold > 0.75 else {}


def sure_prefix(threshold: float) -> Column:
    """A prefix of the name: of two persons equal in it and in the other attributes the total reaches the threshold, whatever follows.

    A prefix of p of at most n code points leaves a distance of n - p at most,
    so the name scores p / n or more, and 4 threshold - 3 is enough.
    """
    least = 4 * threshold - 3 + 1e-9
    return F.substring(F.rtrim(MATCH[0]), F.lit(1), F.greatest(F.lit(0), F.ceil(_SIZE(F.col(MATCH[0])) * F.lit(least))).cast("int"))


def total_bound(left: str, right: str) -> Column:
    col = lambda side, k: F.col(f"{side}.{MATCH[k]}")
    return (
        similarity_bound(col(left, 0), col(right, 0)) + similarity_bound(col(left, 1), col(right, 1)) + date_similarity(col(left, 2), col(right, 2)) + similarity_bound(col(left, 3), col(right, 3))
    ) / F.lit(4.0)
