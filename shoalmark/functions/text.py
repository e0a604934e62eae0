"""Species names as keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised_name(name: Column) -> Column:
    """Lower case, without white space (any Unicode white space) at either end."""
    return F.lower(F.regexp_replace(name, r"(?U)^\s+|\s+$", ""))


def species_key(name: Column) -> Column:
    """Name safe in a path: letters, numerals, underscores, blanks as underscores.

    Different names can share a key; ``operators.species.key_collisions`` finds them.
    """
    return F.translate(F.regexp_replace(name, r"[^\p{L}\p{N} _]", ""), " ", "_")
