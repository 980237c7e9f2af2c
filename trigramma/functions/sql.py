"""The model's formulas for SQL users, as functions Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trigramma.functions import formulas
from trigramma.functions.formulas import Sql, call


def _case(*branches: tuple[Sql, Sql]) -> Sql:
    return Sql("CASE " + " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches) + " END")


def definitions() -> dict[str, tuple[list[str], str]]:
    """Name to arguments, all of them doubles, and body."""
    counts = ["n1", "n2", "n3", "c0", "c1", "c2"]
    number = lambda text: Sql(f"double('{text}')")
    divide = formulas.ieee_divide(Sql("a"), Sql("b"), _case, call("try_divide"), call("isnan"), number)
    mixed = formulas.interpolate(*map(Sql, counts), call("confidence"), call("ieee_divide"))
    return {
        "confidence": (["n"], str(formulas.confidence(Sql("n"), call("ln")))),
        "ieee_divide": (["a", "b"], str(divide)),
        "interpolate": (counts, str(mixed)),
    }


def register_functions(spark: SparkSession) -> None:
    """Create ``confidence``, ``ieee_divide`` and ``interpolate`` in the session."""
    for name, (args, body) in definitions().items():
        typed = ", ".join(f"{arg} DOUBLE" for arg in args)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({typed}) RETURNS DOUBLE RETURN {body}")
