"""The model's formulas, written once for columns and for SQL text.

Each takes operands that add, subtract, multiply and divide, and the few functions that are not
operators. ``Sql`` is such an operand made of text.
"""

from __future__ import annotations

from collections.abc import Callable


def confidence(n, ln: Callable):
    """Weight in [0.5, 1) that grows with the logarithm of a count."""
    return (ln(n + 1) + 1) / (ln(n + 1) + 2)


def interpolate(n1, n2, n3, c0, c1, c2, weight: Callable, divide: Callable):
    """P(w3 | w1, w2): trigram, bigram and unigram ratios, weighted."""
    k2, k3 = weight(n2), weight(n3)
    return k3 * divide(n3, c2) + (1 - k3) * k2 * divide(n2, c1) + (1 - k3) * (1 - k2) * divide(n1, c0)


def ieee_divide(a, b, case: Callable, try_divide: Callable, is_nan: Callable, number: Callable):
    """Division of doubles with NaN and infinities in place of errors.

    ``case`` takes pairs of condition and value; no condition holds where an operand is null.
    """
    return case(
        (b != 0, try_divide(a, b)),
        (is_nan(a), number("NaN")),
        (a == 0, number("NaN")),
        (a > 0, number("Infinity")),
        (a < 0, number("-Infinity")),
    )


class Sql:
    """An operand of the formulas that writes itself as SQL."""

    def __init__(self, text: str):
        self.text = text

    def _with(self, sign: str, other, turned: bool = False) -> Sql:
        left, right = (other, self) if turned else (self, other)
        return Sql(f"({left} {sign} {right})")

    def __str__(self) -> str:
        return self.text

    def __add__(self, other):
        return self._with("+", other)

    def __sub__(self, other):
        return self._with("-", other)

    def __rsub__(self, other):
        return self._with("-", other, True)

    def __mul__(self, other):
        return self._with("*", other)

    def __truediv__(self, other):
        return self._with("/", other)

    def __ne__(self, other):
        return self._with("<>", other)

    def __eq__(self, other):
        return self._with("=", other)

    def __gt__(self, other):
        return self._with(">", other)

    def __lt__(self, other):
        return self._with("<", other)

    __hash__ = None


def call(name: str) -> Callable[..., Sql]:
    """A SQL function by its name."""
    return lambda *args: Sql(f"{name}({', '.join(map(str, args))})")
