"""Step functions over one column, stated as tables of thresholds."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TESTS = {
    "<": operator.lt,
    "<=": operator.le,
    ">=": operator.ge,
    ">": operator.gt,
}


@dataclass(frozen=True)
class Bands:
    """The value of the first threshold that the column passes, else ``default``.

    A null column passes no threshold and so takes the default.
    """

    column: str
    test: str
    steps: Sequence[tuple[float, object]]
    default: object

    def expression(self) -> Column:
        passes = _TESTS[self.test]
        value = F.col(self.column)
        found = [F.when(passes(value, F.lit(limit)), F.lit(result)) for limit, result in self.steps]
        return F.coalesce(*found, F.lit(self.default))
