"""The Arrow form of the base-number transform, for users who need a Python function."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _short_form(number: int) -> str:
    kind = "s" if number % 7 == 0 else "a" if number % 3 == 0 else "e"
    return f"{kind}/{number:03x}"


@F.pandas_udf(StringType())
def base_id_arrow(base: pd.Series) -> pd.Series:
    """Same result as `functions.base_id`, over Arrow batches."""
    digits = base.str.extract(r"^.([0-9]+)$", expand=False)
    known = digits.dropna().map(int)
    return known.map(_short_form).reindex(base.index).astype(object).where(digits.notna(), None)
