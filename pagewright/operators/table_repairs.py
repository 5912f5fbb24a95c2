"""Repairs of tables, one Arrow pass over the documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagewright.functions import tables


@F.pandas_udf(StringType())
def mended_headers(html: pd.Series) -> pd.Series:
    """Documents whose tables' repeated, fragmented headers have the form of the clean one in the same table; null stays null."""
    return html.map(lambda text: tables.mended(text) if "<table" in text.lower() else text, na_action="ignore")
