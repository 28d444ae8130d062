"""The constraints a database would enforce on the tables, as one report per table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from careledger.operators.quality import table_report
from careledger.schemas import TABLES
from careledger.sources.warehouse import Warehouse


def check_table(wh: Warehouse, name: str) -> DataFrame:
    """(check, column_name, n): violations of key, reference and length limits, from one scan of the table."""
    table, df = TABLES[name], wh.read(name)
    references = {}
    if "datasource_id" in df.columns and name != "datasource":
        references["datasource_id"] = (wh.read("datasource"), "id")
    return table_report(df, table.keys, table.limits, references, {"datasource_id": "unknown source"})
