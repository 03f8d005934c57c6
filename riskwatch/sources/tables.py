"""Logical warehouse tables and where they come from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskwatch.operators.joins import rows_of

# Columns each logical table has to offer. Nested columns are named by their
# root; extra columns are ignored and never read.
COLUMNS: dict[str, tuple[str, ...]] = {
    "creditor": (
        "id", "organisation_id", "name", "geo", "merchant_category_code",
        "merchant_category_code_description", "creditor_risk_label_parent",
        "creditor_risk_label_detail", "most_recent_risk_label_created_at",
        "creditor_created_date", "is_account_closed", "is_payment_provider",
        "organisation_with_multiple_creditors",
    ),
    "organisation": (
        "organisation_id", "creditor_id", "name", "geo", "account_id",
        "merchant_category_code", "created_at", "current_revenue_account_type",
        "current_state", "parent_account_id", "parent_account_name",
        "is_cs_managed", "csm_owner_name", "is_cs_managed_salesforce",
        "parent_account_stage",
    ),
    "organisation_fact": ("organisation_id", "total_payment_gbp_amount_in_all_time"),
    "opportunity": ("account_id", "opportunity_id", "opportunity_created_date"),
    "exposure": ("creditor_id", "amount_gbp", "calculated_at_date"),
    "score_report": ("creditor_id", "retrieved_at", "dnb_assessment", "legal_events"),
    "default_prediction": ("creditor_id", "prediction_date", "probability"),
    "daily_balance": ("owner_id", "name", "calendar_date", "balance_amount_sum_gbp"),
    "payment": (
        "creditor_id", "amount_gbp", "is_paid", "is_charged_back", "is_failed",
        "is_late_failure", "is_refunded", "charge_date", "charged_back_date",
        "failed_or_late_failure_date", "refund_created_at",
    ),
    "ticket": ("id", "created_at", "subject", "organization_id", "group_id"),
    "ticket_field": ("ticket_id", "ticket_field_title", "ticket_field_value"),
    "ticket_group": ("id", "name"),
    "ticket_org": ("id", "organisation_key"),
    "result_log": ("values", "runtime", "logtype", "process_name"),
}


# Tables derived from others, which a deployment may keep to spare reads.
OPTIONAL: dict[str, tuple[str, ...]] = {
    "seen_creditor": ("creditor_id",),
    "payment_event": (*COLUMNS["payment"], "event", "event_date"),
}

# Tables keyed by creditor, and the column that holds it.
CREDITOR_KEYS = {
    "creditor": "id",
    "exposure": "creditor_id",
    "score_report": "creditor_id",
    "default_prediction": "creditor_id",
    "daily_balance": "owner_id",
    "payment": "creditor_id",
    "seen_creditor": "creditor_id",
    "payment_event": "creditor_id",
}

Table = DataFrame | Callable[[], DataFrame]


class Sources:
    """Maps logical table names to lazy DataFrames.

    Nothing is read until a result is asked for, and every feature selects the
    columns it needs, so column pruning and filter pushdown reach the scans. A
    table may be given as a function, which is called on first use: a process
    then resolves (lists files, reads the schema of) only the tables it needs.
    """

    def __init__(self, tables: Mapping[str, Table]):
        unknown = sorted(set(tables) - set(COLUMNS) - set(OPTIONAL))
        if unknown:
            raise ValueError(f"unknown logical tables: {unknown}")
        self._tables = dict(tables)

    @classmethod
    def from_parquet(cls, spark: SparkSession, paths: Mapping[str, str]) -> Sources:
        """Logical name -> parquet path."""
        return cls({name: partial(spark.read.parquet, path) for name, path in paths.items()})

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: Mapping[str, str]) -> Sources:
        """Logical name -> catalog table (fully or partly qualified)."""
        return cls({name: partial(spark.table, table) for name, table in names.items()})

    def has(self, name: str) -> bool:
        return name in self._tables

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise KeyError(f"no table bound for {name!r}")
        df = self._tables[name]
        if not isinstance(df, DataFrame):
            df = self._tables[name] = df()
        present = {c.lower() for c in df.columns}
        missing = [c for c in (COLUMNS | OPTIONAL)[name] if c.lower() not in present]
        if missing:
            raise ValueError(f"table {name!r} lacks columns {missing}")
        return df

    def replace(self, **tables: Table) -> Sources:
        """The same sources with some tables swapped."""
        return Sources({**self._tables, **tables})

    def of_creditors(self, creditors: DataFrame) -> Sources:
        """The same sources with creditors and facts of the given few creditors only."""

        def filtered(name: str, key: str) -> DataFrame:
            return rows_of(self.table(name), creditors.select(F.col("creditor_id").alias(key)), key)

        keyed = {n: key for n, key in CREDITOR_KEYS.items() if n in COLUMNS or self.has(n)}
        return self.replace(**{n: partial(filtered, n, key) for n, key in keyed.items()})
