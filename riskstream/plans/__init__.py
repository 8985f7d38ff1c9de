from riskstream.plans.compaction import compact, compact_in_place, inventory
from riskstream.plans.gold import daily_kpi, daily_kpi_by_flag, load_gold, location_risk
from riskstream.plans.hourly import hour_ready, run_hour
from riskstream.plans.layers import Layers, unify
from riskstream.plans.repair import missing_alerts, repair_alerts
from riskstream.plans.reports import dlq_audit, fraud_heatmap, ingest_lag_by_hour, top_risk_accounts
from riskstream.plans.serving import load_serving, serving_high_risk
from riskstream.plans.tables import create_tables, sync_partitions

__all__ = [
    "Layers", "compact", "compact_in_place", "create_tables", "daily_kpi",
    "daily_kpi_by_flag", "dlq_audit", "fraud_heatmap", "hour_ready", "ingest_lag_by_hour",
    "inventory", "load_gold", "load_serving", "location_risk", "missing_alerts", "repair_alerts", "run_hour", "serving_high_risk", "sync_partitions", "top_risk_accounts",
    "unify",
]
