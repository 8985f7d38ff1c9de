from riskstream.operators.alerts import activity_then_tx, login_then_tx
from riskstream.operators.interval_join import hot_keys, interval_join
from riskstream.operators.keyed import (
    alert_cells, high_risk_cells, latest_by_key, put_rows, serving_alerts,
)
from riskstream.operators.lateness import mark_on_time, split_late
from riskstream.operators.routes import (
    ROUTES, Route, route_counts, tag_feed, tagged, union_aligned,
)
from riskstream.operators.scoring import score_transactions

__all__ = [
    "ROUTES", "Route", "activity_then_tx", "alert_cells", "high_risk_cells", "hot_keys",
    "interval_join", "latest_by_key", "login_then_tx", "mark_on_time", "put_rows", "route_counts",
    "score_transactions", "serving_alerts", "split_late", "tag_feed", "tagged", "union_aligned",
]
