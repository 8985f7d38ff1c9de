from riskstream.functions.clock import add_dt_hr, add_event_time, add_lags
from riskstream.functions.frames import frame_columns, to_frame
from riskstream.functions.keys import alert_row_key, high_risk_row_key
from riskstream.functions.risk import RISK_POINTS, is_high_risk, risk_score

__all__ = [
    "RISK_POINTS", "add_dt_hr", "add_event_time", "add_lags", "alert_row_key", "frame_columns",
    "high_risk_row_key", "is_high_risk", "risk_score", "to_frame",
]
