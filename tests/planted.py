"""Lines with planted faults, and small frames of readings and fact rows."""

from __future__ import annotations

import json

READING = {
    "plant_id": "P1",
    "line_id": "PL-01",
    "line_name": "L1",
    "product_type": "A",
    "target_frequency_band_ghz_min": 2.4,
    "target_frequency_band_ghz_max": 2.5,
    "machine_id": "M1",
    "machine_type": "T1",
    "process_stage": "etching",
    "is_anomaly": False,
}
SHORT = {k: READING[k] for k in ("line_id", "machine_id", "process_stage", "is_anomaly")}


def _line(record_id, timestamp, telemetry, base=SHORT, **changes):
    reading = {"record_id": record_id, "timestamp": timestamp, **base, **changes}
    reading = {k: v for k, v in reading.items() if v is not None}
    return json.dumps({**reading, "telemetry": telemetry})


PLANTED = [
    _line(
        "r1",
        "2026-03-04T00:00:00.123Z",
        {"vibration_mm_s_rms": 0.4, "rf_power_w": 500, "power_consumption_kw": 12.4},
        READING,
    ),
    _line(
        "r2",
        "2026-03-07T23:59:59.999Z",
        {"vibration_mm_s_rms": 1.9, "rf_power_w": 501, "power_consumption_kw": 19.1},
        READING,
        is_anomaly=True,
    ),
    "{",
    "",
    _line("r5", "not a time", {"rf_power_w": 499}),
    _line("r6", "2026-03-04T06:00:00.000Z", {"rf_power_w": 498}, machine_id=None),
    _line("r7", "2026-03-04T07:00:00.000Z", {"rf_power_w": "oops", "x": 1.0}),
    _line("r8", "2026-03-04T08:00:00.000Z", {}),
    _line("r9", "2026-03-04T09:00:00.000Z", {"x": None, "y": "NaN"}, is_anomaly=None),
]
