"""One ride that both revisions accept, with values at the edges of what paths must keep."""

RIDE = {
    "ride_id": "ride-ä-0042", "point_idx": 2147483647, "latitude": 40.8125, "longitude": -73.875,
    "timestamp": "2025-11-30T19:45:30.000125-03:30", "meter_reading": 1e-3,
    "meter_increment": 0.0, "ride_status": "drop off", "passenger_count": 0,
}
ADDED = {"enrichment_timestamp": "2025-11-30T23:15:31.250Z", "region": "north"}
