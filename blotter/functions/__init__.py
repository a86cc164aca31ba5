"""Column -> Column helpers; all JVM-side except ``geodesic_km_udf``."""

from .casts import INCIDENT_TS_FORMAT, parse_money, parse_timestamp, to_double, to_int, to_long
from .daypart import daypart_number, daypart_text
from .descent import DESCENT_LABELS, descent_label
from .geo import geodesic_km_udf, with_geodesic_km

__all__ = [
    "INCIDENT_TS_FORMAT", "DESCENT_LABELS", "daypart_number", "daypart_text",
    "descent_label", "geodesic_km_udf", "parse_money",
    "parse_timestamp", "to_double", "to_int", "to_long", "with_geodesic_km",
]
