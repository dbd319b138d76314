"""Business policy: labels, bounds and weights.

FIXED VALUES. Everything in this module is part of the data contract: results are only
comparable with earlier tables while these stay as they are.
"""

from __future__ import annotations

# Plausible ranges, inclusive at both ends. Anything outside becomes null.
PLAUSIBLE = {
    "temp_max": (-20.0, 60.0),
    "temp_min": (-20.0, 60.0),
    "precipitation_mm": (0.0, 500.0),
    "wind_speed_max": (0.0, 300.0),
    "wind_gust_max": (0.0, 300.0),
    "precipitation_prob": (0.0, 100.0),
}

# Category bands: (exclusive upper bound, label), the label above the last bound, and the
# label of a missing value.
UNKNOWN = "Inconnu"
TEMP_BANDS = [(15.0, "Froid"), (30.0, "Normal"), (38.0, "Chaud")]
TEMP_ABOVE = "Extrême"
DRY = "Aucune"  # exactly zero rain
RAIN_BANDS = [(5.0, "Faible"), (20.0, "Modérée")]
RAIN_ABOVE = "Forte"
GUST_BANDS = [(30.0, "Calme"), (50.0, "Modéré"), (70.0, "Fort")]
GUST_ABOVE = "Violent"
LEVEL_BANDS = [(25.0, "Faible"), (50.0, "Modéré"), (75.0, "Élevé")]
LEVEL_ABOVE = "Critique"

HIGH_RISK_LEVELS = ["Élevé", "Critique"]
HIGH_RISK_SCORE = 50.0

# Score weights, in points.
RAIN_SATURATION_MM = 30.0
RAIN_AMOUNT_POINTS = 25.0
RAIN_PROBABILITY_POINTS = 10.0
GUST_SATURATION_KMH = 90.0
GUST_POINTS = 30.0
COMFORT_LOW = 5.0
COMFORT_HIGH = 38.0
POINTS_PER_DEGREE = 1.5
TEMP_POINTS_CAP = 15.0
POINTS_PER_SEVERITY = 5.0
SCORE_CAP = 100.0

# Severity (0 harmless .. 4 worst) of each WMO weather code.
SEVERITY_OF_CODE = {
    0: 0, 1: 0, 2: 0, 3: 0, 45: 2, 48: 2, 51: 1, 53: 1, 55: 2, 56: 2, 57: 3, 61: 1, 63: 2, 65: 3,
    66: 3, 67: 4, 71: 2, 73: 3, 75: 4, 77: 3, 80: 2, 81: 3, 82: 4, 85: 3, 86: 4, 95: 4, 96: 4, 99: 4,
}
SEVERITY_OF_OTHER_CODE = 2
SEVERITY_OF_NO_CODE = 0

# Columns whose absence makes a score unreliable, and the flag by number missing.
QUALITY_COLUMNS = ["temp_max", "precipitation_mm", "wind_gust_max", "weather_code"]
COMPLETE, PARTIAL, LACKING = "Complet", "Partiel", "Manquant"
PARTIAL_UP_TO = 2

# Monday is 0: Friday and Saturday.
WEEKEND_DAYS = [4, 5]

# Reporting periods offered to users: number of days from today, None for everything.
PERIODS = {
    "Toutes les dates disponibles": None,
    "Aujourd'hui": 0,
    "3 prochains jours": 3,
    "7 prochains jours": 7,
}

TOP_CITIES = 10
TOP_CHART_CITIES = 15
