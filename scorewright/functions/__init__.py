from scorewright.functions.time import epoch_micros, date_parts, seasonality, days_between
from scorewright.functions.hashing import unit_score, unit_score_sql
from scorewright.functions.numeric import comparable

__all__ = ["epoch_micros", "date_parts", "seasonality", "days_between", "unit_score",
           "unit_score_sql", "comparable"]
