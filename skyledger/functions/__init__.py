from skyledger.functions.dates import in_year, in_year_text
from skyledger.functions.models import model_code
from skyledger.functions.times import departure_gap, flown, seconds_of_day, wrap_gap

__all__ = [
    "departure_gap",
    "flown",
    "in_year",
    "in_year_text",
    "model_code",
    "seconds_of_day",
    "wrap_gap",
]
