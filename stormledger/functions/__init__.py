from .codes import label
from .coordinates import signed_degrees
from .text import clean_int, decade_of, field, text_date
from .wind import wind_category

__all__ = [
    "clean_int",
    "decade_of",
    "field",
    "label",
    "signed_degrees",
    "text_date",
    "wind_category",
]
