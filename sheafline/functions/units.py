"""Units and durations in their canonical form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.functions.files import lookup

# A unit as written, lower case, and its canonical form.
UNITS: dict[str, str] = {
    "мм": "mm", "mm": "mm", "см": "cm", "cm": "cm", "дм": "dm", "м": "m", "км": "km", "km": "km", "мкм": "µm", "мкм.": "µm", "µm": "µm", "дюйм": "in", "in": "in",
    "мм2": "mm²", "мм²": "mm²", "см2": "cm²", "см²": "cm²", "м2": "m²", "м²": "m²", "м3": "m³", "м³": "m³", "л": "L", "мл": "mL",
    "мг": "mg", "г": "g", "кг": "kg", "kg": "kg", "т": "t", "°c": "°C", "°с": "°C", "℃": "°C", "к": "K",
    "па": "Pa", "кпа": "kPa", "мпа": "MPa", "гпа": "GPa", "pa": "Pa", "kpa": "kPa", "mpa": "MPa", "бар": "bar", "bar": "bar", "атм": "atm", "мм рт. ст.": "mmHg", "кгс/см2": "kgf/cm²", "кгс/см²": "kgf/cm²",
    "в": "V", "кв": "kV", "мв": "mV", "а": "A", "ма": "mA", "вт": "W", "квт": "kW", "мвт": "MW", "квт·ч": "kW·h", "гц": "Hz", "кгц": "kHz", "мгц": "MHz", "ом": "Ω",
    "н": "N", "кн": "kN", "н·м": "N·m", "нм": "N·m", "кг/м3": "kg/m³", "об/мин": "rpm", "мин-1": "rpm", "мин⁻¹": "rpm", "rpm": "rpm", "м/с": "m/s", "км/ч": "km/h", "м/мин": "m/min",
    "%": "%", "шт": "pcs", "шт.": "pcs", "hrc": "HRC", "hb": "HB", "hv": "HV", "ra": "Ra", "rz": "Rz",
}
# Words for times and their canonical unit.
DURATIONS: dict[str, str] = {
    "сек": "s", "с": "s", "секунд": "s", "секунды": "s", "секунда": "s", "мин": "min", "минут": "min", "минуты": "min", "минута": "min", "ч": "h", "час": "h", "часа": "h", "часов": "h",
    "сут": "d", "сутки": "d", "суток": "d", "дн": "d", "день": "d", "дня": "d", "дней": "d", "нед": "week", "недель": "week", "недели": "week", "неделя": "week",
    "мес": "month", "месяц": "month", "месяца": "month", "месяцев": "month", "год": "year", "года": "year", "лет": "year",
}


def canonical(unit: Column) -> Column:
    """The canonical unit, or the unit itself where it is not known."""
    return F.coalesce(lookup(F.lower(F.trim(unit)), UNITS), F.trim(unit))


def canonical_duration(unit: Column) -> Column:
    return F.coalesce(lookup(F.rtrim(F.lower(F.trim(unit)), F.lit(".")), DURATIONS), F.trim(unit))
