"""Weather rules.  The history, current and cleaned paths keep separate thresholds."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .bands import flag, lookup

_CODES = [(int(code), main, text, icon, current)
          for code, main, text, icon, current in fixed.rows(fixed.WEATHER_CODES)]
HISTORY_MAIN = {code: main for code, main, *_ in _CODES}
HISTORY_TEXT = {code: text for code, _, text, *_ in _CODES}
HISTORY_ICON = {code: icon for code, _, _, icon, _ in _CODES if icon}
CURRENT_MAIN = {code: current for code, *_, current in _CODES if current}
CURRENT_TEXT = {code: HISTORY_TEXT[code] for code in CURRENT_MAIN}
CURRENT_ICON = {code: HISTORY_ICON[code] for code in CURRENT_MAIN}
CONDITION = {int(code): label
             for label, codes in fixed.rows(fixed.CONDITION_GROUPS) for code in codes.split()}


def history_labels(code: Column) -> dict[str, Column]:
    return {
        "weather_main": lookup(code, HISTORY_MAIN, fixed.UNKNOWN_MAIN),
        "weather_description": lookup(code, HISTORY_TEXT, fixed.UNKNOWN_DESCRIPTION),
        "weather_icon": lookup(code, HISTORY_ICON, fixed.DEFAULT_ICON),
    }


def current_labels(code: Column) -> dict[str, Column]:
    return {
        "weather_main": lookup(code, CURRENT_MAIN, fixed.UNKNOWN_MAIN),
        "weather_description": lookup(code, CURRENT_TEXT, fixed.UNKNOWN_DESCRIPTION),
        "weather_icon": lookup(code, CURRENT_ICON, fixed.DEFAULT_ICON),
    }


def condition(code: Column) -> Column:
    return F.when(code.isNull(), F.lit(fixed.UNKNOWN_CONDITION)).otherwise(
        lookup(code, CONDITION, fixed.OTHER_CONDITION))


def celsius(fahrenheit: Column) -> Column:
    return (fahrenheit - 32) * 5 / 9


def precipitation_history(mm: Column) -> Column:
    inches = F.coalesce(mm, F.lit(0.0)) * fixed.MM_TO_IN
    return (F.when(inches == 0, F.lit(fixed.PRECIPITATION_DRY))
            .when(inches >= fixed.PRECIPITATION_HEAVY_IN, F.lit(fixed.PRECIPITATION_HEAVY))
            .when(inches >= fixed.PRECIPITATION_MODERATE_IN, F.lit(fixed.PRECIPITATION_MODERATE))
            .otherwise(F.lit(fixed.PRECIPITATION_LIGHT)))


def precipitation_current(inches: Column) -> Column:
    return (F.when(inches >= fixed.PRECIPITATION_HEAVY_IN, F.lit(fixed.PRECIPITATION_HEAVY))
            .when(inches >= fixed.PRECIPITATION_MODERATE_IN, F.lit(fixed.PRECIPITATION_MODERATE))
            .when(inches > 0, F.lit(fixed.PRECIPITATION_LIGHT))
            .otherwise(F.lit(fixed.PRECIPITATION_DRY)))


def _sector(degrees: Column, closed_right: bool) -> Column:
    """Compass label of a direction; the shared edge belongs to the earlier or the later sector."""
    width = 2 * fixed.COMPASS_HALF_SECTOR
    turned = (degrees + fixed.COMPASS_HALF_SECTOR) / width
    step = F.ceil(turned) - 1 if closed_right else F.floor(turned)
    names = F.array(*[F.lit(name) for name in fixed.COMPASS])
    return F.get(names, step.cast("int") % len(fixed.COMPASS))


def compass_fact(degrees: Column) -> Column:
    """Shared edges go to the earlier sector; NULL and out-of-range directions count as north."""
    last_edge = 360 - fixed.COMPASS_HALF_SECTOR
    in_sectors = (degrees > fixed.COMPASS_HALF_SECTOR) & (degrees <= last_edge)
    return F.when(in_sectors, _sector(degrees, closed_right=True)).otherwise(F.lit(fixed.COMPASS[0]))


def compass_cleaned(degrees: Column) -> Column:
    """Half-open sectors, so a shared edge goes to the later one; NULL is Unknown."""
    last_edge = 360 - fixed.COMPASS_HALF_SECTOR
    in_sectors = (degrees >= fixed.COMPASS_HALF_SECTOR) & (degrees < last_edge)
    return (F.when(degrees.isNull(), F.lit("Unknown"))
            .when(in_sectors, _sector(degrees, closed_right=False))
            .otherwise(F.lit(fixed.COMPASS[0])))


def heat_index(temperature: Column, humidity: Column) -> Column:
    def term(weight: float, of_temperature: int, of_humidity: int) -> Column:
        factors = [temperature] * of_temperature + [humidity] * of_humidity
        return reduce(lambda left, right: left * right, factors, F.lit(weight))

    polynomial = reduce(add, [term(*spec) for spec in fixed.HEAT_INDEX_TERMS])
    applies = (temperature > fixed.HEAT_INDEX_ABOVE_F) & (humidity > fixed.HEAT_INDEX_ABOVE_HUMIDITY)
    return F.when(applies, polynomial).otherwise(temperature)


def wind_chill(temperature: Column, wind: Column) -> Column:
    constant, by_temperature, by_wind, by_both, exponent = fixed.WIND_CHILL
    power = F.pow(wind, F.lit(exponent))
    chill = F.lit(constant) + temperature * by_temperature + power * by_wind + temperature * power * by_both
    applies = (temperature < fixed.WIND_CHILL_BELOW_F) & (wind > fixed.WIND_CHILL_ABOVE_MPH)
    return F.when(applies, chill).otherwise(temperature)


def comfort_fact(temperature: Column, humidity: Column, wind: Column, precipitation: Column) -> Column:
    excellent = (temperature.between(65, 75) & humidity.between(30, 60)
                 & (wind < 15) & (precipitation == 0))
    good = temperature.between(55, 85) & (humidity < 70) & (wind < 20) & (precipitation < 0.1)
    fair = temperature.between(40, 95) & (wind < 30) & (precipitation < 0.3)
    return (F.when(excellent, F.lit("Excellent")).when(good, F.lit("Good"))
            .when(fair, F.lit("Fair")).otherwise(F.lit("Poor")))


def comfort_cleaned(temperature: Column, humidity: Column) -> Column:
    dry = humidity < 60
    return (F.when(temperature.isNull() | humidity.isNull(), F.lit("Unknown"))
            .when(temperature < 32, F.lit("Very Cold"))
            .when(temperature < 50, F.lit("Cold"))
            .when(temperature <= 75, F.when(dry, F.lit("Comfortable")).otherwise(F.lit("Humid")))
            .when(temperature <= 85, F.when(dry, F.lit("Warm")).otherwise(F.lit("Hot & Humid")))
            .when(temperature <= 95, F.lit("Very Hot"))
            .otherwise(F.lit("Extreme Heat")))


def air_quality(pressure: Column, humidity: Column) -> Column:
    return (F.when((pressure > 1013) & (humidity < 70), F.lit("Good"))
            .when(pressure > 1000, F.lit("Moderate"))
            .otherwise(F.lit("Poor")))


def history_flags(temperature: Column, wind: Column, rain_mm: Column, snow_mm: Column) -> dict[str, Column]:
    return {
        "is_freezing": flag(temperature < fixed.FREEZING_F),
        "is_poor_visibility": F.lit(False),
        "is_high_wind": flag(wind > fixed.HIGH_WIND_MPH),
        "is_heavy_rain": flag(rain_mm * fixed.MM_TO_IN > 0.1),
        "has_snow": flag(snow_mm > 0),
    }


def current_flags(temperature: Column, wind: Column, rain_in: Column, snow_in: Column) -> dict[str, Column]:
    return {
        "is_freezing": flag(temperature <= fixed.FREEZING_F),
        "is_high_wind": flag(wind >= 40),
        "is_heavy_rain": flag(rain_in >= fixed.PRECIPITATION_HEAVY_IN),
        "has_snow": flag(snow_in > 0),
    }


def extreme_flags(temperature: Column, wind: Column, precipitation: Column) -> dict[str, Column]:
    return {
        "is_extreme_heat": flag(temperature > 100),
        "is_extreme_cold": flag(temperature < fixed.FREEZING_F),
        "is_high_wind": flag(wind > fixed.HIGH_WIND_MPH),
        "is_precipitation": flag(precipitation > 0),
    }


def condition_flags(main: Column) -> dict[str, Column]:
    return {
        "is_clear": flag(main == "Clear"),
        "is_cloudy": flag(main == "Clouds"),
        "is_rainy": flag(main.isin("Rain", "Drizzle")),
        "is_stormy": flag(main == "Thunderstorm"),
        "is_snowy": flag(main == "Snow"),
        "is_foggy": flag(main == "Fog"),
        "is_low_visibility": flag(main.isin("Fog", "Snow")),
    }
