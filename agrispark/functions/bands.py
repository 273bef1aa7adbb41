"""Bands, sentinels and scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = 65535
NON_CROP = 254
POSTPROCESS_NODATA = 255
#: Band names as extracted and as used (fixed values).
BAND_NAMES = {
    "S2-L2A-B02": "OPTICAL-B02", "S2-L2A-B03": "OPTICAL-B03", "S2-L2A-B04": "OPTICAL-B04", "S2-L2A-B05": "OPTICAL-B05",
    "S2-L2A-B06": "OPTICAL-B06", "S2-L2A-B07": "OPTICAL-B07", "S2-L2A-B08": "OPTICAL-B08", "S2-L2A-B8A": "OPTICAL-B8A",
    "S2-L2A-B11": "OPTICAL-B11", "S2-L2A-B12": "OPTICAL-B12", "S1-SIGMA0-VH": "SAR-VH", "S1-SIGMA0-VV": "SAR-VV",
    "elevation": "DEM-alt-20m", "slope": "DEM-slo-20m", "AGERA5-PRECIP": "METEO-precipitation_flux",
    "AGERA5-TMEAN": "METEO-temperature_mean",
}
RESOLUTION = {"b02": 10, "b04": 10, "b08": 10, "vv": 20, "vh": 20}


def valid(band: Column) -> Column:
    """The value, null where it is nodata."""
    return F.nullif(band, F.lit(NODATA))


def scaled(band: Column, family: str) -> Column:
    """Physical value of a stored one: optical reflectance, radar decibels, weather; nodata stays, terrain is unchanged."""
    forms = {
        "optical": band / 10000,
        "sar": F.when(band > 0, 20 * F.log10(band) - 83),
        "meteo": band / 100,
    }
    return F.when(band == NODATA, F.lit(float(NODATA))).otherwise(forms.get(family, band.cast("double")))


def ndvi(nir: Column, red: Column) -> Column:
    n, r = valid(nir).cast("double"), valid(red).cast("double")
    return F.try_divide(n - r, n + r)


def ndvi_scaled(nir: Column, red: Column) -> Column:
    return (F.least(F.greatest(ndvi(nir, red), F.lit(-0.08)), F.lit(0.92)) + 0.08) / 0.004


def linear_scale(x: Column, low: float, high: float, to_low: float, to_high: float) -> Column:
    """Linear scaling with clamping to the source range."""
    return (F.least(F.greatest(x, F.lit(low)), F.lit(high)) - low) / (high - low) * (to_high - to_low) + to_low
