"""Domain classifiers: rain intensity, gust risk, state time zone, day period."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from meteomart import constants as K


def rain_intensity(mm: Column) -> Column:
    """NULL sem_dado; 0 sem_chuva; (0,5] fraca; (5,25] moderada; else intensa.

    Negative values fall through to the last class, as upstream.
    """
    return (F.when(mm.isNull(), "sem_dado")
            .when(mm == 0, "sem_chuva")
            .when((mm > 0) & (mm <= K.RAIN_LIGHT_MAX_MM), "chuva_fraca")
            .when((mm > K.RAIN_LIGHT_MAX_MM) & (mm <= K.RAIN_MODERATE_MAX_MM), "chuva_moderada")
            .otherwise("chuva_intensa"))


def wind_risk(gust: Column) -> Column:
    """NULL sem_dado; <10 fraco; [10,20) moderado; [20,35) forte; else tempestade."""
    return (F.when(gust.isNull(), "sem_dado")
            .when(gust < K.GUST_MODERATE_MIN_MS, "vento_fraco")
            .when((gust >= K.GUST_MODERATE_MIN_MS) & (gust < K.GUST_STRONG_MIN_MS), "vento_moderado")
            .when((gust >= K.GUST_STRONG_MIN_MS) & (gust < K.GUST_STORM_MIN_MS), "vento_forte")
            .otherwise("vento_tempestade"))


def uf_timezone(uf: Column) -> Column:
    """State code -> IANA zone; NULL or unknown codes get the default zone.

    A constant map literal: folded once, looked up per row in generated code.
    """
    zones = F.create_map(*[F.lit(x) for x in chain.from_iterable(K.UF_TIMEZONE.items())])
    return F.coalesce(F.try_element_at(zones, uf), F.lit(K.DEFAULT_TIMEZONE))


def day_period(hour: Column) -> Column:
    """Period of the (UTC) hour; anything outside 0-17, NULL included, is 'noite'."""
    expr = None
    for lo, hi, label in K.PERIOD_BOUNDS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("noite")
