"""Density and scaling expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ROOT_TWO_PI = math.sqrt(2 * math.pi)


def gauss(x: Column, mean: Column, sigma: Column) -> Column:
    return F.exp(-F.pow(x - mean, 2) / (2 * F.pow(sigma, 2))) / (sigma * ROOT_TWO_PI)


def ln_gauss(x: Column, mean: Column, sigma: Column) -> Column:
    return -F.ln(sigma) - 0.5 * math.log(2 * math.pi) - F.pow(x - mean, 2) / (2 * F.pow(sigma, 2))


def exp_density(t: Column, tau: Column) -> Column:
    return F.exp(-t / tau) / tau


def ln_exp_density(t: Column, tau: Column) -> Column:
    return -F.ln(tau) - t / tau


def exp_survival(t: Column, share: Column, tau: Column) -> Column:
    return share * F.exp(-t / tau)


def exp_gauss_2d(x: Column, t: Column, share: Column, mean: Column, sigma: Column, tau: Column) -> Column:
    """Decaying peak; sigma multiplies here (an amplitude), unlike in :func:`gauss`."""
    return share * F.exp(-t / tau) * sigma / ROOT_TWO_PI * F.exp(-F.pow(x - mean, 2) / (2 * F.pow(sigma, 2)))


def growth_rate(future: Column, last: Column) -> Column:
    """Per cent change; 0 when there is nothing to compare with."""
    return F.when(last == 0, F.lit(0.0)).otherwise((future - last) / last * 100)
