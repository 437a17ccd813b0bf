"""Spark library for monthly energy, tariff, fuel-price, climate and zone data."""
